"""Oracle statements per key, wrapped with the same boundary normalisation as
the Spark side (bigint integers, doubles rounded to 4 places).

The wrapper needs each statement's output types; DuckDB describes the
statement (planning only, nothing is executed) against the smallest test
tables, and the column list is built from that."""

from __future__ import annotations

import functools
import os

from costlens.oracle import base
from costlens.oracle import (  # noqa: F401  (fill the registries)
    models_antipattern, models_cost, models_dashboard, models_publish, models_storage_forecast, models_warehouse,
    models_quality, models_workload)

DESCRIBE_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

ORACLE_KEYS: list[str] = list(base.FINAL)
# keys registered without an oracle statement (non-SQL operators)
ROWS_ONLY_KEYS: list[str] = ["alert_payload"]
ALL_KEYS: list[str] = ORACLE_KEYS + ROWS_ONLY_KEYS

_INT = ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT")
_FRAC = ("FLOAT", "DOUBLE", "REAL")


def _wrap(sql: str, described: list[tuple[str, str]]) -> str:
    cols = []
    for name, typ in described:
        q = f'"{name}"'
        if typ in _INT:
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif typ in _FRAC or typ.startswith("DECIMAL"):
            x = f"CAST({q} AS DOUBLE)"
            cols.append(f"CAST(floor(({x} + abs({x}) * 1e-10) * 10000 + 0.5) / 10000 AS DOUBLE) AS {q}")
        else:
            cols.append(q)
    return f"SELECT {', '.join(cols)} FROM (\n{sql}\n) AS result"


@functools.lru_cache(maxsize=1)
def oracle_sql() -> dict[str, str]:
    statements = {k: base.build(k) for k in ORACLE_KEYS}
    try:
        import duckdb
        con = duckdb.connect()
        for t in TABLES:
            p = os.path.join(DESCRIBE_DIR, f"{t}.parquet")
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        out = {}
        for k, sql in statements.items():
            try:
                desc = con.execute(f"DESCRIBE {sql}").fetchall()
                out[k] = _wrap(sql, [(r[0], r[1]) for r in desc])
            except Exception:  # keep the bare statement; the compare shows any mismatch
                out[k] = sql
        con.close()
        return out
    except ImportError:
        return statements
