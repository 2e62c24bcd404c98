"""CTE registry and statement assembly for the oracle."""

from __future__ import annotations

import re

from costlens.functions.exprs import AsOf
from costlens.sources import staging, telemetry
from costlens.sources.seeds import test_config

AS_OF = AsOf()
CONFIG = test_config()

CTES: dict[str, str] = {}
FINAL: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def final(key: str, sql: str) -> None:
    FINAL[key] = sql.strip()


def T(expr: str) -> str:
    """Render ``{AS_OF}`` / ``{AS_OF_DATE}`` for DuckDB."""
    return telemetry.render(expr, AS_OF, "duckdb")


# -- adapter (shared expression text with the Spark side) -------------------
def _sel(cols) -> str:
    return ",\n  ".join(f"{T(e)} AS {c}" for c, e in cols)


cte("query_history", f"""SELECT q.*, {telemetry.QUERY_HISTORY_END} AS end_time
FROM (SELECT
  {_sel(telemetry.QUERY_HISTORY_BASE)}
FROM orders) q""")
for _name, (_src, _pre, _cols) in telemetry.BLOCKS.items():
    cte(_name, f"SELECT\n  {_sel(_cols)}\nFROM {_src}" + (f" WHERE {_pre}" if _pre else ""))
cte("storage_usage", f"SELECT\n  {_sel(telemetry.STORAGE_USAGE)}\nFROM ({telemetry.DAY_SET}) x")
cte("database_storage_usage_history",
    f"SELECT\n  {_sel(telemetry.DATABASE_STORAGE)}\nFROM ({telemetry.DAY_SET}) x CROSS JOIN ({telemetry.DB_SET}) y")
for _t, _svc in telemetry.SERVERLESS_SPLIT.items():
    _obj = telemetry.SERVERLESS_OBJECT_COLUMN[_t]
    cte(_t, f"SELECT object_name AS {_obj}, schema_name, database_name, start_time, credits_used "
            f"FROM serverless_objects WHERE service_type = '{_svc}'")
# flat form of the access history; the nested form is only needed by staging
cte("access_history", "SELECT query_id, MIN(query_start_time) AS query_start_time, "
                      "list({'objectName': object_name} ORDER BY object_name) AS base_objects_accessed "
                      "FROM access_objects GROUP BY query_id")

RAW_COLUMNS = {
    "query_history": {c for c, _ in telemetry.QUERY_HISTORY_BASE} | {"end_time"},
    "storage_usage": {c for c, _ in telemetry.STORAGE_USAGE},
    "database_storage_usage_history": {c for c, _ in telemetry.DATABASE_STORAGE},
    "access_history": {"query_id", "query_start_time", "base_objects_accessed"},
}
for _name, (_src, _pre, _cols) in telemetry.BLOCKS.items():
    RAW_COLUMNS[_name] = {c for c, _ in _cols}
for _t in telemetry.SERVERLESS_SPLIT:
    RAW_COLUMNS[_t] = {telemetry.SERVERLESS_OBJECT_COLUMN[_t], "schema_name", "database_name",
                       "start_time", "credits_used"}

for _stg, (_src, _spec) in staging.STAGING.items():
    cte(_stg, staging.project_sql(_stg, RAW_COLUMNS[_src], AS_OF))

# -- config tables ------------------------------------------------------------
for _seed in ("credit_pricing", "alert_configuration", "alert_suppressions", "bank_holidays",
              "warehouse_size_credits", "warehouse_team_mapping", "monthly_budget", "recommendation_actions"):
    cte(f"seed_{_seed}", CONFIG.sql_values(_seed))

NOW = T("{AS_OF}")
TODAY = T("{AS_OF_DATE}")

cte("price", f"""SELECT credit_price_usd FROM seed_credit_pricing
WHERE edition = 'ENTERPRISE' AND {TODAY} BETWEEN effective_from AND effective_to
ORDER BY effective_from, credit_price_usd LIMIT 1""")


# -- assembly -----------------------------------------------------------------
_IDENT = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(_IDENT.findall(sql)) if w in CTES]


def build(key: str) -> str:
    body = FINAL[key]
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()):
        if name in seen:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        seen.add(name)
        order.append(name)

    for d in _deps(body):
        visit(d)
    if not order:
        return body
    withs = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    return f"WITH {withs}\n{body}"


for _stg in staging.STAGING:
    final(_stg, f"SELECT * FROM {_stg}")
