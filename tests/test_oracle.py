"""Spark result == DuckDB oracle, on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from costlens.oracle.registry import TABLES

SF = "/root/testdata/sf0.001"
KEYS = ["daily_cost_rollup", "query_cost_attribution", "query_patterns", "team_cost_attribution",
        "idle_warehouse_periods", "warehouse_sizing_analysis", "warehouse_auto_suspend", "ap_union",
        "storage_breakdown", "storage_recommendations", "cost_forecast_daily", "cost_seasonality_baseline",
        "team_cost_forecast", "data_freshness", "all_recommendations", "recommendation_roi", "cost_by_user",
        "alert_union", "alert_state_tracker", "dash_cost_heatmap", "dash_table_lineage", "wl_customer_segments",
        "wl_demand_signals", "dq_schema_report", "upsert", "upsert_versions", "alert_state_carried", "alert_history_carried",
        "dq_relationships", "dq_pricing_complete", "upsert_days", "incremental_stream", "episode_stream", "idle_island_stream",
        "storage_breakdown_json", "alert_outbox", "alert_payload_facts", "weekly_report_html", "latency_sketch_bounds", "team_user_sketch_bounds",
        "user_cost_summary", "cost_by_warehouse", "wl_burst_volatility", "dq_unique", "dq_not_null", "seed_load", "verify_recent_metering",
        "wl_ltv_ranking", "wl_quarterly_valuation", "wl_burst_health", "wl_burst_loyalty", "wl_burst_valuation"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 4)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_every_key_has_oracle_or_is_rows_only():
    from costlens.oracle.registry import ROWS_ONLY_KEYS
    from costlens.plans.registry import queries
    from costlens.oracle.registry import oracle_sql
    assert set(queries()) == set(oracle_sql()) | set(ROWS_ONLY_KEYS)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
