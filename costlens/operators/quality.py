"""Data-quality checks.

Generic checks (not null, unique, accepted values, relationships,
non-negative) report one row per check with its failure count. The null, range and
value checks of a model are counted while it is written (``Pipeline.published``), those
of other tables by one aggregate each; the keys of all tables are counted in one
grouping. Singular checks return the violating rows, as the assertions do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf

# FIXED VALUES: the generic checks. Per table: columns that are never NULL, keys that
# are unique, columns that are never negative, columns of listed values.
LEVELS, STATUSES = ["LOW", "MEDIUM", "HIGH"], ["OPEN", "ACCEPTED", "IMPLEMENTED", "REJECTED", "DEFERRED"]
FRESHNESS = ["FRESH", "STALE", "CRITICAL"]
CHECKS = {
    "stg_access_history": {"not_null": ["query_id"]},
    "stg_clustering": {"not_null": ["start_time"]},
    "stg_database_storage": {"not_null": ["usage_date", "database_name"]},
    "stg_login_history": {"not_null": ["event_id"], "unique": ["event_id"]},
    "stg_mv_refresh": {"not_null": ["start_time"]},
    "stg_pipe_usage": {"not_null": ["start_time"]},
    "stg_query_history": {"not_null": ["query_id", "start_time", "end_time"], "unique": ["query_id"]},
    "stg_search_optimization": {"not_null": ["start_time"]},
    "stg_serverless_task": {"not_null": ["start_time"]},
    "stg_sessions": {"not_null": ["session_id"], "unique": ["session_id"]},
    "stg_storage_usage": {"not_null": ["usage_date"], "unique": ["usage_date"]},
    "stg_table_storage": {"not_null": ["table_id"]},
    "stg_warehouse_load": {"not_null": ["warehouse_name", "start_time"]},
    "stg_warehouse_metering": {"not_null": ["warehouse_name", "start_time"]},
    "stg_warehouse_role_usage": {"not_null": ["warehouse_name", "role_name", "user_name"]},
    "query_cost_attribution": {"not_null": ["query_id"], "unique": ["query_id"], "non_negative": ["estimated_cost_usd"]},
    "query_patterns": {"not_null": ["query_hash", "query_date"]},
    "warehouse_daily_credits": {"not_null": ["warehouse_name", "date"], "non_negative": ["estimated_cost_usd"]},
    "serverless_credits": {"not_null": ["service_type", "date"], "non_negative": ["credits_used"]},
    "daily_cost_rollup": {"not_null": ["date"], "unique": ["date"], "non_negative": ["total_cost"]},
    "team_cost_attribution": {"not_null": ["team_name", "month"]},
    "user_cost_summary": {"not_null": ["user_name", "month"], "non_negative": ["total_cost_usd"]},
    "warehouse_utilisation": {"not_null": ["warehouse_name", "interval_start"]},
    "idle_warehouse_periods": {"not_null": ["warehouse_name"], "non_negative": ["idle_duration_minutes"]},
    "warehouse_queue_analysis": {"not_null": ["warehouse_name"]},
    "warehouse_schedule_analysis": {"not_null": ["warehouse_name"]},
    "warehouse_sizing_analysis": {"not_null": ["warehouse_name"], "unique": ["warehouse_name"]},
    "warehouse_auto_suspend": {"not_null": ["warehouse_name"], "unique": ["warehouse_name"], "non_negative": ["potential_savings_usd"]},
    "ap_full_table_scan": {"not_null": ["query_id"]},
    "ap_select_star": {"not_null": ["query_id"]},
    "ap_spill": {"not_null": ["query_id"]},
    "ap_repeated": {"not_null": ["query_id"]},
    "ap_cartesian_join": {"not_null": ["query_id"]},
    "ap_large_sort": {"not_null": ["query_id"]},
    "ap_long_running": {"not_null": ["query_id"], "accepted": {"antipattern_type": ["LONG_RUNNING"]}},
    "ap_union": {"not_null": ["antipattern_type"], "accepted": {"severity": ["P1", "P2", "P3"]}},
    "storage_breakdown": {"not_null": ["database_name", "table_name"]},
    "storage_clone_overhead": {"not_null": ["table_name"]},
    "storage_recommendations": {"not_null": ["recommendation_type"]},
    "storage_time_travel_waste": {"not_null": ["table_name"], "non_negative": ["estimated_savings_usd"]},
    "storage_transient_candidates": {"not_null": ["table_name"]},
    "storage_unused_tables": {"not_null": ["table_name"], "non_negative": ["savings_if_dropped_usd"]},
    "storage_analysis": {"not_null": ["table_name"]},
    "cost_forecast_daily": {"not_null": ["forecast_date", "predicted_total_cost"], "unique": ["forecast_date"]},
    "cost_seasonality_baseline": {"not_null": ["date", "adjusted_baseline", "effective_stddev"], "unique": ["date"]},
    "team_cost_forecast": {"not_null": ["team_name", "forecast_month"]},
    "cost_forecast_monthly": {"not_null": ["month"], "accepted": {"data_type": ["ACTUAL", "FORECAST"]}},
    "data_freshness_monitor": {"not_null": ["source_name", "staleness_minutes"], "unique": ["source_name"]},
    "data_freshness": {"not_null": ["source_name"], "unique": ["source_name"], "accepted": {"freshness_status": FRESHNESS}},
    "warehouse_recommendations": {"not_null": ["warehouse_name"], "non_negative": ["estimated_monthly_savings_usd", "priority_score"]},
    "query_optimization_candidates": {"not_null": ["optimization_rank"], "unique": ["optimization_rank"], "non_negative": ["estimated_waste_usd"]},
    "antipattern_summary": {"not_null": ["antipattern_type"], "unique": ["antipattern_type"]},
    "all_recommendations": {
        "not_null": ["recommendation_id", "overall_rank"], "unique": ["recommendation_id", "overall_rank", "stable_id"],
        "non_negative": ["estimated_monthly_savings_usd"],
        "accepted": {"category": ["WAREHOUSE", "QUERY", "STORAGE"], "effort": LEVELS, "confidence": LEVELS}},
    "recommendation_lifecycle": {"not_null": ["recommendation_id"], "unique": ["recommendation_id"], "accepted": {"status": STATUSES}},
    "recommendation_roi": {"not_null": ["recommendation_id"], "unique": ["recommendation_id"], "accepted": {"status": STATUSES}},
    "cost_summary": {"not_null": ["month"], "unique": ["month"], "non_negative": ["total_cost"]},
    "cost_trends_daily": {"not_null": ["date"], "unique": ["date"]},
    "cost_by_query_type": {"not_null": ["query_type"], "unique": ["query_type"]},
    "cost_by_user": {"not_null": ["user_name"], "unique": ["user_name"]},
    "cost_by_warehouse": {"not_null": ["warehouse_name"], "unique": ["warehouse_name"]},
    "warehouse_efficiency": {"not_null": ["warehouse_name"], "unique": ["warehouse_name"], "non_negative": ["efficiency_score"]},
    "team_cost_dashboard": {"not_null": ["team_name", "month"]},
    "weekly_executive_report": {"not_null": ["report_date"]},
    "alert_cost_daily_spike": {"not_null": ["alert_id"]},
    "alert_warehouse_idle": {"not_null": ["alert_id"]},
    "alert_credit_budget": {"not_null": ["alert_id"]},
    "alert_query_spill": {"not_null": ["alert_id"]},
    "alert_storage_growth": {"not_null": ["alert_id"]},
    "alert_repeated_expensive": {"not_null": ["alert_id"]},
    "alert_query_long_running": {"not_null": ["alert_id"]},
    "alert_union": {"not_null": ["alert_id", "detected_at"]},
    "alert_state_tracker": {"not_null": ["alert_episode_key", "alert_id"], "unique": ["alert_episode_key"]},
    "alert_history": {"not_null": ["alert_episode_key"], "unique": ["alert_episode_key"]},
    "seed_alert_suppressions": {"not_null": ["alert_id", "resource_value", "suppression_reason", "created_by", "start_date", "end_date"]},
    "seed_bank_holidays": {"not_null": ["holiday_date", "description", "region"], "unique": ["holiday_date"], "accepted": {"region": ["IN"]}},
}
EXPECTED_EDITIONS = ["STANDARD", "ENTERPRISE", "BUSINESS_CRITICAL"]
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 24, 48

CHECK_COLS = ["check_type", "table_name", "column_name", "failures"]


Check = tuple[str, str]  # its kind and column


def conditions(checks: dict) -> dict[Check, Column]:
    """What a row violates, for the null, range and value checks of a table."""
    out = {("not_null", c): F.col(c).isNull() for c in checks.get("not_null", ())}
    out |= {("non_negative", c): F.col(c) < 0 for c in checks.get("non_negative", ())}
    return out | {("accepted_values", c): F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in checks.get("accepted", {}).items()}


def column_report(frames: Callable[[str], DataFrame], spec=None, observed: Callable[[str], dict[Check, int] | None] = lambda t: None) -> DataFrame:
    """Null, range and value checks. ``observed`` has the counts of a table that was
    written with them; any other table is aggregated once for all of its checks."""
    parts, known, spark = [], [], None
    for table, checks in (spec or CHECKS).items():
        conds = conditions(checks)
        counts = observed(table)
        if not conds:
            continue
        if counts is not None:
            known += [(kind, table, c, counts[kind, c]) for kind, c in conds]
            spark = spark or frames(table).sparkSession
            continue
        agg = frames(table).agg(*[F.count_if(x).alias(f"c{i}") for i, x in enumerate(conds.values())])
        pairs = ", ".join(f"'{kind}', '{c}', c{i}" for i, (kind, c) in enumerate(conds))
        parts.append(agg.selectExpr(f"'{table}' AS table_name", f"stack({len(conds)}, {pairs}) AS (check_type, column_name, failures)"))
    if known:
        parts.append(spark.createDataFrame(known, "check_type string, table_name string, column_name string, failures long"))
    return _union(parts)


def unique(frames: Callable[[str], DataFrame], spec=None) -> DataFrame:
    """Keys that occur more than once; a null key counts as one key. The keys of all
    tables go through one grouping, told apart by the number of their check."""
    checks = [(t, key) for t, c in (spec or CHECKS).items() for key in c.get("unique", ())]
    keys = None
    for n, (t, key) in enumerate(checks):
        one = frames(t).select(F.lit(n).alias("check"), F.col(key).cast("string").alias("key"))
        keys = one if keys is None else keys.unionByName(one)
    doubled = keys.groupBy("check", "key").count().filter(F.col("count") > 1).groupBy("check").agg(F.count(F.lit(1)).alias("doubled"))
    named = keys.sparkSession.createDataFrame([(n, t, key) for n, (t, key) in enumerate(checks)], "check int, table_name string, column_name string")
    return _union([named.join(doubled, "check", "left").select(
        F.lit("unique").alias("check_type"), "table_name", "column_name", F.coalesce("doubled", F.lit(0)).alias("failures"))])


def relationships(links: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Rows of a child whose value the parent lacks: (table, child, its column,
    parent, its column)."""
    parts = []
    for table, child, column, parent, key in links:
        known = parent.select(F.col(key).alias(column)).distinct()
        orphans = child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit("relationships").alias("check_type"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "failures"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select(CHECK_COLS)
    for p in parts[1:]:
        out = out.unionByName(p.select(CHECK_COLS))
    return out.withColumn("failures", F.col("failures").cast("long"))


def schema_report(checks: list[DataFrame]) -> DataFrame:
    """All generic checks as one table with severity and PASS/FAIL."""
    allc = _union(checks)
    sev = F.when(F.col("check_type") == "relationships", "warn").otherwise("error")
    return allc.select(*CHECK_COLS, sev.alias("severity"),
                       F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"))


def source_freshness(sources: dict[str, tuple[DataFrame, str]], as_of: AsOf) -> DataFrame:
    """Age of the newest row per source; warn after 24 h, error after 48 h."""
    parts = None
    for name, (df, col) in sources.items():
        one = df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("latest")).select(
            F.lit(name).alias("source_name"), "latest")
        parts = one if parts is None else parts.unionByName(one)
    age = F.timestamp_diff("MICROSECOND", F.col("latest"), as_of.ts_col()) / 3600000000.0
    return parts.select("source_name", "latest", age.alias("age_hours"),
                        F.when(F.col("latest").isNull() | (age > FRESHNESS_ERROR_HOURS), "error")
                        .when(age > FRESHNESS_WARN_HOURS, "warn").otherwise("pass").alias("status"))


def pricing_complete(pricing: DataFrame, metering: DataFrame) -> DataFrame:
    """Editions without a price valid on the first of a month that was metered."""
    months = metering.select(F.trunc(F.to_date("start_time"), "month").alias("month")).distinct()
    wanted = months.withColumn("edition", F.explode(F.array(*[F.lit(e) for e in EXPECTED_EDITIONS])))
    valid = (wanted["edition"] == pricing["edition"]) & F.col("month").between(F.col("effective_from"), F.col("effective_to"))
    return wanted.join(pricing, valid, "left_anti").select("edition", "month")


def rollup_components(rollup: DataFrame) -> DataFrame:
    diff = F.abs(F.col("total_cost") - (F.col("compute_cost") + F.col("storage_cost") + F.col("serverless_cost")))
    return rollup.filter(diff > 0.01).select("date", "total_cost", "compute_cost", "storage_cost", "serverless_cost")


def efficiency_range(eff: DataFrame) -> DataFrame:
    return eff.filter((F.col("efficiency_score") < 0) | (F.col("efficiency_score") > 100))


def forecast_future(fc: DataFrame, as_of: AsOf) -> DataFrame:
    return fc.filter(F.col("forecast_date") <= as_of.date_col())


def forecast_positive(fc: DataFrame) -> DataFrame:
    return fc.filter(F.col("predicted_total_cost") < 0)


def freshness_sources(monitor: DataFrame, minimum: int = 5) -> DataFrame:
    return monitor.agg(F.count_distinct("source_name").alias("source_count")).filter(
        F.col("source_count") < minimum)


def no_duplicate_recs(recs: DataFrame) -> DataFrame:
    return recs.groupBy("recommendation_id").count().filter(F.col("count") > 1)


def no_future_dates(qh: DataFrame, as_of: AsOf) -> DataFrame:
    return qh.filter(F.col("end_time") > as_of.ts_col() + F.expr("INTERVAL 1 HOURS")).select("end_time").limit(1)


def seasonality_days(baseline: DataFrame, minimum: int = 30) -> DataFrame:
    return baseline.agg(F.count_distinct("date").alias("day_count")).filter(F.col("day_count") < minimum)


def team_sum(team: DataFrame, qca: DataFrame) -> DataFrame:
    t = team.agg(F.sum("compute_cost").alias("team_sum"))
    q = qca.agg(F.sum("estimated_cost_usd").alias("query_sum"))
    d = F.abs(F.col("team_sum") - F.col("query_sum"))
    return t.crossJoin(q).select("team_sum", "query_sum", d.alias("diff"),
                                 (d / F.when(F.col("query_sum") != 0, F.col("query_sum")) * 100).alias("diff_pct")) \
        .filter((F.col("diff") / F.when(F.col("query_sum") != 0, F.col("query_sum")) > 0.01) & (F.col("query_sum") > 0))


def warehouse_metered(recs: DataFrame, metering: DataFrame) -> DataFrame:
    return recs.select("warehouse_name").join(metering.select("warehouse_name").distinct(), "warehouse_name",
                                              "left_anti")
