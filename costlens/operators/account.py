"""Account statistics, scenario verification and the config-table inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf

# FIXED VALUES: the publication tables whose row counts are verified.
PUBLICATION_TABLES = [
    "cost_summary", "cost_trends_daily", "cost_by_query_type", "cost_by_user", "cost_by_warehouse",
    "warehouse_efficiency", "team_cost_dashboard", "warehouse_recommendations", "query_optimization_candidates",
    "antipattern_summary", "all_recommendations", "storage_analysis", "cost_forecast_monthly", "data_freshness",
    "recommendation_roi", "weekly_executive_report", "alert_history",
]
RECENT_HOURS = 2
TAG_NEWEST = 50
INDICATOR_DAYS = 7


def query_stats(qh: DataFrame, as_of: AsOf, days: int = 90) -> DataFrame:
    r = qh.filter(F.col("start_time") >= as_of.ts_col() - F.expr(f"INTERVAL {days} DAYS"))
    return r.agg(F.count(F.lit(1)).alias("total_queries"), F.count_distinct("user_name").alias("distinct_users"),
                 F.count_distinct("warehouse_name").alias("distinct_warehouses"),
                 F.count_distinct("role_name").alias("distinct_roles"),
                 F.count_distinct("database_name").alias("distinct_databases"),
                 F.min("start_time").alias("first_query"), F.max("start_time").alias("last_query"),
                 (F.sum("total_elapsed_time_ms") / 3600000.0).alias("total_elapsed_hours"))


def metering_totals(metering: DataFrame) -> DataFrame:
    return metering.groupBy("warehouse_name").agg(
        F.sum("credits_used").alias("total_credits"), F.sum("credits_used_compute").alias("compute_credits"),
        F.sum("credits_used_cloud_services").alias("cloud_credits"), F.count(F.lit(1)).alias("metered_hours"))


def top_tables(tables: DataFrame, n: int = 10) -> DataFrame:
    """Largest live tables per database; ``row_number <= n`` plans as a
    WindowGroupLimit, so each task keeps n rows per database."""
    live = tables.filter(F.col("table_dropped").isNull())
    w = Window.partitionBy("database_name").orderBy(F.col("active_bytes").desc(), F.col("table_name"))
    return (live.select("database_name", "schema_name", "table_name", "active_bytes",
                        F.row_number().over(w).alias("size_rank"))
            .filter(F.col("size_rank") <= n))


def _tag_map():
    return F.str_to_map(F.col("query_tag"), F.lit(";"), F.lit(":"))


def tagged_queries(qh: DataFrame, as_of: AsOf, hours: int = RECENT_HOURS, n: int = TAG_NEWEST) -> DataFrame:
    r = qh.filter(F.col("query_tag").like("%scenario:%")
                  & (F.col("start_time") >= as_of.ts_col() - F.expr(f"INTERVAL {hours} HOURS")))
    return (r.select("query_id", "query_tag", "start_time", "warehouse_name", "execution_status",
                     F.element_at(_tag_map(), F.lit("scenario")).alias("scenario"))
            .orderBy(F.col("start_time").desc(), "query_id").limit(n))


def indicators(qh: DataFrame, as_of: AsOf, days: int = INDICATOR_DAYS) -> DataFrame:
    r = qh.filter(F.col("query_tag").like("%scenario:%")
                  & (F.col("start_time") >= as_of.ts_col() - F.expr(f"INTERVAL {days} DAYS")))
    return r.agg(
        F.count_if(F.upper(F.trim("query_text")).startswith("SELECT *")).alias("select_star_queries"),
        F.count_if((F.col("bytes_spilled_to_local_storage") > 0) | (F.col("bytes_spilled_to_remote_storage") > 0))
        .alias("spilling_queries"),
        F.count_if(F.col("partitions_scanned") > F.col("partitions_total") * 0.8).alias("full_scan_queries"),
        F.count(F.lit(1)).alias("total_queries"))


def recent_metering(metering: DataFrame, as_of: AsOf, hours: int = RECENT_HOURS) -> DataFrame:
    return (metering.filter(F.col("start_time") >= as_of.ts_col() - F.expr(f"INTERVAL {hours} HOURS"))
            .groupBy("warehouse_name").agg(F.sum("credits_used").alias("credits_used")))


def publication_counts(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("status", F.when(F.col("row_count") > 0, "OK").otherwise("EMPTY"))


def seed_inventory(p) -> DataFrame:
    """Row and column counts of every config table (the seed load), and how many rows
    of the telemetry or of the models built on it find a partner in the table."""
    used = {
        "alert_configuration": (p["alert_union"], "alert_id", "alert_id"),
        "warehouse_size_credits": (p["stg_query_history"].withColumn("size", F.replace(F.upper("warehouse_size"), F.lit("-"), F.lit(""))), "size", "warehouse_size"),
        "warehouse_team_mapping": (p["stg_warehouse_metering"], "warehouse_name", "warehouse_name"),
        "recommendation_actions": (p["all_recommendations"], "recommendation_id", "recommendation_id")}
    out = None
    for name in ("credit_pricing", "alert_configuration", "alert_suppressions", "bank_holidays",
                 "warehouse_size_credits", "warehouse_team_mapping", "monthly_budget", "recommendation_actions"):
        df = p.seed(name)
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("seed_name"), "row_count", F.lit(len(df.columns)).cast("long").alias("column_count"))
        if name in used:
            rows, column, key = used[name]
            hits = rows.join(df.select(F.col(key).alias("_key")).distinct(), F.col(column) == F.col("_key"), "left_semi")
            one = one.crossJoin(hits.agg(F.count(F.lit(1)).alias("matched_rows")))
        else:
            one = one.withColumn("matched_rows", F.lit(0).cast("long"))
        out = one if out is None else out.unionByName(one)
    return out
