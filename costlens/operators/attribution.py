"""Cost attribution: daily warehouse credits, serverless credits, the daily cost
rollup, per-query cost, query patterns, team/user/role aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf
from costlens.plans.rank import rank_within

# $23 per TB-month of storage is 0.767 per TB-day; 1 TB = 1024^4 bytes
STORAGE_USD_PER_TB_DAY = 0.767
TB = float(1024 ** 4)


def enterprise_price(credit_pricing: DataFrame, as_of: AsOf, edition: str = "ENTERPRISE") -> DataFrame:
    """One-row frame ``credit_price_usd`` valid at ``as_of`` (empty if none).

    One row of one number: callers cross join it by broadcast. Two valid prices
    are an error."""
    d = as_of.date_col()
    return (credit_pricing
            .filter((F.col("edition") == edition) & d.between(F.col("effective_from"), F.col("effective_to")))
            .agg(F.count(F.lit(1)).alias("n"), F.min("credit_price_usd").alias("p")).filter("n > 0")
            .select(F.when(F.col("n") == 1, F.col("p")).otherwise(
                F.raise_error(F.lit(f"more than one {edition} price is valid at {as_of.date}")).cast("double"))
                .alias("credit_price_usd")))


def with_price(df: DataFrame, price: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(price))


def warehouse_daily_credits(metering: DataFrame, price: DataFrame) -> DataFrame:
    daily = (metering
             .groupBy("warehouse_name", F.to_date("start_time").alias("date"))
             .agg(F.sum("credits_used_compute").alias("credits_compute"),
                  F.sum("credits_used_cloud_services").alias("credits_cloud"),
                  F.sum("credits_used").alias("total_credits")))
    return with_price(daily, price).select(
        "warehouse_name", "date", "credits_compute", "credits_cloud", "total_credits",
        (F.col("total_credits") * F.col("credit_price_usd")).alias("estimated_cost_usd"))


def serverless_credits(pipe: DataFrame, clustering: DataFrame, mv: DataFrame, tasks: DataFrame,
                       search: DataFrame, price: DataFrame) -> DataFrame:
    def part(df, service, obj):
        return df.select(F.lit(service).alias("service_type"), obj.alias("object_name"),
                         F.to_date("start_time").alias("date"), "credits_used")

    def dotted(name_col):
        return F.concat(F.col("database_name"), F.lit("."), F.col("schema_name"), F.lit("."), F.col(name_col))

    allsv = (part(pipe, "SNOWPIPE", F.col("pipe_name"))
             .unionByName(part(clustering, "AUTOMATIC_CLUSTERING", dotted("table_name")))
             .unionByName(part(mv, "MATERIALIZED_VIEW", dotted("table_name")))
             .unionByName(part(tasks, "SERVERLESS_TASK", dotted("task_name")))
             .unionByName(part(search, "SEARCH_OPTIMIZATION", dotted("table_name"))))
    agg = allsv.groupBy("service_type", "object_name", "date").agg(F.sum("credits_used").alias("credits_used"))
    return with_price(agg, price).select(
        "service_type", "object_name", "date", "credits_used",
        (F.col("credits_used") * F.col("credit_price_usd")).alias("estimated_cost_usd"))


def daily_cost_rollup(wh_daily: DataFrame, storage_usage: DataFrame, serverless: DataFrame) -> DataFrame:
    """Compute, storage and serverless cost per day, with trailing means and a
    spike flag. Every side is reduced to day grain before the outer joins, so
    the joins and the date-ordered windows only ever see one row per day."""
    compute = wh_daily.groupBy("date").agg(F.sum("estimated_cost_usd").alias("compute_cost"))
    storage = storage_usage.select(
        F.col("usage_date").alias("date"),
        ((F.col("storage_bytes") + F.col("stage_bytes") + F.col("failsafe_bytes")) / F.lit(TB)
         * STORAGE_USD_PER_TB_DAY).alias("storage_cost"))
    sv = serverless.groupBy("date").agg(F.sum("estimated_cost_usd").alias("serverless_cost"))
    combined = (compute.join(storage, "date", "full_outer")
                .join(sv, "date", "full_outer")
                .filter(F.col("date").isNotNull())
                .select("date",
                        F.coalesce("compute_cost", F.lit(0.0)).alias("compute_cost"),
                        F.coalesce("storage_cost", F.lit(0.0)).alias("storage_cost"),
                        F.coalesce("serverless_cost", F.lit(0.0)).alias("serverless_cost")))
    combined = combined.withColumn(
        "total_cost", F.col("compute_cost") + F.col("storage_cost") + F.col("serverless_cost"))
    w = Window.orderBy("date")
    prev30 = F.avg("total_cost").over(w.rowsBetween(-30, -1))
    return combined.select(
        "date", "compute_cost", "storage_cost", "serverless_cost", "total_cost",
        F.avg("total_cost").over(w.rowsBetween(-6, 0)).alias("rolling_7d_avg"),
        F.avg("total_cost").over(w.rowsBetween(-29, 0)).alias("rolling_30d_avg"),
        F.coalesce(F.col("total_cost") > 2 * prev30, F.lit(False)).alias("is_anomaly"))


def attributable(qh: DataFrame) -> DataFrame:
    """Rows that carry a cost: successful, on a warehouse, with real user text."""
    text = F.col("query_text")
    return qh.filter((F.col("execution_status") == "SUCCESS")
                     & F.col("warehouse_name").isNotNull()
                     & text.isNotNull()
                     & (F.trim(text) != "")
                     & X.not_like_any(text, X.INTERNAL_PREFIXES_ATTRIBUTION))


def query_cost_columns(price_col="credit_price_usd") -> dict:
    """Row-local cost expressions of one query (name -> aliased column)."""
    rate = X.size_credits_per_hour("warehouse_size")
    credits = F.col("execution_time_ms") / 1000.0 / 3600.0 * rate
    cols = {
        "execution_time_s": F.col("execution_time_ms") / 1000.0,
        "partitions_scanned_ratio": X.safe_divide("partitions_scanned", "partitions_total"),
        "credits_per_hour": rate,
        "estimated_credits": credits,
        "estimated_cost_usd": credits * F.col(price_col),
        "query_tag_team": X.tag_team("query_tag"),
    }
    return {k: v.alias(k) for k, v in cols.items()}


def query_cost_attribution(qh: DataFrame, price: DataFrame) -> DataFrame:
    """Per-query credits and cost. The size-to-rate table is a literal map
    expression, not a join; the price is a one-row broadcast."""
    base = with_price(attributable(qh), price)
    cost = query_cost_columns()
    return base.select(
        "query_id", "user_name", "role_name", "warehouse_name", "warehouse_size", "query_type", "query_tag",
        "query_text", "query_parameterized_hash", "start_time", "end_time", "execution_time_ms",
        cost["execution_time_s"], "bytes_scanned", "rows_produced", "partitions_scanned", "partitions_total",
        cost["partitions_scanned_ratio"], "bytes_spilled_to_local_storage", "bytes_spilled_to_remote_storage",
        cost["credits_per_hour"], cost["estimated_credits"], cost["estimated_cost_usd"], cost["query_tag_team"])


def query_patterns(qca: DataFrame) -> DataFrame:
    """Daily execution groups per parameterised hash, with the latest text of
    the hash. The latest text is a ``max_by`` aggregate (partial aggregation
    absorbs a hot hash) rather than a window that shuffles every text."""
    keyed = qca.filter(F.col("query_parameterized_hash").isNotNull())
    groups = (keyed.groupBy("query_parameterized_hash", "query_type", "warehouse_name",
                            F.to_date("start_time").alias("query_date"))
              .agg(F.count(F.lit(1)).alias("execution_count"),
                   F.avg("execution_time_s").alias("avg_execution_time_s"),
                   F.sum("estimated_cost_usd").alias("total_cost_usd"),
                   F.avg("estimated_cost_usd").alias("avg_cost_per_execution"),
                   F.avg("bytes_scanned").alias("avg_bytes_scanned"),
                   F.max("bytes_spilled_to_remote_storage").alias("max_bytes_spilled_remote"),
                   F.max("user_name").alias("sample_user_name"),
                   F.max("query_id").alias("sample_query_id")))
    latest = (keyed.filter(F.col("query_text").isNotNull())
              .groupBy("query_parameterized_hash")
              .agg(F.max_by("query_text", F.struct("start_time", "query_id")).alias("sample_query_text")))
    return groups.join(latest, "query_parameterized_hash", "left").select(
        F.col("query_parameterized_hash").alias("query_hash"), "query_type", "warehouse_name", "query_date",
        "execution_count", "avg_execution_time_s", "total_cost_usd", "avg_cost_per_execution",
        "avg_bytes_scanned", "max_bytes_spilled_remote", "sample_user_name", "sample_query_id",
        "sample_query_text", (F.col("execution_count") > 5).alias("is_repeated"))


def derived_team(tag_team="query_tag_team", role="role_name", wh="warehouse_name"):
    return F.coalesce(F.col(tag_team), X.role_team_attribution(role), X.warehouse_team(wh))


def team_cost_attribution(qca: DataFrame) -> DataFrame:
    grouped = (qca.withColumn("team_name", derived_team())
               .groupBy("team_name", "warehouse_name", "role_name",
                        F.trunc(F.to_date("start_time"), "month").alias("month"))
               .agg(F.sum("estimated_cost_usd").alias("compute_cost"),
                    F.count(F.lit(1)).alias("total_queries"),
                    F.count_distinct("user_name").alias("unique_users")))
    # grouped rows are few per month: a month-partitioned window is cheap here
    month_total = F.sum("compute_cost").over(Window.partitionBy("month"))
    return grouped.select(
        "team_name", "warehouse_name", "role_name", "month", "compute_cost",
        F.lit(0).cast("long").alias("storage_cost"), F.col("compute_cost").alias("total_cost"),
        "total_queries", "unique_users",
        (X.safe_divide(F.col("compute_cost"), month_total) * 100).alias("pct_of_total"))


def user_cost_summary(qca: DataFrame) -> DataFrame:
    per = (qca.groupBy("user_name", F.trunc(F.to_date("start_time"), "month").alias("month"))
           .agg(F.count(F.lit(1)).alias("total_queries"),
                F.sum("estimated_cost_usd").alias("total_cost_usd"),
                F.avg("estimated_cost_usd").alias("avg_cost_per_query"),
                F.sum("bytes_scanned").alias("total_bytes_scanned"),
                F.avg("execution_time_s").alias("avg_execution_time_s")))
    return rank_within(per, "month", "total_cost_usd", "cost_rank")


def warehouse_role_usage(qh: DataFrame) -> DataFrame:
    """Distinct (warehouse, role, user) with usage counts and a role-derived
    team. The DISTINCT set is the key set of one aggregate, so one shuffle."""
    rows = qh.filter(F.col("warehouse_name").isNotNull()
                     & F.col("role_name").isNotNull()
                     & F.col("user_name").isNotNull()
                     & X.not_like_any("query_text", X.INTERNAL_PREFIXES_STAGING))
    return (rows.groupBy("warehouse_name", "role_name", "user_name")
            .agg(F.count(F.lit(1)).alias("query_count"),
                 F.min("start_time").alias("first_seen"),
                 F.max("end_time").alias("last_seen"))
            .withColumn("derived_team_name", X.role_team_staging("role_name")))
