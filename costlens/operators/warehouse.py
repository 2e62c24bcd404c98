"""Warehouse analysis: utilisation, idle islands, queueing, schedule, sizing
and auto-suspend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.operators.sketches import RANKS, latency_percentiles
from costlens.plans.rank import exact_percentiles
from costlens.functions import exprs as X


def warehouse_utilisation(load: DataFrame) -> DataFrame:
    total = F.col("avg_running") + F.col("avg_queued_load") + F.col("avg_queued_provisioning") + F.col("avg_blocked")
    return load.select(
        "warehouse_name", F.col("start_time").alias("interval_start"), F.col("end_time").alias("interval_end"),
        "avg_running", "avg_queued_load", "avg_blocked",
        X.safe_divide("avg_running", total).alias("utilisation_pct"),
        X.safe_divide("avg_queued_load", total).alias("queue_ratio"),
        X.safe_divide("avg_blocked", total).alias("blocked_ratio"),
        F.coalesce((F.col("avg_running") == 0) & (total == 0), F.lit(False)).alias("is_idle"))


def idle_islands(util: DataFrame, split_on_gap: bool = False) -> DataFrame:
    """Runs of consecutive idle intervals per warehouse (gaps and islands).

    An idle row belongs to the island keyed by the start of the last "breaker"
    row at or before it: a busy row, or with ``split_on_gap`` an idle row that
    starts after a time gap (suspended warehouse). Rows before any breaker
    share the NULL key. The key comes from windows partitioned by
    (warehouse, day), so a hot warehouse never lands in a single task; a
    per-(warehouse, day) carry table, bounded by days rather than rows, hands
    the last breaker of earlier days across chunk borders.
    """
    rows = util.select("warehouse_name", "interval_start", "interval_end", "is_idle",
                       F.to_date("interval_start").alias("chunk"))
    in_chunk = Window.partitionBy("warehouse_name", "chunk").orderBy("interval_start")
    by_chunk = Window.partitionBy("warehouse_name").orderBy("chunk")
    breaker = ~F.col("is_idle")
    if split_on_gap:
        ends = (rows.groupBy("warehouse_name", "chunk").agg(F.max("interval_end").alias("chunk_end"))
                .select("warehouse_name", "chunk", F.lag("chunk_end").over(by_chunk).alias("prev_chunk_end")))
        rows = rows.join(ends, ["warehouse_name", "chunk"])
        prev_end = F.coalesce(F.lag("interval_end").over(in_chunk), F.col("prev_chunk_end"))
        breaker = breaker | (prev_end.isNotNull() & (F.col("interval_start") > prev_end))
    rows = rows.withColumn("brk", F.when(breaker, F.col("interval_start")))
    rows = rows.withColumn("last_brk", F.max("brk").over(
        in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    carry = (rows.groupBy("warehouse_name", "chunk").agg(F.max("brk").alias("chunk_brk"))
             .select("warehouse_name", "chunk",
                     F.max("chunk_brk").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)).alias("carry")))
    return (rows.filter("is_idle").join(carry, ["warehouse_name", "chunk"])
            .groupBy("warehouse_name", F.coalesce("last_brk", "carry").alias("island"))
            .agg(F.min("interval_start").alias("idle_start"), F.max("interval_end").alias("idle_end")))


def idle_warehouse_periods(util: DataFrame, price: DataFrame, split_on_gap: bool = False) -> DataFrame:
    return idle_costs(idle_islands(util, split_on_gap), price)


def idle_costs(isl: DataFrame, price: DataFrame) -> DataFrame:
    secs = X.seconds_between("idle_start", "idle_end")
    # 1 credit per hour whatever the size (the model's stated assumption)
    out = isl.crossJoin(F.broadcast(price)).select(
        "warehouse_name", "idle_start", "idle_end",
        X.minutes_between("idle_start", "idle_end").alias("idle_duration_minutes"),
        (secs / 3600.0 * 1).alias("wasted_credits"),
        (secs / 3600.0 * 1 * F.col("credit_price_usd")).alias("wasted_cost_usd"))
    return out.filter(F.col("idle_duration_minutes") > 0)


def warehouse_queue_analysis(util: DataFrame) -> DataFrame:
    queued = F.col("avg_queued_load") > 0
    return (util.groupBy("warehouse_name", F.hour("interval_start").cast("long").alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("total_intervals"),
                 F.sum(F.when(queued, 1).otherwise(0)).alias("intervals_with_queue"),
                 F.avg(F.when(queued, F.col("avg_queued_load"))).alias("avg_queue_depth"))
            .select("warehouse_name", "hour_of_day", "total_intervals", "intervals_with_queue",
                    (X.safe_divide(F.col("intervals_with_queue").cast("double"), F.col("total_intervals")) * 100)
                    .alias("queue_frequency_pct"), "avg_queue_depth"))


def warehouse_schedule_analysis(qca: DataFrame) -> DataFrame:
    hourly = (qca.groupBy("warehouse_name", X.dow_sun0("start_time").alias("day_of_week"),
                          F.hour("start_time").cast("long").alias("hour"))
              .agg(F.count(F.lit(1)).alias("query_count"), F.sum("estimated_cost_usd").alias("credits_cost")))
    off_peak = F.col("day_of_week").isin(0, 6) | (F.col("hour") < 6) | (F.col("hour") >= 20)
    return hourly.select(
        "warehouse_name", "day_of_week", "hour", "query_count", "credits_cost", off_peak.alias("is_off_peak"),
        F.when(off_peak & (F.col("query_count") < 5), F.col("credits_cost")).otherwise(0.0)
        .alias("schedulable_savings_usd"))


def sized_runs(qh: DataFrame) -> DataFrame:
    """The successful user queries that a warehouse's size is judged by."""
    return qh.filter((F.col("execution_status") == "SUCCESS") & F.col("warehouse_name").isNotNull()
                     & X.not_like_any("query_text", X.INTERNAL_PREFIXES_ATTRIBUTION))


def warehouse_sizing_analysis(qh: DataFrame, util: DataFrame, approx: bool = False, latency_days: DataFrame | None = None) -> DataFrame:
    """Per-warehouse size, latency percentiles, spill rate and peak hourly
    utilisation. Percentiles are exact by default; ``approx=True`` swaps in
    ``percentile_approx`` (bounded memory per group), and ``latency_days`` the merge of
    the stored sketches of each day."""
    rows = sized_runs(qh)
    ms = F.col("execution_time_ms")

    if latency_days is not None:
        pcts = latency_percentiles(latency_days)
    elif approx:
        pcts = rows.groupBy("warehouse_name").agg(*[F.percentile_approx(ms, p, 10000).cast("double").alias(n) for n, p in RANKS.items()])
    else:
        pcts = exact_percentiles(rows, "warehouse_name", "execution_time_ms", RANKS)
    stats = rows.groupBy("warehouse_name").agg(
        F.coalesce(F.mode("warehouse_size", True), F.max("warehouse_size")).alias("current_size"),
        F.count(F.lit(1)).alias("total_queries"),
        F.avg(ms).alias("avg_exec_ms"),
        F.avg("queued_overload_time_ms").alias("avg_queue_ms"),
        (F.sum(F.when(F.col("bytes_spilled_to_remote_storage") > 0, 1).otherwise(0)).cast("double")
         / F.count(F.lit(1)) * 100).alias("spill_rate_pct"),
        F.avg("bytes_scanned").alias("avg_bytes_scanned"),
        F.count_distinct("user_name").alias("unique_users"),
        F.count_distinct("role_name").alias("unique_roles"))
    peak = (util.groupBy("warehouse_name", F.hour("interval_start").alias("h"))
            .agg(F.avg("utilisation_pct").alias("hourly_utilisation"))
            .groupBy("warehouse_name").agg(F.max("hourly_utilisation").alias("peak_hour_utilisation")))
    return stats.join(pcts, "warehouse_name", "left").join(peak, "warehouse_name", "left").select(
        "warehouse_name", "current_size", "total_queries", "unique_users", "unique_roles", "avg_exec_ms",
        "p50_exec_ms", "p95_exec_ms", "p99_exec_ms", "avg_queue_ms", "spill_rate_pct", "avg_bytes_scanned",
        F.coalesce("peak_hour_utilisation", F.lit(0.0)).alias("peak_hour_utilisation"))


def warehouse_auto_suspend(idle: DataFrame, price: DataFrame) -> DataFrame:
    gaps = idle.groupBy("warehouse_name").agg(
        F.count(F.lit(1)).alias("idle_period_count"),
        F.avg("idle_duration_minutes").alias("avg_idle_minutes"),
        F.sum("wasted_credits").alias("total_idle_credits"),
        F.sum("wasted_cost_usd").alias("total_idle_cost_usd"))
    median = exact_percentiles(idle, "warehouse_name", "idle_duration_minutes", {"median_idle_minutes": 0.5})
    gaps = gaps.join(median.withColumnRenamed("warehouse_name", "_name"), F.col("warehouse_name").eqNullSafe(F.col("_name")))
    rec = X.greatest_strict(F.lit(60.0), X.least_strict(F.col("median_idle_minutes") * 60, F.lit(300.0)))
    return gaps.crossJoin(F.broadcast(price.select(F.lit(1).alias("_p")))).select(
        "warehouse_name", F.lit(60).alias("current_auto_suspend_seconds"),
        F.round(rec).cast("int").alias("recommended_auto_suspend_seconds"),
        "idle_period_count", "avg_idle_minutes",
        F.col("total_idle_credits").alias("monthly_idle_credits"),
        F.col("total_idle_cost_usd").alias("monthly_idle_cost_usd"),
        X.greatest_strict(F.lit(0.0), F.col("total_idle_cost_usd") * 0.3).alias("potential_savings_usd"))
