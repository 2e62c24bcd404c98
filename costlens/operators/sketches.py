"""Mergeable sketches of the query history, a row per day and group.

A sketch is written with its day's layer and merged over any span of days, so a month's
percentiles and distinct users cost the size of the sketches and not of the history.

Latency: KLL, k = 2000. At 99 % confidence the rank of a returned value is within 0.14 %
of the rows of the wanted rank (2.296 / k ** 0.9723); up to k rows it is exact.
Users: HyperLogLog of 4,096 registers, relative standard error 1.04 / 64 = 1.6 %."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.operators.attribution import derived_team

KLL_K, HLL_LG = 2000, 12
#: Bounds that the checks hold the sketches against: over three times what is expected.
RANK_BOUND, USERS_BOUND = 0.005, 0.08
RANKS = {"p50_exec_ms": 0.5, "p95_exec_ms": 0.95, "p99_exec_ms": 0.99}


def latency_days(rows: DataFrame) -> DataFrame:
    """warehouse_name, date, queries, latency: one KLL sketch of the execution times of
    a warehouse's day. Rows without a time are not counted."""
    return rows.filter(F.col("execution_time_ms").isNotNull()).groupBy("warehouse_name", F.to_date("start_time").alias("date")).agg(
        F.count(F.lit(1)).alias("queries"), F.kll_sketch_agg_bigint("execution_time_ms", F.lit(KLL_K)).alias("latency"))


def latency_percentiles(days: DataFrame) -> DataFrame:
    """The percentiles of ``RANKS`` per warehouse over all days given."""
    merged = days.groupBy("warehouse_name").agg(F.kll_merge_agg_bigint("latency").alias("latency"))
    return merged.select("warehouse_name", *[F.kll_sketch_get_quantile_bigint("latency", F.lit(r)).cast("double").alias(n) for n, r in RANKS.items()])


def team_user_days(qca: DataFrame) -> DataFrame:
    """team_name, date, users: one sketch of the users of a team's day."""
    return qca.withColumn("team_name", derived_team()).groupBy("team_name", F.to_date("start_time").alias("date")).agg(
        F.hll_sketch_agg("user_name", F.lit(HLL_LG)).alias("users"))


def team_distinct_users(days: DataFrame) -> DataFrame:
    """team_name, month, distinct_users."""
    return days.groupBy("team_name", F.trunc("date", "month").alias("month")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("distinct_users"))


def _within(low: Column, high: Column, rank: float, n: Column) -> Column:
    """Some rank of a value that stands at ranks low to high is near enough."""
    return (low <= (F.lit(rank) + RANK_BOUND) * n + 1) & (high >= (F.lit(rank) - RANK_BOUND) * n - 1)


def latency_bounds(rows: DataFrame, percentiles: DataFrame) -> DataFrame:
    """Per warehouse, its rows and whether each sketched percentile has a rank within
    the bound: counted exactly over the rows."""
    found = rows.filter(F.col("execution_time_ms").isNotNull()).join(F.broadcast(percentiles), "warehouse_name")
    counts = [F.count_if(F.col("execution_time_ms") < F.col(c)).alias(f"{c}_less") for c in RANKS]
    counts += [F.count_if(F.col("execution_time_ms") <= F.col(c)).alias(f"{c}_upto") for c in RANKS]
    per = found.groupBy("warehouse_name").agg(F.count(F.lit(1)).alias("queries"), *counts)
    return per.select("warehouse_name", "queries", *[
        _within(F.col(f"{c}_less"), F.col(f"{c}_upto"), r, F.col("queries")).alias(f"{c[:3]}_within") for c, r in RANKS.items()])


def team_user_bounds(qca: DataFrame, sketched: DataFrame) -> DataFrame:
    """Per team and month, its exact distinct users and whether the sketch is near."""
    exact = qca.withColumn("team_name", derived_team()).groupBy("team_name", F.trunc(F.to_date("start_time"), "month").alias("month")).agg(
        F.count_distinct("user_name").alias("users"))
    near = F.abs(F.col("distinct_users") - F.col("users")) <= F.lit(USERS_BOUND) * F.col("users") + 1
    return exact.join(sketched, ["team_name", "month"]).select("team_name", "month", "users", near.alias("within"))
