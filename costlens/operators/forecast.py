"""Forecasting, seasonality baselines and source freshness.

All regressions run on day- or month-grain aggregates (at most a few hundred
rows), so the unpartitioned windows and one-row cross joins here are bounded
by the calendar, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf


def _history(rollup: DataFrame, as_of: AsOf, days: int = 90) -> DataFrame:
    today = as_of.date_col()
    return rollup.filter((F.col("date") >= F.date_sub(today, days)) & (F.col("date") < today))


def cost_forecast_daily(spark: SparkSession, rollup: DataFrame, as_of: AsOf, horizon: int = 90) -> DataFrame:
    hist = _history(rollup, as_of)
    hist = hist.withColumn("day_offset", F.datediff("date", F.min("date").over(Window.partitionBy())))
    aggs = []
    for c in ("total", "compute", "storage", "serverless"):
        y = F.col(f"{c}_cost")
        aggs += [F.regr_slope(y, "day_offset").alias(f"{c}_slope"),
                 F.regr_intercept(y, "day_offset").alias(f"{c}_intercept"),
                 F.stddev_samp(y).alias(f"{c}_stddev")]
    reg = hist.agg(*aggs, F.max("day_offset").alias("max_offset"))
    days = spark.range(1, horizon + 1).select(F.col("id").alias("n"))
    x = F.col("n") + F.col("max_offset") + 1

    def pred(c):
        return F.col(f"{c}_intercept") + F.col(f"{c}_slope") * x

    return days.crossJoin(F.broadcast(reg)).select(
        F.date_add(as_of.date_col(), F.col("n").cast("int")).alias("forecast_date"),
        x.alias("projected_offset"),
        X.greatest_strict(F.lit(0.0), pred("total")).alias("predicted_total_cost"),
        X.greatest_strict(F.lit(0.0), pred("compute")).alias("predicted_compute_cost"),
        X.greatest_strict(F.lit(0.0), pred("storage")).alias("predicted_storage_cost"),
        X.greatest_strict(F.lit(0.0), pred("serverless")).alias("predicted_serverless_cost"),
        X.greatest_strict(F.lit(0.0), pred("total") - 1.96 * F.col("total_stddev")).alias("ci_lower"),
        (pred("total") + 1.96 * F.col("total_stddev")).alias("ci_upper"),
        F.col("total_slope").alias("daily_trend"), F.col("total_stddev").alias("forecast_stddev"),
        as_of.ts_col().alias("generated_at"))


def cost_seasonality_baseline(rollup: DataFrame, as_of: AsOf) -> DataFrame:
    dd = _history(rollup, as_of).select(
        F.col("date").alias("cost_date"), "total_cost", X.dow_sun0("date").alias("day_of_week"),
        F.dayofmonth("date").cast("long").alias("day_of_month"),
        (F.col("date") >= F.date_sub(F.last_day("date"), 3)).alias("is_month_end"))
    dow = dd.groupBy("day_of_week").agg(F.avg("total_cost").alias("dow_avg_cost"),
                                        F.stddev_samp("total_cost").alias("dow_stddev"))
    dom = dd.groupBy("day_of_month").agg(F.avg("total_cost").alias("dom_avg_cost"),
                                         F.stddev_samp("total_cost").alias("dom_stddev"))
    me = dd.filter("is_month_end").agg(F.avg("total_cost").alias("month_end_avg_cost"),
                                       F.stddev_samp("total_cost").alias("month_end_stddev"))
    bounds = dd.agg(F.min("cost_date").alias("min_date"))
    weekly = (dd.groupBy(F.date_trunc("week", "cost_date").cast("date").alias("week_start"))
              .agg(F.sum("total_cost").alias("weekly_cost"))
              .crossJoin(F.broadcast(bounds))
              .withColumn("week_offset", X.weeks_between("min_date", "week_start")))
    trend = weekly.agg(F.regr_slope("weekly_cost", "week_offset").alias("wow_growth_slope"),
                       F.max("week_offset").alias("max_week_offset"))
    ones = F.broadcast(me.crossJoin(trend).crossJoin(bounds))
    j = (dd.join(F.broadcast(dow), "day_of_week", "left").join(F.broadcast(dom), "day_of_month", "left")
         .crossJoin(ones))
    z = F.lit(0.0)
    dow_sd = F.coalesce("dow_stddev", z)
    me_sd = F.coalesce("month_end_stddev", z)
    return j.select(
        F.col("cost_date").alias("date"), "total_cost", "day_of_week", "day_of_month", "is_month_end",
        F.coalesce("dow_avg_cost", z).alias("dow_avg_cost"), dow_sd.alias("dow_stddev"),
        F.coalesce("dom_avg_cost", z).alias("dom_avg_cost"), F.coalesce("dom_stddev", z).alias("dom_stddev"),
        F.coalesce("month_end_avg_cost", z).alias("month_end_avg_cost"), me_sd.alias("month_end_stddev"),
        F.coalesce("wow_growth_slope", z).alias("wow_growth_slope"),
        (F.coalesce("dow_avg_cost", z) + F.coalesce("wow_growth_slope", z)
         * (X.weeks_between("min_date", "cost_date") - F.coalesce("max_week_offset", F.lit(0)) / 2.0) / 7.0)
        .alias("adjusted_baseline"),
        F.when(F.col("is_month_end") & (me_sd > dow_sd), me_sd).otherwise(dow_sd).alias("effective_stddev"))


def team_cost_forecast(spark: SparkSession, team_costs: DataFrame, as_of: AsOf, horizon: int = 3,
                       aligned: bool = False) -> DataFrame:
    """Monthly line per team, ``horizon`` months ahead. The model projects each month
    """
    monthly = team_costs.groupBy("team_name", "month").agg(F.sum("total_cost").alias("monthly_cost"))
    monthly = monthly.withColumn("month_offset", X.months_between_boundaries(
        F.min("month").over(Window.partitionBy("team_name")), F.col("month")))
    reg = (monthly.groupBy("team_name")
           .agg(F.regr_slope("monthly_cost", "month_offset").alias("slope"),
                F.regr_intercept("monthly_cost", "month_offset").alias("intercept"),
                F.stddev_samp("monthly_cost").alias("stddev"), F.max("month_offset").alias("max_offset"),
                F.count(F.lit(1)).alias("data_months"), F.max("month").alias("latest_month"))
           .filter(F.col("data_months") >= 2))
    months = spark.range(1, horizon + 1).select(F.col("id").cast("int").alias("n"))
    x = F.col("n") + F.col("max_offset") + (0 if aligned else 1)
    pred = F.col("intercept") + F.col("slope") * x
    return reg.crossJoin(F.broadcast(months)).select(
        "team_name", F.add_months("latest_month", F.col("n")).alias("forecast_month"), x.alias("projected_offset"),
        X.greatest_strict(F.lit(0.0), pred).alias("predicted_monthly_cost"),
        X.greatest_strict(F.lit(0.0), pred - 1.96 * F.col("stddev")).alias("ci_lower"),
        (pred + 1.96 * F.col("stddev")).alias("ci_upper"), F.col("slope").alias("monthly_trend"),
        "data_months", as_of.ts_col().alias("generated_at"))


def cost_forecast_monthly(forecast: DataFrame, rollup: DataFrame, as_of: AsOf) -> DataFrame:
    today = as_of.date_col()
    month = lambda c: F.trunc(c, "month")
    fc = forecast.groupBy(month("forecast_date").alias("month")).agg(
        F.sum("predicted_total_cost").alias("total_cost"), F.sum("predicted_compute_cost").alias("compute_cost"),
        F.sum("predicted_storage_cost").alias("storage_cost"),
        F.sum("predicted_serverless_cost").alias("serverless_cost"),
        F.sum("ci_lower").alias("ci_lower"), F.sum("ci_upper").alias("ci_upper")).withColumn("data_type", F.lit("FORECAST"))
    act = (rollup.filter(F.col("date") >= F.add_months(F.trunc(today, "month"), -3))
           .groupBy(month("date").alias("month"))
           .agg(F.sum("total_cost").alias("total_cost"), F.sum("compute_cost").alias("compute_cost"),
                F.sum("storage_cost").alias("storage_cost"), F.sum("serverless_cost").alias("serverless_cost"))
           .withColumn("ci_lower", F.lit(None).cast("double")).withColumn("ci_upper", F.lit(None).cast("double"))
           .withColumn("data_type", F.lit("ACTUAL")))
    year_start = F.trunc(today, "year")
    ytd = rollup.filter((F.col("date") >= year_start) & (F.col("date") < today)).agg(
        F.coalesce(F.sum("total_cost"), F.lit(0.0)).alias("ytd_actual"))
    rest = forecast.filter((F.col("forecast_date") >= today) & (F.col("forecast_date") < F.add_months(year_start, 12))).agg(
        F.coalesce(F.sum("predicted_total_cost"), F.lit(0.0)).alias("remaining_forecast"))
    cols = ["month", "data_type", "total_cost", "compute_cost", "storage_cost", "serverless_cost", "ci_lower", "ci_upper"]
    return (act.select(cols).unionByName(fc.select(cols))
            .crossJoin(F.broadcast(ytd.crossJoin(rest)))
            .select(*cols, (F.col("ytd_actual") + F.col("remaining_forecast")).alias("projected_annual_spend")))


def _status(minutes) -> F.Column:
    m = X.col(minutes)
    return F.when(m < 30, "FRESH").when(m < 60, "STALE").otherwise("CRITICAL")


FRESHNESS_SOURCES = [
    # (source_name, model_name, staging key, time column)
    ("query_history", "stg__query_history", "stg_query_history", "end_time"),
    ("warehouse_metering_history", "stg__warehouse_metering_history", "stg_warehouse_metering", "end_time"),
    ("storage_usage", "stg__storage_usage", "stg_storage_usage", "usage_date"),
    ("warehouse_load_history", "stg__warehouse_load_history", "stg_warehouse_load", "start_time"),
    ("login_history", "stg__login_history", "stg_login_history", "event_timestamp"),
    ("database_storage_usage_history", "stg__database_storage_usage_history", "stg_database_storage", "usage_date"),
]


def data_freshness_monitor(frames: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    parts = None
    for source, model_name, key, tcol in FRESHNESS_SOURCES:
        one = frames[key].agg(F.max(F.col(tcol).cast("timestamp_ntz")).alias("latest_record_at")).select(
            F.lit(source).alias("source_name"), F.lit(model_name).alias("model_name"), "latest_record_at")
        parts = one if parts is None else parts.unionByName(one)
    stale = X.minutes_between("latest_record_at", as_of.ts_col())
    return parts.select("source_name", "model_name", "latest_record_at", stale.alias("staleness_minutes"),
                        _status(stale).alias("freshness_status"), as_of.ts_col().alias("checked_at"))


def data_freshness(monitor: DataFrame) -> DataFrame:
    overall = monitor.agg(F.max("staleness_minutes").alias("overall_max_staleness_minutes"),
                          F.min("latest_record_at").alias("overall_oldest_record_at"))
    overall = overall.withColumn("overall_freshness_status", _status("overall_max_staleness_minutes"))
    return monitor.crossJoin(F.broadcast(overall)).select(
        "source_name", "model_name", "latest_record_at", "staleness_minutes", "freshness_status", "checked_at",
        "overall_freshness_status", "overall_max_staleness_minutes", "overall_oldest_record_at")
