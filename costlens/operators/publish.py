"""Publication rollups: monthly summary, daily trends, cost by type / user /
warehouse, warehouse efficiency, team dashboard and the weekly report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.plans.rank import exact_percentiles, rank_within
from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf


def cost_summary(rollup: DataFrame) -> DataFrame:
    monthly = rollup.groupBy(F.trunc("date", "month").alias("month")).agg(
        F.sum("compute_cost").alias("compute_cost"), F.sum("storage_cost").alias("storage_cost"),
        F.sum("serverless_cost").alias("serverless_cost"), F.sum("total_cost").alias("total_cost"))
    prev = F.lag("total_cost").over(Window.orderBy("month"))  # month grain: bounded by the calendar
    return monthly.select(
        "month", "compute_cost", "storage_cost", "serverless_cost", "total_cost", prev.alias("prev_month_total"),
        F.coalesce(X.safe_divide(F.col("total_cost") - prev, prev) * 100, F.lit(0.0)).alias("mom_change_pct"),
        (X.safe_divide("compute_cost", "total_cost") * 100).alias("compute_pct"),
        (X.safe_divide("storage_cost", "total_cost") * 100).alias("storage_pct"),
        (X.safe_divide("serverless_cost", "total_cost") * 100).alias("serverless_pct"))


def cost_trends_daily(rollup: DataFrame) -> DataFrame:
    return rollup.select("date", "compute_cost", "storage_cost", "serverless_cost", "total_cost", "rolling_7d_avg",
                         "rolling_30d_avg", "is_anomaly", X.dow_sun0("date").alias("day_of_week"),
                         F.lit(0).alias("hour_of_day"), F.date_trunc("week", "date").cast("date").alias("week_start"))


def cost_by_query_type(qca: DataFrame) -> DataFrame:
    total = qca.agg(F.sum("estimated_cost_usd").alias("_all"))
    g = qca.groupBy("query_type").agg(
        F.count(F.lit(1)).alias("query_count"), F.sum("estimated_cost_usd").alias("total_cost_usd"),
        F.avg("estimated_cost_usd").alias("avg_cost_per_query"), F.avg("execution_time_s").alias("avg_duration_s"),
        F.sum("bytes_scanned").alias("total_bytes_scanned"), F.avg("bytes_scanned").alias("avg_bytes_scanned"))
    return g.crossJoin(F.broadcast(total)).select(
        "query_type", "query_count", "total_cost_usd", "avg_cost_per_query", "avg_duration_s", "total_bytes_scanned",
        "avg_bytes_scanned", (X.safe_divide("total_cost_usd", "_all") * 100).alias("pct_of_total_cost"))


def cost_by_user(ucs: DataFrame, qca: DataFrame, top: int = 5) -> DataFrame:
    """Per-user totals plus the user's most expensive queries as an ordered
    array. ``row_number <= 5`` per user plans as a WindowGroupLimit, so each
    task keeps only 5 rows per user before the shuffle."""
    users = ucs.groupBy("user_name").agg(
        F.sum("total_queries").alias("total_queries"), F.sum("total_cost_usd").alias("total_cost_usd"),
        F.avg("avg_cost_per_query").alias("avg_cost_per_query"),
        F.sum("total_bytes_scanned").alias("total_bytes_scanned"),
        F.avg("avg_execution_time_s").alias("avg_execution_time_s"))
    w = Window.partitionBy("user_name").orderBy(F.col("estimated_cost_usd").desc(), F.col("query_id").asc())
    top_q = (qca.select("user_name", "query_id", "query_type", "estimated_cost_usd", "execution_time_s",
                        F.row_number().over(w).alias("cost_rank"))
             .filter(F.col("cost_rank") <= top)
             .groupBy("user_name")
             .agg(F.array_sort(F.collect_list(F.struct(
                 "cost_rank", "query_id", "query_type", X.round4("estimated_cost_usd").alias("cost_usd"),
                 X.round4("execution_time_s").alias("execution_time_s")))).alias("_top")))
    ranked = users.join(top_q, "user_name", "left")
    ranked = rank_within(ranked.withColumn("_all", F.lit(1)), "_all", "total_cost_usd", "overall_cost_rank")
    return ranked.select(
        "user_name", "total_queries", "total_cost_usd", "avg_cost_per_query", "total_bytes_scanned",
        "avg_execution_time_s", "overall_cost_rank",
        # a user without queries (NULL user) gets one empty object, as the model does
        F.coalesce(F.to_json(F.transform("_top", lambda t: t.dropFields("cost_rank"))), F.lit("[{}]"))
        .alias("top_5_expensive_queries"))


def cost_by_warehouse(wh_daily: DataFrame, util: DataFrame, qca: DataFrame) -> DataFrame:
    credits = wh_daily.groupBy("warehouse_name").agg(
        F.sum("total_credits").alias("total_credits"), F.sum("estimated_cost_usd").alias("total_cost_usd"),
        F.sum("credits_compute").alias("compute_credits"), F.sum("credits_cloud").alias("cloud_credits"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    u = util.groupBy("warehouse_name").agg(
        F.avg("utilisation_pct").alias("avg_utilisation_pct"),
        (F.sum(F.when(F.col("is_idle"), 1).otherwise(0)).cast("double") / F.count(F.lit(1)) * 100).alias("idle_pct"),
        (F.avg("queue_ratio") * 100).alias("avg_queue_pct"))
    q = qca.groupBy("warehouse_name").agg(
        F.count(F.lit(1)).alias("total_queries"), F.avg("estimated_cost_usd").alias("avg_query_cost_usd"))
    q = q.join(exact_percentiles(qca, "warehouse_name", "execution_time_s", {"median_execution_time_s": 0.5}), "warehouse_name", "left")
    z = F.lit(0.0)
    return credits.join(u, "warehouse_name", "left").join(q, "warehouse_name", "left").select(
        "warehouse_name", "total_credits", "total_cost_usd", "compute_credits", "cloud_credits",
        F.coalesce("avg_utilisation_pct", z).alias("avg_utilisation_pct"), F.coalesce("idle_pct", z).alias("idle_pct"),
        F.coalesce("avg_queue_pct", z).alias("avg_queue_pct"),
        F.coalesce("total_queries", F.lit(0)).alias("total_queries"),
        F.coalesce("avg_query_cost_usd", z).alias("avg_query_cost_usd"),
        F.coalesce("median_execution_time_s", z).alias("median_execution_time_s"), "first_date", "last_date")


# FIXED VALUES: efficiency advice texts.
ADVICE_IDLE = "High idle time — consider reducing auto-suspend timeout"
ADVICE_QUEUE = "Frequent queuing — consider scaling up or multi-cluster"
ADVICE_SPILL = "Frequent query spills — consider larger warehouse for heavy queries"
ADVICE_OK = "Warehouse is operating efficiently"


def warehouse_efficiency(util: DataFrame, qca: DataFrame) -> DataFrame:
    u = util.groupBy("warehouse_name").agg(
        F.avg("utilisation_pct").alias("avg_utilisation"),
        (F.sum(F.when(F.col("is_idle"), 1).otherwise(0)).cast("double") / F.count(F.lit(1))).alias("idle_ratio"),
        F.avg("queue_ratio").alias("avg_queue_ratio"), F.avg("blocked_ratio").alias("avg_blocked_ratio"))
    s = qca.groupBy("warehouse_name").agg(
        (F.sum(F.when(F.col("bytes_spilled_to_remote_storage") > 0, 1).otherwise(0)).cast("double")
         / F.count(F.lit(1))).alias("spill_ratio"))
    z = F.lit(0.0)
    idle, queue = F.coalesce("idle_ratio", z), F.coalesce("avg_queue_ratio", z)
    spill, blocked = F.coalesce("spill_ratio", z), F.coalesce("avg_blocked_ratio", z)
    score = F.greatest(z, F.least(F.lit(100.0), 100 - idle * 40 - queue * 30 - spill * 20 - blocked * 10))
    return u.join(s, "warehouse_name", "left").select(
        "warehouse_name", (F.coalesce("avg_utilisation", z) * 100).alias("utilisation_pct"),
        (idle * 100).alias("idle_pct"), (queue * 100).alias("queue_pct"), (blocked * 100).alias("blocked_pct"),
        (spill * 100).alias("spill_pct"), score.alias("efficiency_score"),
        F.when(idle > 0.5, ADVICE_IDLE).when(queue > 0.1, ADVICE_QUEUE).when(spill > 0.1, ADVICE_SPILL)
        .otherwise(ADVICE_OK).alias("primary_recommendation"))


def team_cost_dashboard(tca: DataFrame, distinct_users: DataFrame | None = None) -> DataFrame:
    """Monthly cost per team. ``unique_users`` adds the users of each warehouse and role,
    as the model does; ``distinct_users`` (team_name, month, distinct_users) adds the
    column of that name, in which a user of several counts once."""
    tm = tca.groupBy("team_name", "month").agg(
        F.sum("compute_cost").alias("monthly_cost"), F.sum("total_queries").alias("total_queries"),
        F.sum("unique_users").alias("unique_users"))
    prev = F.lag("monthly_cost").over(Window.partitionBy("team_name").orderBy("month"))
    month_total = F.sum("monthly_cost").over(Window.partitionBy("month"))
    extra = []
    if distinct_users is not None:
        tm, extra = tm.join(distinct_users, ["team_name", "month"], "left"), ["distinct_users"]
    return tm.select(
        "team_name", "month", "monthly_cost", "total_queries", "unique_users", *extra,
        (X.safe_divide(F.col("monthly_cost"), month_total) * 100).alias("pct_of_total"),
        prev.alias("prev_month_cost"),
        F.coalesce(X.safe_divide(F.col("monthly_cost") - prev, prev) * 100, F.lit(0.0)).alias("mom_change_pct"),
        F.rank().over(Window.partitionBy("month").orderBy(F.col("monthly_cost").desc())).alias("cost_rank"))


def weekly_executive_report(rollup: DataFrame, by_wh: DataFrame, recs: DataFrame, tracker: DataFrame,
                            as_of: AsOf) -> DataFrame:
    today = as_of.date_col()
    week = F.date_trunc("week", today).cast("date")
    tw = rollup.filter((F.col("date") >= week) & (F.col("date") < today)).agg(
        F.sum("total_cost").alias("tw"), F.sum("compute_cost").alias("twc"), F.sum("storage_cost").alias("tws"),
        F.sum("serverless_cost").alias("twv"))
    lw = rollup.filter((F.col("date") >= F.date_sub(week, 7)) & (F.col("date") < week)).agg(
        F.sum("total_cost").alias("lw"))
    top_wh = (by_wh.orderBy(F.col("total_cost_usd").desc(), F.col("warehouse_name")).limit(3)
              .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(
                  (-F.col("total_cost_usd")).alias("k"), "warehouse_name", X.round4("total_cost_usd").alias("total_cost_usd")))),
                  lambda x: x.dropFields("k"))).alias("top_warehouses_json")))
    top_sv = (recs.orderBy(F.col("estimated_monthly_savings_usd").desc(), F.col("recommendation_id")).limit(3)
              .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(
                  (-F.col("estimated_monthly_savings_usd")).alias("k"), F.col("recommendation_id").alias("k2"),
                  "recommendation_id", "category", "target_object",
                  X.round4("estimated_monthly_savings_usd").alias("estimated_monthly_savings_usd")))),
                  lambda x: x.dropFields("k", "k2"))).alias("top_savings_json")))
    alerts = tracker.filter(F.col("is_new_episode") & (F.col("detected_at") >= F.date_sub(today, 7))).agg(
        F.count(F.lit(1)).alias("active_alert_count"))
    unreal = recs.agg(F.coalesce(F.sum("estimated_monthly_savings_usd"), F.lit(0.0)).alias("total_unrealised_savings"))
    z = F.lit(0.0)
    lwc = F.coalesce("lw", z)
    one = tw.crossJoin(lw).crossJoin(top_wh).crossJoin(top_sv).crossJoin(alerts).crossJoin(unreal)
    return one.select(
        today.alias("report_date"), week.alias("week_start"), F.coalesce("tw", z).alias("this_week_cost"),
        lwc.alias("last_week_cost"),
        F.when(lwc > 0, (F.coalesce("tw", z) - F.col("lw")) / F.col("lw") * 100).otherwise(z).alias("wow_change_pct"),
        F.coalesce("twc", z).alias("this_week_compute"), F.coalesce("tws", z).alias("this_week_storage"),
        F.coalesce("twv", z).alias("this_week_serverless"), "top_warehouses_json", "top_savings_json",
        "active_alert_count", "total_unrealised_savings", as_of.ts_col().alias("generated_at"))


def weekly_report_html(report: DataFrame) -> DataFrame:
    """The report row rendered as an HTML e-mail body (text column)."""
    money = lambda c: F.format_number(F.col(c), 2)
    html = F.concat(
        F.lit("<html><body><h2>Weekly Cost Report</h2><p>Week starting "), F.col("week_start").cast("string"),
        F.lit("</p><table><tr><td>This week</td><td>$"), money("this_week_cost"),
        F.lit("</td></tr><tr><td>Last week</td><td>$"), money("last_week_cost"),
        F.lit("</td></tr><tr><td>Change</td><td>"), F.format_string("%.1f", F.col("wow_change_pct")),
        F.lit("%</td></tr><tr><td>Compute</td><td>$"), money("this_week_compute"),
        F.lit("</td></tr><tr><td>Storage</td><td>$"), money("this_week_storage"),
        F.lit("</td></tr><tr><td>Serverless</td><td>$"), money("this_week_serverless"),
        F.lit("</td></tr><tr><td>New alerts (7 days)</td><td>"), F.col("active_alert_count").cast("string"),
        F.lit("</td></tr><tr><td>Open savings</td><td>$"), money("total_unrealised_savings"),
        F.lit("</td></tr></table></body></html>"))
    return report.select("report_date", "week_start", html.alias("html_body"), "generated_at")
