"""Dashboard queries as parameterised DataFrame functions.

Widget values arrive as Python values and become literals in the plan (never
string-formatted into SQL). Grouping, pivoting and top-k stay in Spark; the
driver only ever receives the final, small result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf

# default widget values used by the registered queries
DEFAULTS = {
    "days": 30,
    "warehouse": "ETL_WH",
    "candidate_types": ["SPILL_TO_STORAGE", "FULL_TABLE_SCAN", "REPEATED_EXPENSIVE"],
    "candidate_users": ["USER_1", "USER_2", "USER_3", "USER_5", "USER_8"],
    "candidate_warehouses": ["ETL_WH", "COMPUTE_WH", "ANALYTICS_WH"],
    "rec_categories": ["STORAGE", "WAREHOUSE"],
    "rec_statuses": ["OPEN", "IMPLEMENTED"],
    "teams": ["ml", "Analytics", "Unassigned"],
}
HOURS = list(range(24))
LINEAGE_PATTERN = r"(?i)(?:FROM|JOIN)\s+([A-Za-z0-9_]+(?:\.[A-Za-z0-9_]+){0,2})"


def since(df: DataFrame, col: str, days: int, as_of: AsOf) -> DataFrame:
    return df.filter(F.col(col) >= F.date_sub(as_of.date_col(), days))


def cost_trends(trends: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return since(trends, "date", days, as_of).orderBy("date")


def top_warehouses(by_wh: DataFrame, n: int = 5) -> DataFrame:
    return by_wh.select("warehouse_name", "total_cost_usd").orderBy(
        F.col("total_cost_usd").desc(), "warehouse_name").limit(n)


def top_users(by_user: DataFrame, n: int = 5) -> DataFrame:
    return by_user.select("user_name", "total_cost_usd").orderBy(
        F.col("total_cost_usd").desc(), F.col("user_name").asc_nulls_first()).limit(n)


def warehouse_list(by_wh: DataFrame) -> DataFrame:
    return by_wh.select("warehouse_name").distinct().orderBy("warehouse_name")


def daily_credits(wh_daily: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return since(wh_daily, "date", days, as_of).orderBy("date")


def idle_periods(idle: DataFrame, warehouse: str, n: int = 50) -> DataFrame:
    return idle.filter(F.col("warehouse_name") == warehouse).orderBy(F.col("idle_start").desc()).limit(n)


def storage_by_database(sa: DataFrame) -> DataFrame:
    return sa.groupBy("database_name").agg(
        F.sum("active_tb").alias("active_tb"), F.sum("time_travel_tb").alias("time_travel_tb"),
        F.sum("failsafe_tb").alias("failsafe_tb"), F.sum("total_tb").alias("total_tb"),
        F.sum("estimated_monthly_cost_usd").alias("total_cost_usd"))


def anomaly_days(trends: DataFrame) -> DataFrame:
    return trends.filter(F.col("is_anomaly")).orderBy(F.col("date").desc())


def cost_heatmap(qca: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """ISO day of week x hour, pivoted to 24 hour columns (missing = 0). The
    pivot values are fixed, so Spark plans one aggregate without a value scan."""
    rows = since(qca, "start_time", days, as_of).select(
        F.expr("extract(DAYOFWEEK_ISO FROM start_time)").cast("long").alias("day_of_week"),
        F.hour("start_time").alias("h"), "estimated_cost_usd")
    p = rows.groupBy("day_of_week").pivot("h", HOURS).agg(F.sum("estimated_cost_usd")).fillna(0.0)
    return p.select("day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


def freshness(df: DataFrame) -> DataFrame:
    return df.select("source_name", "model_name", "latest_record_at", "staleness_minutes", "freshness_status")


def freshness_summary(df: DataFrame) -> DataFrame:
    return df.select("overall_freshness_status", "overall_max_staleness_minutes", "overall_oldest_record_at").distinct()


def team_forecast(tf: DataFrame) -> DataFrame:
    return tf.select("team_name", "forecast_month", "predicted_monthly_cost", "ci_lower", "ci_upper",
                     "monthly_trend", "data_months")


def annual_spend(fm: DataFrame) -> DataFrame:
    return fm.select("projected_annual_spend").distinct()


def monthly_comparison(trends: DataFrame, n: int = 6) -> DataFrame:
    m = trends.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.sum("total_cost").alias("total_cost"))
    return m.orderBy(F.col("month").desc()).limit(n)


def latest_month_teams(team_dash: DataFrame) -> DataFrame:
    latest = team_dash.agg(F.max("month").alias("month"))
    return team_dash.join(F.broadcast(latest), "month", "left_semi")


def weekly_comparison(trends: DataFrame, n: int = 12) -> DataFrame:
    w = trends.groupBy(F.col("week_start").alias("week")).agg(
        F.sum("total_cost").alias("total_cost"), F.sum("compute_cost").alias("compute_cost"),
        F.sum("storage_cost").alias("storage_cost"), F.sum("serverless_cost").alias("serverless_cost"))
    return w.orderBy(F.col("week").desc()).limit(n)


def payload_health(payload: DataFrame) -> DataFrame:
    return payload.agg(F.count(F.lit(1)).alias("total_alerts"),
                       F.count_if(F.col("send_success") == True).alias("sent_ok"),  # noqa: E712
                       F.count_if(F.col("send_success") == False).alias("sent_fail"),  # noqa: E712
                       F.count_if(F.col("sent_at").isNull()).alias("pending"), F.max("sent_at").alias("last_sent"))


def recent_alerts(history: DataFrame, n: int = 50) -> DataFrame:
    return (history.orderBy(F.col("detected_at").desc(), "alert_episode_key").limit(n)
            .select("alert_id", "alert_name", "severity", "detected_at", "resource_key", "metric_value",
                    "threshold_value", "is_new_episode", "episode_number", "teams_sent_at", "teams_send_success"))


def alert_trend(history: DataFrame) -> DataFrame:
    return (history.filter(F.col("is_new_episode"))
            .groupBy(F.to_date("detected_at").alias("alert_date"), "severity")
            .agg(F.count(F.lit(1)).alias("alert_count")))


def savings_by_type(wh_recs: DataFrame) -> DataFrame:
    return wh_recs.groupBy("recommendation_type").agg(
        F.sum("estimated_monthly_savings_usd").alias("total_savings_usd"), F.count(F.lit(1)).alias("rec_count"))


def candidate_filter(cands: DataFrame, types, users, warehouses) -> DataFrame:
    return cands.filter(F.col("antipattern_type").isin(*types) & F.col("user_name").isin(*users)
                        & F.col("warehouse_name").isin(*warehouses))


def table_lineage(cands: DataFrame, tables: DataFrame, limit_per_query: int = 5) -> DataFrame:
    """Table names after FROM/JOIN in each candidate's text (first five,
    de-duplicated, upper-cased), with the size of fully qualified matches."""
    names = cands.select("optimization_rank", "query_id", F.slice(F.array_distinct(F.transform(
        F.regexp_extract_all("sample_query_text", F.lit(LINEAGE_PATTERN), 1), lambda x: F.upper(x))),
        1, limit_per_query).alias("names"))
    ex = names.select("optimization_rank", "query_id", F.posexplode("names").alias("table_pos", "table_ref"))
    meta = tables.filter(F.col("table_dropped").isNull()).select(
        F.upper(F.concat_ws(".", "database_name", "schema_name", "table_name")).alias("table_ref"),
        F.col("active_bytes").alias("table_bytes"))
    return ex.join(meta, "table_ref", "left").select(
        "optimization_rank", "query_id", "table_pos", "table_ref", F.size(F.split("table_ref", r"\.")).alias("name_parts"),
        "table_bytes")


def storage_waste(recs: DataFrame, sa: DataFrame) -> DataFrame:
    waste = recs.agg(F.coalesce(F.sum("savings_if_applied_usd"), F.lit(0.0)).alias("total_waste_usd"))
    cost = sa.agg(F.coalesce(F.sum("estimated_monthly_cost_usd"), F.lit(0.0)).alias("total_storage_cost_usd"))
    return waste.crossJoin(cost).select(
        "total_waste_usd", "total_storage_cost_usd",
        F.when(F.col("total_storage_cost_usd") > 0, F.col("total_waste_usd") / F.col("total_storage_cost_usd") * 100)
        .otherwise(0.0).alias("waste_pct"))


def savings_breakdown(recs: DataFrame) -> DataFrame:
    def by(col):
        return recs.groupBy(F.col(col).alias("value")).agg(
            F.sum("estimated_monthly_savings_usd").alias("total_savings_usd"), F.count(F.lit(1)).alias("rec_count")
        ).select(F.lit(col).alias("dimension"), "value", "total_savings_usd", "rec_count")
    return by("category").unionByName(by("effort"))


def recommendation_filter(lc: DataFrame, categories, statuses) -> DataFrame:
    return lc.filter(F.col("category").isin(*categories) & F.col("status").isin(*statuses))


def forecast_kpis(fc: DataFrame) -> DataFrame:
    first = fc.orderBy("forecast_date").limit(1).select(
        F.col("predicted_total_cost").alias("next_day_forecast"), F.col("daily_trend").alias("daily_trend"))
    total = fc.agg(F.sum("predicted_total_cost").alias("horizon_forecast_total"),
                   F.count(F.lit(1)).alias("horizon_days"))
    return first.crossJoin(total).select(
        "next_day_forecast", "horizon_forecast_total", "horizon_days", "daily_trend",
        F.when(F.col("daily_trend") > 0, "increasing").when(F.col("daily_trend") < 0, "decreasing")
        .otherwise("stable").alias("trend_direction"))


def home_kpis(summary: DataFrame, n: int = 6) -> DataFrame:
    return summary.select("month", "total_cost", "compute_cost", "storage_cost", "serverless_cost",
                          "mom_change_pct").orderBy(F.col("month").desc()).limit(n)


def storage_totals(sa: DataFrame) -> DataFrame:
    return sa.agg(F.sum("total_tb").alias("total_tb"), F.sum("estimated_monthly_cost_usd").alias("total_cost_usd"),
                  F.count_distinct("database_name").alias("database_count"),
                  F.count_if(F.col("is_unused")).alias("unused_tables"),
                  F.coalesce(F.sum(F.when(F.col("is_unused"), F.col("estimated_monthly_cost_usd"))), F.lit(0.0))
                  .alias("unused_cost_usd"))


def time_travel_waste(sa: DataFrame) -> DataFrame:
    return sa.filter(F.col("has_tt_waste"))


def antipattern_totals(summary: DataFrame) -> DataFrame:
    totals = summary.agg(F.sum("query_count").alias("all_queries"),
                         F.sum("total_estimated_waste").alias("all_waste_usd"))
    label = (F.when(F.col("trend_pct").isNull(), "stable").when(F.col("trend_pct") > 0, "increasing")
             .when(F.col("trend_pct") < 0, "decreasing").otherwise("stable"))
    shown = F.when(F.col("trend_pct").isNull(), "N/A").otherwise(F.format_string("%.1f%%", F.col("trend_pct")))
    return summary.crossJoin(F.broadcast(totals)).select(
        "antipattern_type", "query_count", "total_estimated_waste", label.alias("trend_label"),
        shown.alias("trend_text"), "all_queries", "all_waste_usd")


def storage_treemap(sa: DataFrame) -> DataFrame:
    return sa.groupBy("database_name").agg(F.sum("total_tb").alias("total_tb"),
                                           F.sum("estimated_monthly_cost_usd").alias("cost_usd"),
                                           F.count(F.lit(1)).alias("table_count"))


def roi_kpis(roi: DataFrame) -> DataFrame:
    f = roi.select("total_actual_savings", "implemented_estimated_savings", "implemented_count").distinct()
    return f.select("total_actual_savings", "implemented_estimated_savings", "implemented_count",
                    F.when(F.col("implemented_estimated_savings") > 0,
                           F.col("total_actual_savings") / F.col("implemented_estimated_savings") * 100)
                    .otherwise(0.0).alias("realised_pct"))


FUNNEL = [("OPEN", "open_count"), ("ACCEPTED", "accepted_count"), ("IMPLEMENTED", "implemented_count"),
          ("REJECTED", "rejected_count"), ("DEFERRED", "deferred_count")]


def funnel(roi: DataFrame) -> DataFrame:
    f = roi.select(*[c for _, c in FUNNEL]).distinct()
    stack = "stack(5, " + ", ".join(f"'{s}', CAST({c} AS BIGINT)" for s, c in FUNNEL) + ") AS (status, rec_count)"
    return f.selectExpr(stack)


def implemented_detail(roi: DataFrame) -> DataFrame:
    return roi.filter(F.col("status") == "IMPLEMENTED")


def team_forecast_filter(tf: DataFrame, teams) -> DataFrame:
    return tf.filter(F.col("team_name").isin(*teams))


TOP_SAVINGS_SCHEMA = ("array<struct<recommendation_id:string,category:string,target_object:string,"
                      "estimated_monthly_savings_usd:double>>")


def report_top_list(report: DataFrame) -> DataFrame:
    return report.select(F.posexplode(F.from_json("top_savings_json", TOP_SAVINGS_SCHEMA)).alias("pos", "item")).select(
        (F.col("pos") + 1).alias("position"), "item.recommendation_id", "item.category", "item.target_object",
        "item.estimated_monthly_savings_usd")


def unsent_alerts(payload: DataFrame) -> DataFrame:
    return (payload.filter(F.col("sent_at").isNull())
            .select("alert_episode_key", "alert_id", "severity", "detected_at", "resource_key")
            .orderBy(F.col("detected_at").desc()))
