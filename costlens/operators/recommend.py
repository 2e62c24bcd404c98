"""Recommendations: warehouse actions, top query fixes, anti-pattern trends,
the unified ranked list, lifecycle status and ROI."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf
from costlens.plans.rank import global_row_number

# FIXED VALUES: one-step size ladders for undersized / oversized warehouses.
SIZE_UP = [("X-Small", "Small"), ("Small", "Medium"), ("Medium", "Large")]
SIZE_DOWN = [("Medium", "Small"), ("Large", "Medium"), ("X-Large", "Large")]


def _ladder(size, steps, drop_noop: bool):
    c = X.col(size)
    expr = None
    for a, b in steps:
        expr = F.when(c == a, b) if expr is None else expr.when(c == a, b)
    return expr if drop_noop else expr.otherwise(c)


def _json(**fields):
    """Evidence object as JSON text (fields in the given order)."""
    return F.to_json(F.struct(*[X.col(v).alias(k) for k, v in fields.items()]))


def warehouse_recommendations(sizing: DataFrame, suspend: DataFrame, schedule: DataFrame, metering: DataFrame,
                              drop_noop: bool = False) -> DataFrame:
    queue_spill = (F.col("avg_queue_ms") > 1000) & (F.col("spill_rate_pct") > 10)
    idle_small = (F.col("peak_hour_utilisation") < 0.2) & (F.col("spill_rate_pct") < 1)
    sizing_recs = (sizing.filter(queue_spill | (F.col("peak_hour_utilisation") < 0.2))
                   .select("warehouse_name", F.lit("RESIZE").alias("recommendation_type"),
                           F.col("current_size").alias("current_state"),
                           F.when(queue_spill, _ladder("current_size", SIZE_UP, drop_noop))
                           .when(idle_small, _ladder("current_size", SIZE_DOWN, drop_noop)).alias("recommended_state"),
                           F.when(F.col("peak_hour_utilisation") < 0.2, 500.0).otherwise(0.0)
                           .alias("estimated_monthly_savings_usd"),
                           F.lit("LOW").alias("effort"),
                           F.when((F.col("avg_queue_ms") > 1000) | (F.col("spill_rate_pct") > 10), "HIGH")
                           .when(F.col("peak_hour_utilisation") < 0.2, "MEDIUM").otherwise("LOW").alias("confidence"),
                           _json(avg_exec_ms=X.round4("avg_exec_ms"), p95_exec_ms=X.round4("p95_exec_ms"),
                                 avg_queue_ms=X.round4("avg_queue_ms"), spill_rate_pct=X.round4("spill_rate_pct"),
                                 peak_utilisation=X.round4("peak_hour_utilisation"))
                           .alias("evidence"))
                   .filter(F.col("recommended_state").isNotNull()))
    suspend_recs = (suspend.filter(F.col("recommended_auto_suspend_seconds") != F.col("current_auto_suspend_seconds"))
                    .select("warehouse_name", F.lit("AUTO_SUSPEND").alias("recommendation_type"),
                            F.col("current_auto_suspend_seconds").cast("string").alias("current_state"),
                            F.col("recommended_auto_suspend_seconds").cast("string").alias("recommended_state"),
                            F.col("potential_savings_usd").alias("estimated_monthly_savings_usd"),
                            F.lit("LOW").alias("effort"),
                            F.when(F.col("idle_period_count") > 10, "HIGH").otherwise("MEDIUM").alias("confidence"),
                            _json(idle_period_count="idle_period_count", avg_idle_minutes=X.round4("avg_idle_minutes"),
                                  monthly_idle_credits=X.round4("monthly_idle_credits")).alias("evidence")))
    sched = (schedule.filter(F.col("is_off_peak") & (F.col("query_count") < 5))
             .groupBy("warehouse_name")
             .agg(F.sum("schedulable_savings_usd").alias("s"),
                  F.sum(F.when(F.col("is_off_peak"), F.col("query_count")).otherwise(0)).alias("q"))
             .filter(F.col("s") > 10))
    schedule_recs = sched.select(
        "warehouse_name", F.lit("SCHEDULE").alias("recommendation_type"), F.lit("Always On").alias("current_state"),
        F.lit("Suspend during off-peak").alias("recommended_state"), F.col("s").alias("estimated_monthly_savings_usd"),
        F.lit("MEDIUM").alias("effort"), F.lit("MEDIUM").alias("confidence"),
        _json(off_peak_query_count="q", off_peak_cost=X.round4("s")).alias("evidence"))
    metered = metering.select("warehouse_name").distinct()
    recs = sizing_recs.unionByName(suspend_recs).unionByName(schedule_recs).join(metered, "warehouse_name", "left_semi")
    wh, rs = F.col("warehouse_name"), F.col("recommended_state")
    sql = (F.when(F.col("recommendation_type") == "RESIZE",
                  F.concat(F.lit("ALTER WAREHOUSE "), wh, F.lit(" SET WAREHOUSE_SIZE = '"), rs, F.lit("';")))
           .when(F.col("recommendation_type") == "AUTO_SUSPEND",
                 F.concat(F.lit("ALTER WAREHOUSE "), wh, F.lit(" SET AUTO_SUSPEND = "), rs, F.lit(";")))
           .when(F.col("recommendation_type") == "SCHEDULE",
                 F.concat(F.lit("-- Create a resource monitor or task to suspend "), wh,
                          F.lit(" during off-peak hours")))
           .otherwise(F.lit("-- Manual review required")))
    return recs.select("warehouse_name", "recommendation_type", "current_state", "recommended_state",
                       "estimated_monthly_savings_usd", "effort", "confidence", "evidence",
                       X.priority("estimated_monthly_savings_usd", "confidence", "effort").alias("priority_score"),
                       sql.alias("sql_to_apply"))


def query_optimization_candidates(ap: DataFrame, top: int = 100) -> DataFrame:
    """Top findings by waste. ``orderBy.limit`` plans as TakeOrderedAndProject
    (a per-task top-k then a merge), so only ``top`` rows are ever ranked."""
    order = [F.col("estimated_waste_usd").desc(), F.col("query_id").asc(), F.col("antipattern_type").asc()]
    best = ap.filter(F.col("estimated_waste_usd") > 0).orderBy(*order).limit(top)
    return best.select(F.row_number().over(Window.orderBy(*order)).alias("optimization_rank"),
                       "query_id", "user_name", "warehouse_name", "antipattern_type", "severity",
                       "estimated_waste_usd", "recommendation", "sample_query_text", "end_time")


def antipattern_summary(ap: DataFrame, as_of: AsOf) -> DataFrame:
    today = as_of.date_col().cast("timestamp_ntz")
    cur = F.col("end_time") >= today - F.expr("INTERVAL 30 DAYS")
    prev = (F.col("end_time") >= today - F.expr("INTERVAL 60 DAYS")) & (F.col("end_time") < today - F.expr("INTERVAL 30 DAYS"))
    waste = F.coalesce("estimated_waste_usd", F.lit(0.0))
    g = (ap.groupBy("antipattern_type")
         .agg(F.count_if(cur).alias("query_count"), F.sum(F.when(cur, waste)).alias("total_estimated_waste"),
              F.avg(F.when(cur, waste)).alias("avg_waste_per_query"), F.count_if(prev).alias("prev_period_count"))
         .filter(F.col("query_count") > 0))
    return g.select("antipattern_type", "query_count", "total_estimated_waste", "avg_waste_per_query",
                    "prev_period_count",
                    F.when(F.col("prev_period_count") != 0,
                           (F.col("query_count") - F.col("prev_period_count")).cast("double")
                           / F.col("prev_period_count") * 100).alias("trend_pct"))


REC_COLS = ["category", "recommendation_type", "target_object", "description", "current_monthly_cost_usd",
            "estimated_monthly_savings_usd", "effort", "confidence", "action_sql", "source_id"]
TIE = ["category", "recommendation_type", "target_object", "description", "action_sql"]


def all_recommendations(wh: DataFrame, candidates: DataFrame, storage: DataFrame, top_queries: int = 50) -> DataFrame:
    """One ranked list. ``recommendation_id`` is the rank, padded to four digits at
    least; ``stable_id`` names a recommendation whatever its rank."""
    w = wh.select(F.lit("WAREHOUSE").alias("category"), "recommendation_type",
                  F.col("warehouse_name").alias("target_object"),
                  F.concat(F.col("recommendation_type"), F.lit(": "), F.col("current_state"), F.lit(" -> "),
                           F.col("recommended_state")).alias("description"),
                  F.lit(0.0).alias("current_monthly_cost_usd"), "estimated_monthly_savings_usd", "effort", "confidence",
                  F.col("sql_to_apply").alias("action_sql"), F.lit(None).cast("string").alias("source_id"))
    q = (candidates.filter(F.col("optimization_rank") <= top_queries)
         .select(F.lit("QUERY").alias("category"), F.col("antipattern_type").alias("recommendation_type"),
                 F.concat(F.coalesce("warehouse_name", F.lit("N/A")), F.lit("/"),
                          F.coalesce("user_name", F.lit("N/A"))).alias("target_object"),
                 F.col("recommendation").alias("description"), F.lit(0.0).alias("current_monthly_cost_usd"),
                 F.col("estimated_waste_usd").alias("estimated_monthly_savings_usd"),
                 F.when(F.col("severity") == "P1", "LOW").when(F.col("severity") == "P2", "MEDIUM")
                 .otherwise("HIGH").alias("effort"),
                 F.lit("HIGH").alias("confidence"),
                 F.concat(F.lit("-- Query optimization: "), F.substring("sample_query_text", 1, 100)).alias("action_sql"),
                 F.col("query_id").alias("source_id")))
    s = storage.select(F.lit("STORAGE").alias("category"), "recommendation_type", "target_object", "description",
                       F.col("current_cost_usd").alias("current_monthly_cost_usd"),
                       F.col("savings_if_applied_usd").alias("estimated_monthly_savings_usd"), "effort", "confidence",
                       "action_sql", F.lit(None).cast("string").alias("source_id"))
    recs = (w.select(REC_COLS).unionByName(q.select(REC_COLS)).unionByName(s.select(REC_COLS))
            .filter(F.col("estimated_monthly_savings_usd") > 0)
            .withColumn("priority_score", X.priority("estimated_monthly_savings_usd", "confidence", "effort")))
    tie = [F.col(c).asc_nulls_first() for c in TIE]
    ranked = global_row_number(recs, [F.col("priority_score").desc()] + tie, "overall_rank")
    # category rank = position in the (category, savings) order minus the
    # category's first position: no window over a whole category (storage has
    # one row per table)
    ranked = global_row_number(ranked, [F.col("category").asc(), F.col("estimated_monthly_savings_usd").desc()] + tie,
                               "_crn")
    firsts = ranked.groupBy("category").agg(F.min("_crn").alias("_first"))
    ranked = (ranked.join(F.broadcast(firsts), "category")
              .withColumn("category_rank", F.col("_crn") - F.col("_first") + 1).drop("_crn", "_first"))
    return ranked.select(
        F.concat(F.lit("REC-"), F.when(F.col("overall_rank") < 1000, F.lpad(F.col("overall_rank").cast("string"), 4, "0"))
                 .otherwise(F.col("overall_rank").cast("string"))).alias("recommendation_id"),
        "category", "recommendation_type", "target_object", "description", "current_monthly_cost_usd",
        "estimated_monthly_savings_usd", "effort", "confidence", "priority_score", "action_sql",
        F.col("category_rank").cast("long").alias("category_rank"), "overall_rank",
        F.sha2(F.concat_ws("|", "category", "recommendation_type", "target_object", "source_id"), 256)
        .alias("stable_id"))


def recommendation_lifecycle(recs: DataFrame, actions: DataFrame, wh_daily: DataFrame, as_of: AsOf) -> DataFrame:
    today = as_of.date_col()
    recent = (wh_daily.filter(F.col("date") >= F.date_sub(today, 30)).groupBy("warehouse_name")
              .agg(F.sum("estimated_cost_usd").alias("last_30d_cost_usd")))
    a = actions.select(*[F.col(c).cast("string").alias(c) for c in actions.columns])
    key = "stable_id" if "stable_id" in actions.columns else "recommendation_id"  # users' action log: it grows
    if key == "stable_id":
        a = a.drop("recommendation_id")
    j = recs.drop("category_rank", "overall_rank").join(a, key, "left")
    status = F.coalesce("status", F.lit("OPEN"))
    j = j.withColumn("status", status)
    j = j.join(recent, (j["category"] == "WAREHOUSE") & (j["target_object"] == recent["warehouse_name"])
               & (F.col("status") == "IMPLEMENTED"), "left")
    implemented = F.col("status") == "IMPLEMENTED"
    actual = F.when(implemented & (F.col("category") == "WAREHOUSE"),
                    X.greatest_strict(F.lit(0.0), F.col("current_monthly_cost_usd")
                                      - F.coalesce("last_30d_cost_usd", "current_monthly_cost_usd")))
    days = F.when(implemented & F.col("implemented_at").isNotNull(),
                  F.datediff(today, F.try_to_timestamp("implemented_at", F.lit("yyyy-MM-dd")).cast("date")))
    out = j.select("recommendation_id", "category", "recommendation_type", "target_object", "description",
                   "current_monthly_cost_usd", "estimated_monthly_savings_usd", "effort", "confidence",
                   "priority_score", "action_sql", "status", "actioned_by", "actioned_at", "implemented_at", "notes",
                   actual.alias("actual_savings_usd"), days.alias("days_since_implementation"))
    return out.withColumn("roi_pct", F.when(
        F.col("actual_savings_usd").isNotNull() & (F.col("estimated_monthly_savings_usd") > 0),
        X.safe_divide("actual_savings_usd", "estimated_monthly_savings_usd") * 100))


STATUSES = ["OPEN", "ACCEPTED", "IMPLEMENTED", "REJECTED", "DEFERRED"]


def recommendation_roi(lc: DataFrame) -> DataFrame:
    st = F.col("status")
    funnel = lc.agg(F.count(F.lit(1)).alias("total_recommendations"),
                    *[F.count_if(st == s).alias(f"{s.lower()}_count") for s in STATUSES],
                    F.sum("estimated_monthly_savings_usd").alias("total_estimated_savings"),
                    F.sum(F.when(st == "IMPLEMENTED", F.col("estimated_monthly_savings_usd")).otherwise(0.0))
                    .alias("implemented_estimated_savings"),
                    F.sum(F.coalesce("actual_savings_usd", F.lit(0.0))).alias("total_actual_savings"))
    return lc.crossJoin(F.broadcast(funnel)).select(
        "recommendation_id", "category", "recommendation_type", "target_object", "description",
        "estimated_monthly_savings_usd", "actual_savings_usd", "roi_pct", "status", "actioned_by", "actioned_at",
        "implemented_at", "days_since_implementation", "notes", "effort", "confidence", "priority_score",
        "total_recommendations", "open_count", "accepted_count", "implemented_count", "rejected_count",
        "deferred_count", "total_estimated_savings", "implemented_estimated_savings", "total_actual_savings")
