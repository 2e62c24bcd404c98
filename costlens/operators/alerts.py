"""Alerts: seven detectors, suppression (intervals by month + holidays),
episode tracking with state carried between runs, the card payload, the audit
history and the delivery-status merge.

Config, suppression and holiday tables are bounded (config-sized), so they are
always joined by broadcast; detectors never collect anything to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf

ALERT_COLS = ["alert_id", "detected_at", "resource_key", "metric_value", "threshold_value", "details_json"]


def _cfg(config: DataFrame, alert_id: str) -> DataFrame:
    return F.broadcast(config.filter((F.col("alert_id") == alert_id) & F.col("enabled"))
                       .select("threshold_value", F.coalesce("seasonality_sensitivity", F.lit(2.0)).alias("sens")))


def _details(**fields) -> Column:
    return F.to_json(F.struct(*[X.col(v).alias(k) for k, v in fields.items()]))


def _ts_text(c) -> Column:
    return F.date_format(X.col(c), "yyyy-MM-dd HH:mm:ss.SSS")


def _out(df: DataFrame, alert_id, detected_at, resource_key, metric, threshold, details) -> DataFrame:
    aid = F.lit(alert_id) if isinstance(alert_id, str) else alert_id
    return df.select(aid.alias("alert_id"), X.col(detected_at).cast("timestamp_ntz").alias("detected_at"),
                     X.col(resource_key).alias("resource_key"), X.col(metric).cast("double").alias("metric_value"),
                     X.col(threshold).cast("double").alias("threshold_value"), details.alias("details_json"))


def cost_daily_spike(config: DataFrame, rollup: DataFrame, seasonality: DataFrame, as_of: AsOf) -> DataFrame:
    """z-score against the seasonal baseline; the 2x-mean rule where the
    baseline is missing or flat. One left join decides the method per day."""
    since = F.date_sub(as_of.date_col(), 1)
    dc = rollup.filter(F.col("date") >= since).select("date", "total_cost", "rolling_30d_avg")
    s = seasonality.filter(F.col("date") >= since).select(
        F.col("date").alias("s_date"), "adjusted_baseline", "effective_stddev", "is_month_end")
    j = dc.join(s, dc["date"] == s["s_date"], "left").crossJoin(_cfg(config, "cost_daily_spike"))
    seasonal_thr = F.col("adjusted_baseline") + F.col("sens") * F.col("effective_stddev")
    simple_thr = F.col("rolling_30d_avg") * F.col("threshold_value")
    seasonal = F.col("s_date").isNotNull() & (F.col("effective_stddev") > 0) & (F.col("adjusted_baseline") > 0) \
        & (F.col("total_cost") > seasonal_thr)
    simple = (F.col("s_date").isNull() | (F.col("effective_stddev") == 0) | (F.col("adjusted_baseline") <= 0)) \
        & (F.col("total_cost") > simple_thr) & (F.col("rolling_30d_avg") > 0)
    j = j.withColumn("method", F.when(seasonal, "seasonality_zscore").when(simple, "simple_multiplier")) \
        .filter(F.col("method").isNotNull())
    is_seasonal = F.col("method") == "seasonality_zscore"
    details = F.when(is_seasonal, _details(
        daily_cost=X.round4("total_cost"), adjusted_baseline=X.round4("adjusted_baseline"),
        effective_stddev=X.round4("effective_stddev"),
        z_score=X.round4(F.when(F.col("effective_stddev") > 0,
                                (F.col("total_cost") - F.col("adjusted_baseline")) / F.col("effective_stddev"))),
        is_month_end="is_month_end", detection_method="method", rolling_30d_avg=X.round4("rolling_30d_avg"))
    ).otherwise(_details(daily_cost=X.round4("total_cost"), rolling_30d_avg=X.round4("rolling_30d_avg"),
                         multiplier=X.round4(X.safe_divide("total_cost", "rolling_30d_avg")),
                         detection_method="method"))
    return _out(j, "cost_daily_spike", "date", F.lit("account"), "total_cost",
                F.when(is_seasonal, seasonal_thr).otherwise(simple_thr), details)


def warehouse_idle(config: DataFrame, idle: DataFrame, as_of: AsOf) -> DataFrame:
    j = idle.crossJoin(_cfg(config, "warehouse_idle_extended")).filter(
        (F.col("idle_duration_minutes") > F.col("threshold_value"))
        & (F.col("idle_start") >= as_of.ts_col() - F.expr("INTERVAL 6 HOURS")))
    details = _details(warehouse_name="warehouse_name", idle_start=_ts_text("idle_start"),
                       idle_end=_ts_text("idle_end"), idle_minutes="idle_duration_minutes",
                       wasted_credits=X.round4("wasted_credits"), wasted_cost_usd=X.round4("wasted_cost_usd"))
    return _out(j, "warehouse_idle_extended", "idle_start", "warehouse_name", "idle_duration_minutes",
                "threshold_value", details)


def credit_budget(config: DataFrame, wh_daily: DataFrame, budget: DataFrame, as_of: AsOf,
                  team: str | None = None) -> DataFrame:
    """Month to date against the month's budget: that of ``team``, or of all teams."""
    month = F.trunc(as_of.date_col(), "month")
    mtd = wh_daily.filter(F.col("date") >= month).agg(F.sum("total_credits").alias("mtd_credits"))
    b = budget.filter((F.col("budget_month") == month) & (F.lit(True) if team is None else F.col("team_name") == team))
    b = b.agg(F.sum("budget_credits").alias("budget_credits")).filter("budget_credits IS NOT NULL")
    cfg = F.broadcast(config.filter(F.col("alert_id").isin("credit_budget_80pct", "credit_budget_100pct")
                                    & F.col("enabled")).select("alert_id", "threshold_value"))
    pct = F.col("mtd_credits") / F.col("budget_credits") * 100
    j = mtd.crossJoin(F.broadcast(b)).crossJoin(cfg).filter(
        X.safe_divide("mtd_credits", "budget_credits") * 100 >= F.col("threshold_value"))
    details = _details(mtd_credits=X.round4("mtd_credits"), budget_credits="budget_credits",
                       pct_used=X.round4(pct))
    return _out(j, F.col("alert_id"), as_of.ts_col(), F.lit("account"), pct, "threshold_value", details)


def query_spill(config: DataFrame, qh: DataFrame, as_of: AsOf) -> DataFrame:
    recent = X.since(qh, "end_time", as_of.ts_col() - F.expr("INTERVAL 1 HOURS"))
    j = recent.crossJoin(_cfg(config, "query_spill_heavy")).filter(
        (F.col("bytes_spilled_to_remote_storage") > F.col("threshold_value"))
        & F.col("query_text").isNotNull() & X.not_like_any("query_text", X.INTERNAL_PREFIXES_ATTRIBUTION))
    details = _details(query_id="query_id", user_name="user_name", warehouse_name="warehouse_name",
                       bytes_spilled_remote="bytes_spilled_to_remote_storage",
                       bytes_spilled_local="bytes_spilled_to_local_storage",
                       execution_time_s=X.round4(F.col("execution_time_ms") / 1000.0))
    return _out(j, "query_spill_heavy", "end_time", F.concat(F.col("warehouse_name"), F.lit("/"), F.col("query_id")),
                "bytes_spilled_to_remote_storage", "threshold_value", details)


def storage_growth(config: DataFrame, db_storage: DataFrame, as_of: AsOf) -> DataFrame:
    """Week-over-week growth per database. The lag window is partitioned by
    database and holds one row per day, so it is bounded by the calendar."""
    w = Window.partitionBy("database_name").orderBy("usage_date")
    g = (db_storage.select("database_name", "usage_date", "average_database_bytes",
                           F.lag("average_database_bytes", 7).over(w).alias("prev_week_bytes"))
         .filter(F.col("prev_week_bytes").isNotNull() & (F.col("prev_week_bytes") > 0)
                 & (F.col("usage_date") >= F.date_sub(as_of.date_col(), 1)))
         .withColumn("growth_pct", X.safe_divide(F.col("average_database_bytes") - F.col("prev_week_bytes"),
                                                 F.col("prev_week_bytes")) * 100))
    j = g.crossJoin(_cfg(config, "storage_growth_anomaly")).filter(F.col("growth_pct") > F.col("threshold_value"))
    j = j.withColumn("_rn", F.row_number().over(Window.partitionBy("database_name").orderBy(F.col("usage_date").desc())))
    j = j.filter(F.col("_rn") == 1)
    details = _details(database_name="database_name", current_bytes="average_database_bytes",
                       prev_week_bytes="prev_week_bytes", growth_pct=X.round4("growth_pct"))
    return _out(j, "storage_growth_anomaly", "usage_date", "database_name", "growth_pct", "threshold_value", details)


def repeated_expensive(config: DataFrame, patterns: DataFrame, as_of: AsOf) -> DataFrame:
    j = patterns.crossJoin(_cfg(config, "repeated_expensive_query")).filter(
        (F.col("execution_count") > F.col("threshold_value")) & (F.col("avg_cost_per_execution") > 1.0)
        & (F.col("query_date") >= F.date_sub(as_of.date_col(), 1)))
    details = _details(query_hash="query_hash", query_type="query_type", warehouse_name="warehouse_name",
                       daily_executions="execution_count", avg_cost_per_run=X.round4("avg_cost_per_execution"),
                       total_daily_cost=X.round4("total_cost_usd"))
    return _out(j, "repeated_expensive_query", "query_date", "query_hash", "execution_count", "threshold_value",
                details)


def query_long_running(config: DataFrame, qh: DataFrame, as_of: AsOf) -> DataFrame:
    text = F.upper(F.col("query_text"))
    cond = ((F.col("execution_status") == "SUCCESS")
            & (F.col("total_elapsed_time_ms") > F.col("threshold_value") * 60000)
            & (F.col("user_name") != "SYSTEM")
            & (F.coalesce(F.col("database_name"), F.lit("")) != X.SYSTEM_DATABASE)
            & X.not_like_any("query_text", X.INTERNAL_PREFIXES_LONG_RUNNING))
    for m in X.SYSTEM_TEXT_MARKERS:
        cond = cond & ~text.contains(m)
    recent = X.since(qh, "end_time", as_of.ts_col() - F.expr("INTERVAL 7 DAYS"))
    j = recent.crossJoin(_cfg(config, "query_long_running")).filter(cond)
    minutes = X.round_half_up(F.col("total_elapsed_time_ms") / 60000.0, 1)
    details = _details(query_id="query_id", user_name="user_name", warehouse_name="warehouse_name",
                       warehouse_size="warehouse_size", duration_minutes=minutes,
                       queued_time_s=X.round_half_up(F.col("queued_overload_time_ms") / 1000.0, 1),
                       bytes_scanned_mb=X.round_half_up(F.col("bytes_scanned") / 1048576.0, 1),
                       rows_produced="rows_produced", query_type="query_type",
                       query_preview=F.substring("query_text", 1, 200))
    return _out(j, "query_long_running", "end_time",
                F.concat(F.col("warehouse_name"), F.lit("/"), F.col("user_name")), minutes, "threshold_value", details)


def not_suppressed(alerts: DataFrame, suppressions: DataFrame) -> DataFrame:
    """Alerts that no suppression of their alert and resource covers. A suppression is
    laid out by the months it covers, so the interval becomes one more equal key: a
    resource with very many suppressions is compared with those of the month alone, and
    as an anti join, overlapping ones hit once."""
    months = F.sequence(F.trunc("start_date", "month"), F.trunc("end_date", "month"), F.expr("INTERVAL 1 MONTH"))
    binned = suppressions.filter("start_date <= end_date").select(
        F.col("alert_id").alias("s_alert"), F.col("resource_value").alias("s_resource"), "start_date", "end_date", F.explode(months).alias("s_month")).distinct()
    day = F.to_date("detected_at")
    same = (F.col("alert_id") == F.col("s_alert")) & (F.col("resource_key") == F.col("s_resource")) & (F.trunc(day, "month") == F.col("s_month"))
    return alerts.join(binned, same & day.between(F.col("start_date"), F.col("end_date")), "left_anti")


def alert_union(detectors: list[DataFrame], suppressions: DataFrame, holidays: DataFrame,
                config: DataFrame) -> DataFrame:
    """All detector rows but those that a suppression covers, or a bank holiday where
    the alert's configuration says so. What is left is not suppressed and has no
    reason, so two anti joins do."""
    alerts = detectors[0].select(ALERT_COLS)
    for d in detectors[1:]:
        alerts = alerts.unionByName(d.select(ALERT_COLS))
    resting = config.filter("suppress_on_holidays").select(F.col("alert_id").alias("h_alert")).distinct()
    days = holidays.select("holiday_date").distinct()
    kept = not_suppressed(alerts, suppressions).join(F.broadcast(resting), F.col("alert_id") == F.col("h_alert"), "left")
    kept = kept.join(F.broadcast(days), (F.to_date("detected_at") == F.col("holiday_date")) & F.col("h_alert").isNotNull(), "left_anti")
    return kept.select(*ALERT_COLS, F.lit(False).alias("is_suppressed"), F.lit(None).cast("string").alias("suppression_reason"))


def _latest(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Latest row per key (QUALIFY ROW_NUMBER() = 1); plans as WindowGroupLimit."""
    return (df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .filter(F.col("_rn") == 1).drop("_rn"))


def latest_order() -> list[Column]:
    """Newest first; ties broken on value and details so reruns agree."""
    return [F.col("detected_at").desc(), F.col("metric_value").desc(), F.col("details_json").asc()]


def alert_state_tracker(union: DataFrame, previous: DataFrame | None, as_of: AsOf,
                        active_hours: int = 6) -> DataFrame:
    """Episodes per (alert, resource). Without previous state every alert
    opens episode 1; with it, an alert seen within ``active_hours`` continues
    its episode and anything else opens the next one. Merge the result into
    the stored state with ``streaming.incremental.upsert`` on
    ``alert_episode_key``."""
    cur = _latest(union, ["alert_id", "resource_key"], latest_order()).withColumn(
        "alert_resource_key", F.concat(F.col("alert_id"), F.lit("||"), F.col("resource_key")))
    now = as_of.ts_col()
    if previous is None:
        e = cur.select("*", F.lit(True).alias("is_new_episode"), F.lit(False).alias("is_continuation"),
                       F.lit(1).cast("long").alias("episode_number"))
    else:
        ps = previous.groupBy("alert_resource_key").agg(
            F.max("episode_number").alias("last_episode"), F.max("detected_at").alias("last_detected_at"))
        ps = ps.withColumn("is_still_active", F.col("last_detected_at") >= now - F.expr(f"INTERVAL {active_hours} HOURS"))
        j = cur.join(ps.withColumnRenamed("alert_resource_key", "ps_key"),
                     cur["alert_resource_key"] == F.col("ps_key"), "left")
        known, active = F.col("ps_key").isNotNull(), F.col("is_still_active")
        e = j.select(*cur.columns,
                     F.when(~known, True).when(~active, True).otherwise(False).alias("is_new_episode"),
                     F.coalesce(known & active, F.lit(False)).alias("is_continuation"),
                     (F.coalesce("last_episode", F.lit(0))
                      + F.when(~known, 1).when(~active, 1).otherwise(0)).cast("long").alias("episode_number"))
    e = e.withColumn("alert_episode_key", F.concat(F.col("alert_id"), F.lit("_episode_"),
                                                   F.col("episode_number").cast("string"), F.lit("_"),
                                                   F.col("resource_key")))
    return one_per_episode(e.withColumn("evaluated_at", now))


def one_per_episode(episodes: DataFrame) -> DataFrame:
    """The latest row of each episode key, a null key being one."""
    return _latest(episodes, ["alert_episode_key"], latest_order()).select(
        "alert_episode_key", "alert_id", "detected_at", "resource_key", "alert_resource_key", "metric_value",
        "threshold_value", "details_json", "is_new_episode", "is_continuation", "episode_number", "evaluated_at")


def _fact(title: str, value: Column) -> Column:
    return F.struct(F.lit(title).alias("title"), value.alias("value"))


def _detail(name: str) -> Column:
    return F.get_json_object(F.col("details_json"), f"$.{name}")


def _money(name: str, digits: int = 2) -> Column:
    v = X.round_half_up(_detail(name).cast("double"), digits).cast("string")
    return F.concat(F.lit("$"), F.coalesce(v, F.lit("N/A")))


def _num(name: str, digits: int, scale: float = 1.0) -> Column:
    v = X.round_half_up(_detail(name).cast("double") / scale, digits).cast("string")
    return F.coalesce(v, F.lit("N/A"))


def _txt(name: str) -> Column:
    return F.coalesce(_detail(name), F.lit("N/A"))


def _facts_by_alert() -> Column:
    aid = F.col("alert_id")
    budget = F.array(_fact("MTD Credits", _num("mtd_credits", 1)), _fact("Budget Credits", _txt("budget_credits")),
                     _fact("% Used", F.concat(_num("pct_used", 1), F.lit("%"))))
    return (F.when(aid == "cost_daily_spike", F.array(
                _fact("Daily Cost", _money("daily_cost")), _fact("Rolling 30d Avg", _money("rolling_30d_avg")),
                _fact("Detection Method", _txt("detection_method")), _fact("Z-Score", _num("z_score", 2))))
            .when(aid == "warehouse_idle_extended", F.array(
                _fact("Warehouse", _txt("warehouse_name")), _fact("Idle Minutes", _txt("idle_minutes")),
                _fact("Wasted Credits", _num("wasted_credits", 2)), _fact("Wasted Cost", _money("wasted_cost_usd"))))
            .when(aid.isin("credit_budget_80pct", "credit_budget_100pct"), budget)
            .when(aid == "query_spill_heavy", F.array(
                _fact("Query ID", _txt("query_id")), _fact("User", _txt("user_name")),
                _fact("Warehouse", _txt("warehouse_name")),
                _fact("Spill Remote (GB)", _num("bytes_spilled_remote", 2, 1073741824.0)),
                _fact("Execution Time (s)", _num("execution_time_s", 1))))
            .when(aid == "repeated_expensive_query", F.array(
                _fact("Query Hash", _txt("query_hash")), _fact("Warehouse", _txt("warehouse_name")),
                _fact("Daily Executions", _txt("daily_executions")),
                _fact("Avg Cost/Run", _money("avg_cost_per_run")), _fact("Total Daily Cost", _money("total_daily_cost"))))
            .when(aid == "query_long_running", F.array(
                _fact("Query ID", _txt("query_id")), _fact("User", _txt("user_name")),
                _fact("Warehouse", _txt("warehouse_name")), _fact("Duration (min)", _txt("duration_minutes")),
                _fact("Queued Time (s)", _txt("queued_time_s")),
                _fact("Query Preview", F.coalesce(F.substring(_detail("query_preview"), 1, 200), F.lit("N/A")))))
            .otherwise(F.array(_fact("Raw Details", F.substring("details_json", 1, 300)))))


def alert_payload(tracker: DataFrame, config: DataFrame) -> DataFrame:
    """Adaptive-card message per new episode, built as nested structs and
    serialised once with ``to_json``."""
    cfg = F.broadcast(config.filter(F.col("teams_enabled") & F.col("enabled")).select(
        "alert_id", "alert_name", F.col("description").alias("alert_description"), "severity", "teams_channel",
        "resolver_team"))
    ne = tracker.filter(F.col("is_new_episode")).join(cfg, "alert_id")
    color = F.when(F.col("severity") == "P0", "Attention").when(F.col("severity") == "P1", "Warning").otherwise("Default")
    header = F.struct(F.lit("TextBlock").alias("type"), F.lit("Large").alias("size"), F.lit("Bolder").alias("weight"),
                      F.concat(F.col("severity"), F.lit(" — "), F.col("alert_name")).alias("text"),
                      color.alias("color"))
    desc = F.struct(F.lit("TextBlock").alias("type"), F.col("alert_description").alias("text"),
                    F.lit(True).alias("wrap"))
    facts = F.struct(F.lit("FactSet").alias("type"), F.array(
        _fact("Resource", F.col("resource_key")), _fact("Metric Value", F.col("metric_value").cast("string")),
        _fact("Threshold", F.col("threshold_value").cast("string")),
        _fact("Detected At", F.col("detected_at").cast("string")),
        _fact("Episode", F.col("episode_number").cast("string")),
        _fact("Resolver Team", F.col("resolver_team"))).alias("facts"))
    sep = F.struct(F.lit("TextBlock").alias("type"), F.lit("**Details**").alias("text"), F.lit(True).alias("wrap"),
                   F.lit(True).alias("separator"))
    details = F.struct(F.lit("FactSet").alias("type"), _facts_by_alert().alias("facts"))
    body = F.array(F.to_json(header), F.to_json(desc), F.to_json(facts), F.to_json(sep), F.to_json(details))
    content = F.concat(
        F.lit('{"$schema":"http://adaptivecards.io/schemas/adaptive-card.json","type":"AdaptiveCard",'
              '"version":"1.4","body":['), F.array_join(body, ","), F.lit("]}"))
    card = F.concat(F.lit('{"type":"message","attachments":[{"contentType":"application/vnd.microsoft.card.adaptive",'
                          '"content":'), content, F.lit("}]}"))
    return ne.select("alert_episode_key", "alert_id", "detected_at", "resource_key", "metric_value", "threshold_value",
                     "details_json", "episode_number", "alert_name", "alert_description", "severity", "teams_channel",
                     "resolver_team", card.alias("teams_payload_json"),
                     F.lit(None).cast("timestamp_ntz").alias("sent_at"),
                     F.lit(None).cast("int").alias("api_response_code"),
                     F.lit(None).cast("boolean").alias("send_success"))


def alert_history(tracker: DataFrame, config: DataFrame, payload: DataFrame) -> DataFrame:
    t = _latest(tracker, ["alert_episode_key"], latest_order())
    c = F.broadcast(config.select("alert_id", "alert_name", "severity", "teams_enabled",
                                  F.col("enabled").alias("alert_enabled"), "resolver_team"))
    p = _latest(payload.select("alert_episode_key", "sent_at", "api_response_code", "send_success"),
                ["alert_episode_key"], [F.col("sent_at").desc_nulls_last(), F.col("api_response_code").desc()])
    return (t.join(c, "alert_id", "left").join(p, "alert_episode_key", "left")
            .select("alert_episode_key", "alert_id", "alert_name", "severity", "detected_at", "resource_key",
                    "metric_value", "threshold_value", "details_json", "is_new_episode", "is_continuation",
                    "episode_number", "evaluated_at", "teams_enabled", "alert_enabled", "resolver_team",
                    F.lit(False).alias("is_suppressed"), F.lit(None).cast("string").alias("suppression_reason"),
                    F.col("sent_at").alias("teams_sent_at"), F.col("api_response_code").alias("teams_response_code"),
                    F.col("send_success").alias("teams_send_success")))


def unsent_payloads(payload: DataFrame) -> DataFrame:
    """Rows still to deliver, oldest detection first."""
    return payload.filter(F.col("sent_at").isNull()).orderBy("detected_at", "alert_episode_key")


def alert_delivery_merge(payload: DataFrame, responses: DataFrame, sent_at: AsOf) -> DataFrame:
    """Fold delivery results back into the payload table.

    ``responses``: alert_episode_key, response_code (int, NULL when the call
    raised). A response sets ``sent_at``; success is 200 or 202; an exception
    leaves ``sent_at`` NULL with code -1 so the row is retried. Rows already
    sent and rows without a response keep their status."""
    r = responses.select("alert_episode_key", F.col("response_code").alias("_code"), F.lit(True).alias("_tried"))
    j = payload.join(r, "alert_episode_key", "left")
    pending = F.col("sent_at").isNull() & F.col("_tried").isNotNull()
    got = F.col("_code").isNotNull()
    return j.select(
        *[c for c in payload.columns if c not in ("sent_at", "api_response_code", "send_success")],
        F.when(pending & got, sent_at.ts_col()).otherwise(F.col("sent_at")).alias("sent_at"),
        F.when(pending, F.coalesce(F.col("_code"), F.lit(-1))).otherwise(F.col("api_response_code"))
        .cast("int").alias("api_response_code"),
        F.when(pending, F.coalesce(F.col("_code").isin(200, 202), F.lit(False))).otherwise(F.col("send_success"))
        .alias("send_success"))


# -- outbox ---------------------------------------------------------------------

OUTBOX = "alert_episode_key string, attempts int, last_attempt_at timestamp_ntz, sent_at timestamp_ntz, api_response_code int, send_success boolean"


def outbox_queue(payload: DataFrame, outbox: DataFrame | None) -> DataFrame:
    """The messages to try now: those of the payload that the outbox does not know or
    has not sent. A rebuilt payload brings nothing back that was sent before."""
    keys = payload.select("alert_episode_key").filter("alert_episode_key IS NOT NULL").distinct()
    if outbox is None:
        return keys
    return keys.join(outbox.filter("sent_at IS NOT NULL").select("alert_episode_key"), "alert_episode_key", "left_anti")


def outbox_update(queue: DataFrame, outbox: DataFrame | None, responses: DataFrame, at: Column) -> DataFrame:
    """The outbox rows that one round of delivery changes: a row per queued message
    that was tried, its attempt counted. ``responses``: alert_episode_key and
    response_code, null where the call raised; such a message stays unsent with code -1,
    any other response sets ``sent_at``, and 200 and 202 are a success."""
    r = responses.select("alert_episode_key", F.col("response_code").cast("int").alias("code"))
    tried = queue.join(r, "alert_episode_key")
    if outbox is None:
        tried = tried.withColumn("attempts", F.lit(0))
    else:
        tried = tried.join(outbox.select("alert_episode_key", "attempts"), "alert_episode_key", "left")
    return tried.select(
        "alert_episode_key", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempts"), at.alias("last_attempt_at"),
        F.when(F.col("code").isNotNull(), at).alias("sent_at"), F.coalesce("code", F.lit(-1)).alias("api_response_code"),
        F.coalesce(F.col("code").isin(200, 202), F.lit(False)).alias("send_success"))


def with_delivery(payload: DataFrame, outbox: DataFrame) -> DataFrame:
    """The payload with its messages' state of delivery."""
    state = outbox.select("alert_episode_key", *[F.col(c).alias(f"_{c}") for c in ("sent_at", "api_response_code", "send_success")])
    joined = payload.join(state, "alert_episode_key", "left")
    return joined.select(*[F.coalesce(c, f"_{c}").alias(c) if c in ("sent_at", "api_response_code", "send_success") else F.col(c) for c in payload.columns])


# -- facts of the cards ------------------------------------------------------------

_CARD = "struct<attachments:array<struct<content:struct<body:array<struct<type:string,facts:array<struct<title:string,value:string>>>>>>>>"


def payload_facts(payload: DataFrame) -> DataFrame:
    """The facts that a message's card shows, a row each: its section (1 or 2), place
    and title, and the value as a number where it is one (without $ and %), else as text."""
    body = F.from_json("teams_payload_json", _CARD)["attachments"][0]["content"]["body"]
    sets = F.filter(body, lambda b: b["type"] == "FactSet")
    rows = payload.select("alert_episode_key", F.posexplode(sets).alias("section", "set"))
    rows = rows.select("alert_episode_key", "section", F.posexplode("set.facts").alias("place", "fact"))
    number = F.regexp_replace("fact.value", "^[$]|%$", "").try_cast("double")
    return rows.select("alert_episode_key", (F.col("section") + 1).alias("section"), (F.col("place") + 1).alias("place"), F.col("fact.title").alias("title"),
                       number.alias("value_number"), F.when(number.isNull(), F.col("fact.value")).alias("value_text"))
