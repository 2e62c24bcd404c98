"""Wiring of every model: which operator runs on which inputs."""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import functions as _F

from costlens.streaming import incremental as INC
from costlens.streaming import replays as RP
from costlens.operators import attribution as A
from costlens.plans.pipeline import model


@model("price")
def _price(p):
    return A.enterprise_price(p.seed("credit_pricing"), p.as_of)


@model("stg_warehouse_role_usage")
def _role_usage(p):
    return A.warehouse_role_usage(p["stg_query_history"])


@model("seed_load")
def _seed_load(p):
    from costlens.operators.account import seed_inventory
    return seed_inventory(p)


@model("warehouse_daily_credits")
def _wdc(p):
    return A.warehouse_daily_credits(p["stg_warehouse_metering"], p["price"])


@model("serverless_credits")
def _svc(p):
    return A.serverless_credits(p["stg_pipe_usage"], p["stg_clustering"], p["stg_mv_refresh"],
                                p["stg_serverless_task"], p["stg_search_optimization"], p["price"])


@model("daily_cost_rollup")
def _dcr(p):
    return A.daily_cost_rollup(p["warehouse_daily_credits"], p["stg_storage_usage"], p["serverless_credits"])


@model("query_cost_attribution")
def _qca(p):
    return A.query_cost_attribution(p["stg_query_history"], p["price"])


@model("query_patterns")
def _qp(p):
    return A.query_patterns(p["query_cost_attribution"])


@model("team_cost_attribution")
def _tca(p):
    return A.team_cost_attribution(p["query_cost_attribution"])


@model("user_cost_summary")
def _ucs(p):
    return A.user_cost_summary(p["query_cost_attribution"])


# -- warehouse analysis -------------------------------------------------------
from costlens.operators import sketches as SK  # noqa: E402
from costlens.operators import warehouse as W  # noqa: E402


@model("warehouse_utilisation")
def _util(p):
    return W.warehouse_utilisation(p["stg_warehouse_load"])


@model("idle_warehouse_periods")
def _idle(p):
    return W.idle_warehouse_periods(p["warehouse_utilisation"], p["price"], p.opt("split_on_gap", False))


@model("idle_island_stream")
def _idle_stream(p):
    return W.idle_costs(RP.closed_islands(p["warehouse_utilisation"]), p["price"])


@model("warehouse_queue_analysis")
def _queue(p):
    return W.warehouse_queue_analysis(p["warehouse_utilisation"])


@model("warehouse_schedule_analysis")
def _sched(p):
    return W.warehouse_schedule_analysis(p["query_cost_attribution"])


@model("warehouse_sizing_analysis")
def _sizing(p):
    return W.warehouse_sizing_analysis(p["stg_query_history"], p["warehouse_utilisation"],
                                       p.opt("approx_percentiles", False),
                                       p["latency_days"] if p.opt("sketched_percentiles", False) else None)


@model("latency_days")
def _latency_days(p):
    return SK.latency_days(W.sized_runs(p["stg_query_history"]))


@model("latency_sketch_bounds")
def _latency_bounds(p):
    return SK.latency_bounds(W.sized_runs(p["stg_query_history"]), SK.latency_percentiles(p["latency_days"]))


@model("team_user_days")
def _team_user_days(p):
    return SK.team_user_days(p["query_cost_attribution"])


@model("team_user_sketch_bounds")
def _team_user_bounds(p):
    return SK.team_user_bounds(p["query_cost_attribution"], SK.team_distinct_users(p["team_user_days"]))


@model("warehouse_auto_suspend")
def _suspend(p):
    return W.warehouse_auto_suspend(p["idle_warehouse_periods"], p["price"])


# -- anti-patterns ------------------------------------------------------------
from costlens.operators import antipatterns as AP  # noqa: E402


@model("query_history_costed")
def _costed(p):
    return AP.costed(p["stg_query_history"], p["price"])


def _rule(key, rule):
    @model(key)
    def build(p):
        return AP.single_rule(p["query_history_costed"], rule, p.as_of, p.opt("select_star_multiline", False))
    return build


for _key, _rule_name in (("ap_full_table_scan", "FULL_TABLE_SCAN"), ("ap_select_star", "SELECT_STAR"),
                         ("ap_spill", "SPILL_TO_STORAGE"), ("ap_cartesian_join", "CARTESIAN_JOIN"),
                         ("ap_large_sort", "LARGE_SORT_NO_LIMIT"), ("ap_long_running", "LONG_RUNNING")):
    _rule(_key, _rule_name)


@model("ap_repeated")
def _ap_rep(p):
    return AP.repeated_queries(p["query_patterns"])


@model("ap_union")
def _ap_union(p):
    return AP.antipattern_union(p["query_history_costed"], p["query_patterns"], p.as_of,
                                p.opt("select_star_multiline", False))


# -- storage --------------------------------------------------------------------
from costlens.operators import storage as S  # noqa: E402


@model("storage_breakdown")
def _sb(p):
    access = p.raw.get("access_reads")
    return S.storage_breakdown(p["stg_table_storage"], p["stg_access_history"] if access is None else access, p.as_of)


@model("storage_breakdown_json")
def _sbj(p):
    """From the access history as JSON text, the form in which accounts export it."""
    access = p["stg_access_history"].select("query_start_time", _F.to_json("base_objects_accessed").alias("base_objects_accessed"))
    return S.storage_breakdown(p["stg_table_storage"], access, p.as_of)


for _key, _fn in (("storage_unused_tables", S.storage_unused_tables),
                  ("storage_time_travel_waste", S.storage_time_travel_waste),
                  ("storage_transient_candidates", S.storage_transient_candidates),
                  ("storage_clone_overhead", S.storage_clone_overhead),
                  ("storage_analysis", S.storage_analysis)):
    model(_key)(lambda p, _fn=_fn: _fn(p["storage_breakdown"]))


@model("storage_recommendations")
def _srec(p):
    return S.storage_recommendations(p["storage_unused_tables"], p["storage_time_travel_waste"],
                                     p["storage_transient_candidates"], p["storage_clone_overhead"])


# -- forecasting, seasonality, freshness ------------------------------------------
from costlens.operators import forecast as FC  # noqa: E402


@model("cost_forecast_daily")
def _cfd(p):
    return FC.cost_forecast_daily(p.spark, p["daily_cost_rollup"], p.as_of)


@model("cost_seasonality_baseline")
def _csb(p):
    return FC.cost_seasonality_baseline(p["daily_cost_rollup"], p.as_of)


@model("team_cost_forecast")
def _tcf(p):
    return FC.team_cost_forecast(p.spark, p["team_cost_attribution"], p.as_of, aligned=p.opt("aligned", False))


@model("cost_forecast_monthly")
def _cfm(p):
    return FC.cost_forecast_monthly(p["cost_forecast_daily"], p["daily_cost_rollup"], p.as_of)


@model("data_freshness_monitor")
def _dfm(p):
    return FC.data_freshness_monitor({k: p[k] for _, _, k, _ in FC.FRESHNESS_SOURCES}, p.as_of)


@model("data_freshness")
def _df(p):
    return FC.data_freshness(p["data_freshness_monitor"])


# -- recommendations ------------------------------------------------------------
from costlens.operators import recommend as R  # noqa: E402


@model("warehouse_recommendations")
def _whrec(p):
    return R.warehouse_recommendations(*p.together("warehouse_sizing_analysis", "warehouse_auto_suspend",
                                                   "warehouse_schedule_analysis", "stg_warehouse_metering"),
                                       p.opt("drop_noop_resize", False))


@model("query_optimization_candidates")
def _qoc(p):
    return R.query_optimization_candidates(p["ap_union"], p.opt("top_candidates", 100))


@model("antipattern_summary")
def _aps(p):
    return R.antipattern_summary(p["ap_union"], p.as_of)


@model("all_recommendations")
def _allrec(p):
    return R.all_recommendations(p["warehouse_recommendations"], p["query_optimization_candidates"],
                                 p["storage_recommendations"])


@model("recommendation_lifecycle")
def _lc(p):
    return R.recommendation_lifecycle(p["all_recommendations"], p.seed("recommendation_actions"),
                                      p["warehouse_daily_credits"], p.as_of)


@model("recommendation_roi")
def _roi(p):
    return R.recommendation_roi(p["recommendation_lifecycle"])


# -- publication ------------------------------------------------------------------
from costlens.operators import publish as PB  # noqa: E402

model("cost_summary")(lambda p: PB.cost_summary(p["daily_cost_rollup"]))
model("cost_trends_daily")(lambda p: PB.cost_trends_daily(p["daily_cost_rollup"]))
model("cost_by_query_type")(lambda p: PB.cost_by_query_type(p["query_cost_attribution"]))
model("cost_by_user")(lambda p: PB.cost_by_user(p["user_cost_summary"], p["query_cost_attribution"]))
model("cost_by_warehouse")(lambda p: PB.cost_by_warehouse(p["warehouse_daily_credits"], p["warehouse_utilisation"],
                                                          p["query_cost_attribution"]))
model("warehouse_efficiency")(lambda p: PB.warehouse_efficiency(p["warehouse_utilisation"],
                                                                p["query_cost_attribution"]))
model("team_cost_dashboard")(lambda p: PB.team_cost_dashboard(
    p["team_cost_attribution"], SK.team_distinct_users(p["team_user_days"]) if p.opt("distinct_users", False) else None))
model("weekly_executive_report")(lambda p: PB.weekly_executive_report(
    *p.published("daily_cost_rollup", "cost_by_warehouse", "all_recommendations", "alert_state_tracker"), p.as_of))
model("weekly_report_html")(lambda p: PB.weekly_report_html(p["weekly_executive_report"]))


# -- alerts ---------------------------------------------------------------------------
from costlens.operators import alerts as AL  # noqa: E402

model("alert_cost_daily_spike")(lambda p: AL.cost_daily_spike(
    p.seed("alert_configuration"), p["daily_cost_rollup"], p["cost_seasonality_baseline"], p.as_of))
model("alert_warehouse_idle")(lambda p: AL.warehouse_idle(
    p.seed("alert_configuration"), p["idle_warehouse_periods"], p.as_of))
model("alert_credit_budget")(lambda p: AL.credit_budget(
    p.seed("alert_configuration"), p["warehouse_daily_credits"], p.seed("monthly_budget"), p.as_of))
model("alert_query_spill")(lambda p: AL.query_spill(p.seed("alert_configuration"), p["stg_query_history"], p.as_of))
model("alert_storage_growth")(lambda p: AL.storage_growth(
    p.seed("alert_configuration"), p["stg_database_storage"], p.as_of))
model("alert_repeated_expensive")(lambda p: AL.repeated_expensive(
    p.seed("alert_configuration"), p["query_patterns"], p.as_of))
model("alert_query_long_running")(lambda p: AL.query_long_running(
    p.seed("alert_configuration"), p["stg_query_history"], p.as_of))
ALERT_DETECTORS = ["alert_cost_daily_spike", "alert_warehouse_idle", "alert_credit_budget", "alert_query_spill",
                   "alert_storage_growth", "alert_repeated_expensive", "alert_query_long_running"]
model("alert_union")(lambda p: AL.alert_union([p[k] for k in ALERT_DETECTORS], p.seed("alert_suppressions"),
                                              p.seed("bank_holidays"), p.seed("alert_configuration")))
model("alert_state_tracker")(lambda p: AL.alert_state_tracker(p["alert_union"], p.opt("alert_previous_state"),
                                                              p.as_of))
def _earlier_clock(p):
    return _F.expr(p.as_of.ts_sql()) - _F.expr("INTERVAL 2 HOURS")


@model("alert_state_earlier")
def _earlier(p):
    """What a run two hours before this one would have stored: no earlier state, and
    only the alerts detected by then."""
    then = _earlier_clock(p)
    known = p["alert_union"].filter((_F.col("detected_at") < then) & _F.col("resource_key").isNotNull())
    return AL.alert_state_tracker(known, None, p.as_of).withColumn("evaluated_at", then)


model("alert_state_carried")(lambda p: AL.alert_state_tracker(p["alert_union"], p["alert_state_earlier"], p.as_of))
model("alert_history_carried")(lambda p: INC.merge(p["alert_state_earlier"], p["alert_state_carried"], ["alert_episode_key"], AL.latest_order())
                               .select("alert_episode_key", "alert_id", "detected_at", "resource_key", "episode_number", "is_new_episode", "is_continuation", "evaluated_at"))


@model("episode_stream")
def _episode_stream(p):
    found = RP.written_once(p["alert_union"], "alerts-found")
    earlier = found.filter((_F.col("detected_at") < _earlier_clock(p)) & _F.col("resource_key").isNotNull())
    return AL.one_per_episode(RP.episodes_of_last_run([(earlier, _earlier_clock(p)), (found, p.as_of.ts_col())]))


model("alert_payload")(lambda p: AL.alert_payload(p["alert_state_tracker"], p.seed("alert_configuration")))
model("alert_history")(lambda p: AL.alert_history(p["alert_state_tracker"], p.seed("alert_configuration"),
                                                  p["alert_payload"]))


model("alert_payload_facts")(lambda p: AL.payload_facts(p["alert_payload"]))
model("alert_outbox")(lambda p: RP.delivered(p["alert_payload"], p.as_of))


# -- dashboard queries ------------------------------------------------------------------
from costlens.operators import dashboard as D  # noqa: E402

_P = D.DEFAULTS
model("dash_cost_trends")(lambda p: D.cost_trends(p["cost_trends_daily"], p.as_of, p.opt("days", _P["days"])))
model("dash_top_warehouses")(lambda p: D.top_warehouses(p["cost_by_warehouse"]))
model("dash_top_users")(lambda p: D.top_users(p["cost_by_user"]))
model("dash_warehouse_list")(lambda p: D.warehouse_list(p["cost_by_warehouse"]))
model("dash_daily_credits")(lambda p: D.daily_credits(p["warehouse_daily_credits"], p.as_of, p.opt("days", _P["days"])))
model("dash_idle_periods")(lambda p: D.idle_periods(p["idle_warehouse_periods"], p.opt("warehouse", _P["warehouse"])))
model("dash_storage_by_database")(lambda p: D.storage_by_database(p["storage_analysis"]))
model("dash_anomaly_days")(lambda p: D.anomaly_days(p["cost_trends_daily"]))
model("dash_cost_heatmap")(lambda p: D.cost_heatmap(p["query_cost_attribution"], p.as_of, p.opt("days", _P["days"])))
model("dash_freshness")(lambda p: D.freshness(p["data_freshness"]))
model("dash_freshness_summary")(lambda p: D.freshness_summary(p["data_freshness"]))
model("dash_team_forecast")(lambda p: D.team_forecast(p["team_cost_forecast"]))
model("dash_annual_spend")(lambda p: D.annual_spend(p["cost_forecast_monthly"]))
model("dash_monthly_comparison")(lambda p: D.monthly_comparison(p["cost_trends_daily"]))
model("dash_latest_month_teams")(lambda p: D.latest_month_teams(p["team_cost_dashboard"]))
model("dash_weekly_comparison")(lambda p: D.weekly_comparison(p["cost_trends_daily"]))
model("dash_payload_health")(lambda p: D.payload_health(p["alert_payload"]))
model("dash_recent_alerts")(lambda p: D.recent_alerts(p["alert_history"]))
model("dash_alert_trend")(lambda p: D.alert_trend(p["alert_history"]))
model("dash_savings_by_type")(lambda p: D.savings_by_type(p["warehouse_recommendations"]))
model("dash_candidate_filter")(lambda p: D.candidate_filter(
    p["query_optimization_candidates"], p.opt("candidate_types", _P["candidate_types"]),
    p.opt("candidate_users", _P["candidate_users"]), p.opt("candidate_warehouses", _P["candidate_warehouses"])))
model("dash_table_lineage")(lambda p: D.table_lineage(p["query_optimization_candidates"], p["stg_table_storage"]))
model("dash_storage_waste")(lambda p: D.storage_waste(p["storage_recommendations"], p["storage_analysis"]))
model("dash_savings_breakdown")(lambda p: D.savings_breakdown(p["all_recommendations"]))
model("dash_recommendation_filter")(lambda p: D.recommendation_filter(
    p["recommendation_lifecycle"], p.opt("rec_categories", _P["rec_categories"]),
    p.opt("rec_statuses", _P["rec_statuses"])))
model("dash_forecast_kpis")(lambda p: D.forecast_kpis(p["cost_forecast_daily"]))
model("dash_home_kpis")(lambda p: D.home_kpis(p["cost_summary"]))
model("dash_storage_totals")(lambda p: D.storage_totals(p["storage_analysis"]))
model("dash_time_travel_waste")(lambda p: D.time_travel_waste(p["storage_analysis"]))
model("dash_antipattern_totals")(lambda p: D.antipattern_totals(p["antipattern_summary"]))
model("dash_storage_treemap")(lambda p: D.storage_treemap(p["storage_analysis"]))
model("dash_roi_kpis")(lambda p: D.roi_kpis(p["recommendation_roi"]))
model("dash_funnel")(lambda p: D.funnel(p["recommendation_roi"]))
model("dash_implemented_detail")(lambda p: D.implemented_detail(p["recommendation_roi"]))
model("dash_team_forecast_filter")(lambda p: D.team_forecast_filter(p["team_cost_forecast"],
                                                                    p.opt("teams", _P["teams"])))
model("dash_report_top_list")(lambda p: D.report_top_list(p["weekly_executive_report"]))
model("dash_unsent_alerts")(lambda p: D.unsent_alerts(p["alert_payload"]))


# -- workload shapes --------------------------------------------------------------------
from costlens.operators import workload as WL  # noqa: E402

for _key, _fn in WL.WORKLOAD.items():
    model(_key)(lambda p, _fn=_fn: _fn(p.star()))


# -- data quality -----------------------------------------------------------------------
from costlens.operators import quality as Q  # noqa: E402



def _checks(p):
    """Writes every checked model, at the same time where they do not build on each other."""
    p.published(*Q.CHECKS)
    return p


model("dq_columns")(lambda p: Q.column_report(_checks(p).checked, observed=p.failures))
for _kind in ("not_null", "accepted_values", "non_negative"):
    model(f"dq_{_kind}")(lambda p, kind=_kind: p["dq_columns"].filter(_F.col("check_type") == kind))
model("dq_unique")(lambda p: Q.unique(_checks(p).checked))
model("dq_relationships")(lambda p: Q.relationships([
    ("alert_suppressions", p.seed("alert_suppressions"), "alert_id", p.seed("alert_configuration"), "alert_id"),
    ("alert_union", p.checked("alert_union"), "alert_id", p.seed("alert_configuration"), "alert_id"),
    ("stg_warehouse_metering", p.checked("stg_warehouse_metering"), "warehouse_name", p.seed("warehouse_team_mapping"), "warehouse_name")]))
model("dq_schema_report")(lambda p: Q.schema_report([p["dq_columns"], p["dq_unique"], p["dq_relationships"]]))
model("dq_source_freshness")(lambda p: Q.source_freshness(
    {src: (p[key], col) for src, _, key, col in FC.FRESHNESS_SOURCES}, p.as_of))
model("dq_pricing_complete")(lambda p: Q.pricing_complete(p.seed("credit_pricing"), p["stg_warehouse_metering"]))
model("dq_rollup_components")(lambda p: Q.rollup_components(p["daily_cost_rollup"]))
model("dq_efficiency_range")(lambda p: Q.efficiency_range(p["warehouse_efficiency"]))
model("dq_forecast_future")(lambda p: Q.forecast_future(p["cost_forecast_daily"], p.as_of))
model("dq_forecast_positive")(lambda p: Q.forecast_positive(p["cost_forecast_daily"]))
model("dq_freshness_sources")(lambda p: Q.freshness_sources(p["data_freshness_monitor"]))
model("dq_no_duplicate_recs")(lambda p: Q.no_duplicate_recs(p["all_recommendations"]))
model("dq_no_future_dates")(lambda p: Q.no_future_dates(p["stg_query_history"], p.as_of))
model("dq_seasonality_days")(lambda p: Q.seasonality_days(p["cost_seasonality_baseline"]))
model("dq_team_sum")(lambda p: Q.team_sum(p["team_cost_attribution"], p["query_cost_attribution"]))
model("dq_warehouse_metered")(lambda p: Q.warehouse_metered(p["warehouse_recommendations"], p["stg_warehouse_metering"]))


# -- account statistics and verification --------------------------------------------------------
from costlens.operators import account as AC  # noqa: E402

model("scan_query_stats")(lambda p: AC.query_stats(p["stg_query_history"], p.as_of))
model("scan_metering")(lambda p: AC.metering_totals(p["stg_warehouse_metering"]))
model("scan_top_tables")(lambda p: AC.top_tables(p["stg_table_storage"]))
model("verify_tagged_queries")(lambda p: AC.tagged_queries(p["stg_query_history"], p.as_of))
model("verify_indicators")(lambda p: AC.indicators(p["stg_query_history"], p.as_of))
model("verify_recent_metering")(lambda p: AC.recent_metering(p["stg_warehouse_metering"], p.as_of, p.opt("recent_hours", AC.RECENT_HOURS)))
model("verify_publication_counts")(lambda p: AC.publication_counts(dict(zip(AC.PUBLICATION_TABLES, p.published(*AC.PUBLICATION_TABLES)))))


# -- incremental load (N01, N02) ------------------------------------------------------------

FIRST_LOAD_LAG_DAYS = 7


def _first_load(p):
    """History as a previous run would have loaded it: rows ended a week ago."""
    return p["stg_query_history"].filter(
        _F.col("end_time") < p.as_of.ts_col() - _F.expr(f"INTERVAL {FIRST_LOAD_LAG_DAYS} DAYS"))


model("incremental_extract")(lambda p: INC.incremental_extract(p["stg_query_history"], _first_load(p)))
@model("upsert_versions")
def _upsert_versions(p):
    """Two upserts into a new table of the shared folder, read back."""
    root = INC.table_root(p.spark, f"query-history-{_uuid.uuid4().hex}")
    order = [_F.col("end_time").desc(), _F.col("_loaded_at").desc()]
    INC.upsert(p.spark, root, _first_load(p), ["query_id"], order)
    return INC.upsert(p.spark, root, INC.incremental_extract(p["stg_query_history"], INC.read_current(p.spark, root)), ["query_id"], order)


model("upsert")(lambda p: INC.merge(_first_load(p), p["incremental_extract"], ["query_id"],
                                    [_F.col("end_time").desc(), _F.col("_loaded_at").desc()]))
model("incremental_stream")(lambda p: RP.loaded_history(p["stg_query_history"], p.as_of))
model("upsert_days")(lambda p: RP.upserted_days(p["stg_query_history"], _first_load(p)))
