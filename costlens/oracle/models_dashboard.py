"""Oracle SQL: dashboard queries (default widget values)."""

from costlens.oracle.base import TODAY, cte, final
from costlens.operators.dashboard import DEFAULTS, FUNNEL


def inlist(xs) -> str:
    return "(" + ", ".join("'" + x + "'" for x in xs) + ")"


D = DEFAULTS["days"]
final("dash_cost_trends", f"SELECT * FROM cost_trends_daily WHERE date >= {TODAY} - INTERVAL {D} DAY")
final("dash_top_warehouses", "SELECT warehouse_name, total_cost_usd FROM cost_by_warehouse "
                             "ORDER BY total_cost_usd DESC, warehouse_name LIMIT 5")
final("dash_top_users", "SELECT user_name, total_cost_usd FROM cost_by_user "
                        "ORDER BY total_cost_usd DESC, user_name NULLS FIRST LIMIT 5")
final("dash_warehouse_list", "SELECT DISTINCT warehouse_name FROM cost_by_warehouse")
final("dash_daily_credits", f"SELECT * FROM warehouse_daily_credits WHERE date >= {TODAY} - INTERVAL {D} DAY")
final("dash_idle_periods", f"SELECT * FROM idle_warehouse_periods WHERE warehouse_name = '{DEFAULTS['warehouse']}' "
                           "ORDER BY idle_start DESC LIMIT 50")
final("dash_storage_by_database", """SELECT database_name, SUM(active_tb) AS active_tb, SUM(time_travel_tb) AS time_travel_tb,
  SUM(failsafe_tb) AS failsafe_tb, SUM(total_tb) AS total_tb, SUM(estimated_monthly_cost_usd) AS total_cost_usd
FROM storage_analysis GROUP BY database_name""")
final("dash_anomaly_days", "SELECT * FROM cost_trends_daily WHERE is_anomaly = TRUE")
_hours = ", ".join(f"COALESCE(SUM(CASE WHEN h = {h} THEN c END), 0) AS h{h:02d}" for h in range(24))
final("dash_cost_heatmap", f"""SELECT day_of_week, {_hours}
FROM (SELECT isodow(start_time) AS day_of_week, EXTRACT(HOUR FROM start_time) AS h, estimated_cost_usd AS c
      FROM query_cost_attribution WHERE start_time >= {TODAY} - INTERVAL {D} DAY) x
GROUP BY day_of_week""")
final("dash_freshness", "SELECT source_name, model_name, latest_record_at, staleness_minutes, freshness_status "
                        "FROM data_freshness")
final("dash_freshness_summary", "SELECT DISTINCT overall_freshness_status, overall_max_staleness_minutes, "
                                "overall_oldest_record_at FROM data_freshness")
final("dash_team_forecast", "SELECT team_name, forecast_month, predicted_monthly_cost, ci_lower, ci_upper, "
                            "monthly_trend, data_months FROM team_cost_forecast")
final("dash_annual_spend", "SELECT DISTINCT projected_annual_spend FROM cost_forecast_monthly")
final("dash_monthly_comparison", "SELECT strftime(date, '%Y-%m') AS month, SUM(total_cost) AS total_cost "
                                 "FROM cost_trends_daily GROUP BY 1 ORDER BY 1 DESC LIMIT 6")
final("dash_latest_month_teams", "SELECT * FROM team_cost_dashboard "
                                 "WHERE month = (SELECT MAX(month) FROM team_cost_dashboard)")
final("dash_weekly_comparison", """SELECT week_start AS week, SUM(total_cost) AS total_cost, SUM(compute_cost) AS compute_cost,
  SUM(storage_cost) AS storage_cost, SUM(serverless_cost) AS serverless_cost
FROM cost_trends_daily GROUP BY 1 ORDER BY 1 DESC LIMIT 12""")
cte("alert_payload_typed", """SELECT t.alert_episode_key, t.alert_id, t.detected_at, t.resource_key, ac.severity,
  CAST(NULL AS TIMESTAMP) AS sent_at, CAST(NULL AS INTEGER) AS api_response_code, CAST(NULL AS BOOLEAN) AS send_success
FROM alert_state_tracker t
JOIN seed_alert_configuration ac ON t.alert_id = ac.alert_id AND ac.teams_enabled = TRUE AND ac.enabled = TRUE
WHERE t.is_new_episode = TRUE""")
final("dash_payload_health", """SELECT COUNT(*) AS total_alerts, COUNT(*) FILTER (WHERE send_success = TRUE) AS sent_ok,
  COUNT(*) FILTER (WHERE send_success = FALSE) AS sent_fail, COUNT(*) FILTER (WHERE sent_at IS NULL) AS pending,
  MAX(sent_at) AS last_sent FROM alert_payload_typed""")
final("dash_recent_alerts", """SELECT alert_id, alert_name, severity, detected_at, resource_key, metric_value, threshold_value,
  is_new_episode, episode_number, teams_sent_at, teams_send_success
FROM alert_history ORDER BY detected_at DESC, alert_episode_key LIMIT 50""")
final("dash_alert_trend", "SELECT CAST(detected_at AS DATE) AS alert_date, severity, COUNT(*) AS alert_count "
                          "FROM alert_history WHERE is_new_episode = TRUE GROUP BY 1, 2")
final("dash_savings_by_type", "SELECT recommendation_type, SUM(estimated_monthly_savings_usd) AS total_savings_usd, "
                              "COUNT(*) AS rec_count FROM warehouse_recommendations GROUP BY 1")
final("dash_candidate_filter", f"""SELECT * FROM query_optimization_candidates
WHERE antipattern_type IN {inlist(DEFAULTS['candidate_types'])} AND user_name IN {inlist(DEFAULTS['candidate_users'])}
  AND warehouse_name IN {inlist(DEFAULTS['candidate_warehouses'])}""")
final("dash_table_lineage", r"""SELECT x.optimization_rank, x.query_id, x.table_pos, x.table_ref,
  len(string_split(x.table_ref, '.')) AS name_parts, m.active_bytes AS table_bytes
FROM (SELECT optimization_rank, query_id, unnest(names) AS table_ref, generate_subscripts(names, 1) - 1 AS table_pos
      FROM (SELECT optimization_rank, query_id,
                   list_slice(list_distinct_ordered, 1, 5) AS names
            FROM (SELECT optimization_rank, query_id,
                         list_filter(list_transform(regexp_extract_all(sample_query_text,
                             '(?i)(?:FROM|JOIN)\s+([A-Za-z0-9_]+(?:\.[A-Za-z0-9_]+){0,2})', 1), lambda t: upper(t)),
                           lambda t, i: list_position(list_transform(regexp_extract_all(sample_query_text,
                             '(?i)(?:FROM|JOIN)\s+([A-Za-z0-9_]+(?:\.[A-Za-z0-9_]+){0,2})', 1), lambda u: upper(u)), t) = i)
                           AS list_distinct_ordered
                  FROM query_optimization_candidates) a) b) x
LEFT JOIN (SELECT upper(concat_ws('.', database_name, schema_name, table_name)) AS table_ref, active_bytes
           FROM stg_table_storage WHERE table_dropped IS NULL) m ON x.table_ref = m.table_ref""")
final("dash_storage_waste", """SELECT w.total_waste_usd, c.total_storage_cost_usd,
  CASE WHEN c.total_storage_cost_usd > 0 THEN w.total_waste_usd / c.total_storage_cost_usd * 100 ELSE 0 END AS waste_pct
FROM (SELECT COALESCE(SUM(savings_if_applied_usd), 0) AS total_waste_usd FROM storage_recommendations) w
CROSS JOIN (SELECT COALESCE(SUM(estimated_monthly_cost_usd), 0) AS total_storage_cost_usd FROM storage_analysis) c""")
final("dash_savings_breakdown", """SELECT 'category' AS dimension, category AS value, SUM(estimated_monthly_savings_usd) AS total_savings_usd,
  COUNT(*) AS rec_count FROM all_recommendations GROUP BY category
UNION ALL
SELECT 'effort', effort, SUM(estimated_monthly_savings_usd), COUNT(*) FROM all_recommendations GROUP BY effort""")
final("dash_recommendation_filter", f"""SELECT * FROM recommendation_lifecycle
WHERE category IN {inlist(DEFAULTS['rec_categories'])} AND status IN {inlist(DEFAULTS['rec_statuses'])}""")
final("dash_forecast_kpis", """SELECT f.next_day_forecast, t.horizon_forecast_total, t.horizon_days, f.daily_trend,
  CASE WHEN f.daily_trend > 0 THEN 'increasing' WHEN f.daily_trend < 0 THEN 'decreasing' ELSE 'stable' END AS trend_direction
FROM (SELECT predicted_total_cost AS next_day_forecast, daily_trend FROM cost_forecast_daily ORDER BY forecast_date LIMIT 1) f
CROSS JOIN (SELECT SUM(predicted_total_cost) AS horizon_forecast_total, COUNT(*) AS horizon_days FROM cost_forecast_daily) t""")
final("dash_home_kpis", "SELECT month, total_cost, compute_cost, storage_cost, serverless_cost, mom_change_pct "
                        "FROM cost_summary ORDER BY month DESC LIMIT 6")
final("dash_storage_totals", """SELECT SUM(total_tb) AS total_tb, SUM(estimated_monthly_cost_usd) AS total_cost_usd,
  COUNT(DISTINCT database_name) AS database_count, COUNT(*) FILTER (WHERE is_unused) AS unused_tables,
  COALESCE(SUM(CASE WHEN is_unused THEN estimated_monthly_cost_usd END), 0) AS unused_cost_usd FROM storage_analysis""")
final("dash_time_travel_waste", "SELECT * FROM storage_analysis WHERE has_tt_waste = TRUE")
final("dash_antipattern_totals", """SELECT s.antipattern_type, s.query_count, s.total_estimated_waste,
  CASE WHEN s.trend_pct IS NULL THEN 'stable' WHEN s.trend_pct > 0 THEN 'increasing' WHEN s.trend_pct < 0 THEN 'decreasing'
       ELSE 'stable' END AS trend_label,
  CASE WHEN s.trend_pct IS NULL THEN 'N/A' ELSE printf('%.1f%%', s.trend_pct) END AS trend_text,
  t.all_queries, t.all_waste_usd
FROM antipattern_summary s
CROSS JOIN (SELECT SUM(query_count) AS all_queries, SUM(total_estimated_waste) AS all_waste_usd FROM antipattern_summary) t""")
final("dash_storage_treemap", "SELECT database_name, SUM(total_tb) AS total_tb, SUM(estimated_monthly_cost_usd) AS cost_usd, "
                              "COUNT(*) AS table_count FROM storage_analysis GROUP BY 1")
final("dash_roi_kpis", """SELECT total_actual_savings, implemented_estimated_savings, implemented_count,
  CASE WHEN implemented_estimated_savings > 0 THEN total_actual_savings / implemented_estimated_savings * 100 ELSE 0 END AS realised_pct
FROM (SELECT DISTINCT total_actual_savings, implemented_estimated_savings, implemented_count FROM recommendation_roi) f""")
final("dash_funnel", " UNION ALL ".join(
    f"SELECT '{s}' AS status, CAST({c} AS BIGINT) AS rec_count FROM (SELECT DISTINCT {', '.join(c for _, c in FUNNEL)} "
    f"FROM recommendation_roi) f" for s, c in FUNNEL))
final("dash_implemented_detail", "SELECT * FROM recommendation_roi WHERE status = 'IMPLEMENTED'")
final("dash_team_forecast_filter", f"SELECT * FROM team_cost_forecast WHERE team_name IN {inlist(DEFAULTS['teams'])}")
final("dash_report_top_list", """SELECT generate_subscripts(items, 1) AS position, unnest(items, recursive := true)
FROM (SELECT CAST(json_transform(top_savings_json,
        '[{"recommendation_id":"VARCHAR","category":"VARCHAR","target_object":"VARCHAR","estimated_monthly_savings_usd":"DOUBLE"}]')
        AS STRUCT(recommendation_id VARCHAR, category VARCHAR, target_object VARCHAR, estimated_monthly_savings_usd DOUBLE)[]) AS items
      FROM weekly_executive_report) r""")
final("dash_unsent_alerts", "SELECT alert_episode_key, alert_id, severity, detected_at, resource_key "
                            "FROM alert_payload_typed WHERE sent_at IS NULL")
