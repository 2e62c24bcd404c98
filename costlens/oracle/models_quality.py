"""Oracle SQL: data-quality checks, account statistics, verification."""

from costlens.oracle.base import FINAL, NOW, TODAY, cte, final
from costlens.oracle.models_cost import _BY_ROLE, _BY_WAREHOUSE, MONTH
from costlens.operators import account as AC
from costlens.operators import quality as Q


def _count(kind: str, table: str, column: str, bad: str) -> str:
    return (f"SELECT '{kind}' AS check_type, '{table}' AS table_name, '{column}' AS column_name, "
            f"count(*) FILTER (WHERE {bad}) AS failures FROM {table}")


_COLUMNS = {"not_null": [], "non_negative": [], "accepted_values": []}
_KEYS = []
for _t, _spec in Q.CHECKS.items():
    _COLUMNS["not_null"] += [_count("not_null", _t, c, f"{c} IS NULL") for c in _spec.get("not_null", ())]
    _COLUMNS["non_negative"] += [_count("non_negative", _t, c, f"{c} < 0") for c in _spec.get("non_negative", ())]
    _COLUMNS["accepted_values"] += [_count("accepted_values", _t, c, f"list_position({v}, {c}) IS NULL AND {c} IS NOT NULL") for c, v in _spec.get("accepted", {}).items()]
    _KEYS += [f"SELECT 'unique' AS check_type, '{_t}' AS table_name, '{c}' AS column_name, count(*) AS failures FROM (SELECT 1 FROM {_t} GROUP BY {c} HAVING count(*) > 1)" for c in _spec.get("unique", ())]
_LINKS = [_count("relationships", "seed_alert_suppressions", "alert_id", "alert_id NOT IN (SELECT alert_id FROM seed_alert_configuration)").replace("'seed_alert_suppressions' AS", "'alert_suppressions' AS"),
          _count("relationships", "alert_union", "alert_id", "alert_id NOT IN (SELECT alert_id FROM seed_alert_configuration)"),
          _count("relationships", "stg_warehouse_metering", "warehouse_name", "warehouse_name NOT IN (SELECT warehouse_name FROM seed_warehouse_team_mapping)")]
for _kind, _parts in _COLUMNS.items():
    final(f"dq_{_kind}", " UNION ALL ".join(_parts))
final("dq_unique", " UNION ALL ".join(_KEYS))
final("dq_relationships", " UNION ALL ".join(_LINKS))
final("dq_schema_report", f"""SELECT *, CASE check_type WHEN 'relationships' THEN 'warn' ELSE 'error' END AS severity,
  CASE failures WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({' UNION ALL '.join([x for v in _COLUMNS.values() for x in v] + _KEYS + _LINKS)})""")
_age = f"date_diff('microsecond', latest, {NOW}) / 3600000000.0"
final("dq_source_freshness", f"""SELECT source_name, latest, {_age} AS age_hours,
  CASE WHEN latest IS NULL OR {_age} > {Q.FRESHNESS_ERROR_HOURS} THEN 'error' WHEN {_age} > {Q.FRESHNESS_WARN_HOURS} THEN 'warn'
       ELSE 'pass' END AS status
FROM (SELECT 'query_history' AS source_name, MAX(end_time) AS latest FROM stg_query_history
      UNION ALL SELECT 'warehouse_metering_history', MAX(end_time) FROM stg_warehouse_metering
      UNION ALL SELECT 'storage_usage', CAST(MAX(usage_date) AS TIMESTAMP) FROM stg_storage_usage
      UNION ALL SELECT 'warehouse_load_history', MAX(start_time) FROM stg_warehouse_load
      UNION ALL SELECT 'login_history', MAX(event_timestamp) FROM stg_login_history
      UNION ALL SELECT 'database_storage_usage_history', CAST(MAX(usage_date) AS TIMESTAMP) FROM stg_database_storage) s""")
final("dq_pricing_complete", """SELECT edition, month
FROM (SELECT unnest(['STANDARD', 'ENTERPRISE', 'BUSINESS_CRITICAL']) AS edition), (SELECT DISTINCT CAST(date_trunc('month', start_time) AS DATE) AS month FROM stg_warehouse_metering)
WHERE NOT EXISTS (FROM seed_credit_pricing p WHERE p.edition = edition AND month BETWEEN effective_from AND effective_to)""".replace("p.edition = edition", "p.edition = e.edition").replace("AS edition), (SELECT", "AS edition) e, (SELECT"))
final("dq_rollup_components", "SELECT date, total_cost, compute_cost, storage_cost, serverless_cost FROM daily_cost_rollup "
                              "WHERE ABS(total_cost - (compute_cost + storage_cost + serverless_cost)) > 0.01")
final("dq_efficiency_range", "SELECT * FROM warehouse_efficiency WHERE efficiency_score < 0 OR efficiency_score > 100")
final("dq_forecast_future", f"SELECT * FROM cost_forecast_daily WHERE forecast_date <= {TODAY}")
final("dq_forecast_positive", "SELECT * FROM cost_forecast_daily WHERE predicted_total_cost < 0")
final("dq_freshness_sources", "SELECT * FROM (SELECT COUNT(DISTINCT source_name) AS source_count "
                              "FROM data_freshness_monitor) t WHERE source_count < 5")
final("dq_no_duplicate_recs", "SELECT recommendation_id, COUNT(*) AS count FROM all_recommendations "
                              "GROUP BY recommendation_id HAVING COUNT(*) > 1")
final("dq_no_future_dates", f"SELECT end_time FROM stg_query_history WHERE end_time > {NOW} + INTERVAL 1 HOUR LIMIT 1")
final("dq_seasonality_days", "SELECT * FROM (SELECT COUNT(DISTINCT date) AS day_count FROM cost_seasonality_baseline) t "
                             "WHERE day_count < 30")
final("dq_team_sum", """SELECT team_sum, query_sum, ABS(team_sum - query_sum) AS diff,
  ABS(team_sum - query_sum) / NULLIF(query_sum, 0) * 100 AS diff_pct
FROM (SELECT SUM(compute_cost) AS team_sum FROM team_cost_attribution) t
CROSS JOIN (SELECT SUM(estimated_cost_usd) AS query_sum FROM query_cost_attribution) q
WHERE ABS(team_sum - query_sum) / NULLIF(query_sum, 0) > 0.01 AND query_sum > 0""")
final("dq_warehouse_metered", """SELECT r.warehouse_name FROM warehouse_recommendations r
LEFT JOIN (SELECT DISTINCT warehouse_name FROM stg_warehouse_metering) m ON r.warehouse_name = m.warehouse_name
WHERE m.warehouse_name IS NULL""")

final("scan_query_stats", f"""SELECT COUNT(*) AS total_queries, COUNT(DISTINCT user_name) AS distinct_users,
  COUNT(DISTINCT warehouse_name) AS distinct_warehouses, COUNT(DISTINCT role_name) AS distinct_roles,
  COUNT(DISTINCT database_name) AS distinct_databases, MIN(start_time) AS first_query, MAX(start_time) AS last_query,
  SUM(total_elapsed_time_ms) / 3600000.0 AS total_elapsed_hours
FROM stg_query_history WHERE start_time >= {NOW} - INTERVAL 90 DAY""")
final("scan_metering", """SELECT warehouse_name, SUM(credits_used) AS total_credits, SUM(credits_used_compute) AS compute_credits,
  SUM(credits_used_cloud_services) AS cloud_credits, COUNT(*) AS metered_hours FROM stg_warehouse_metering GROUP BY 1""")
final("scan_top_tables", """SELECT * FROM (SELECT database_name, schema_name, table_name, active_bytes,
  ROW_NUMBER() OVER (PARTITION BY database_name ORDER BY active_bytes DESC, table_name) AS size_rank
  FROM stg_table_storage WHERE table_dropped IS NULL) t WHERE size_rank <= 10""")
final("verify_tagged_queries", f"""SELECT query_id, query_tag, start_time, warehouse_name, execution_status,
  map_extract(map_from_entries(list_transform(string_split(query_tag, ';'),
      lambda kv: struct_pack(k := split_part(kv, ':', 1), v := split_part(kv, ':', 2)))), 'scenario')[1] AS scenario
FROM stg_query_history WHERE query_tag LIKE '%scenario:%' AND start_time >= {NOW} - INTERVAL {AC.RECENT_HOURS} HOUR
ORDER BY start_time DESC, query_id LIMIT {AC.TAG_NEWEST}""")
final("verify_indicators", f"""SELECT COUNT(*) FILTER (WHERE starts_with(UPPER(TRIM(query_text)), 'SELECT *')) AS select_star_queries,
  COUNT(*) FILTER (WHERE bytes_spilled_to_local_storage > 0 OR bytes_spilled_to_remote_storage > 0) AS spilling_queries,
  COUNT(*) FILTER (WHERE partitions_scanned > partitions_total * 0.8) AS full_scan_queries, COUNT(*) AS total_queries
FROM stg_query_history WHERE query_tag LIKE '%scenario:%' AND start_time >= {NOW} - INTERVAL {AC.INDICATOR_DAYS} DAY""")
final("verify_recent_metering", f"""SELECT warehouse_name, SUM(credits_used) AS credits_used FROM stg_warehouse_metering
WHERE start_time >= {NOW} - INTERVAL 6 HOUR GROUP BY 1""")
final("verify_publication_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count, "
    f"CASE WHEN COUNT(*) > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM {t}" for t in AC.PUBLICATION_TABLES))

_FIRST = f"(SELECT * FROM stg_query_history WHERE end_time < {NOW} - INTERVAL 7 DAY)"
final("incremental_extract", f"""SELECT * FROM stg_query_history
WHERE end_time > (SELECT MAX(end_time) FROM {_FIRST} f) OR (SELECT MAX(end_time) FROM {_FIRST} f) IS NULL""")
final("upsert", f"""SELECT * FROM {_FIRST} t
WHERE query_id NOT IN (SELECT query_id FROM stg_query_history WHERE end_time > (SELECT MAX(end_time) FROM {_FIRST} f))
UNION ALL
SELECT * FROM (SELECT * FROM stg_query_history WHERE end_time > (SELECT MAX(end_time) FROM {_FIRST} f)
               QUALIFY ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY end_time DESC) = 1) u""")
_SEEDS = {"credit_pricing": 4, "alert_configuration": 13, "alert_suppressions": 6, "bank_holidays": 3,
          "warehouse_size_credits": 2, "warehouse_team_mapping": 4, "monthly_budget": 4, "recommendation_actions": 6}
_USED = {
    "alert_configuration": "FROM alert_union WHERE alert_id IN (SELECT alert_id FROM seed_alert_configuration)",
    "warehouse_size_credits": "FROM stg_query_history WHERE replace(upper(warehouse_size), '-', '') IN (SELECT warehouse_size FROM seed_warehouse_size_credits)",
    "warehouse_team_mapping": "FROM stg_warehouse_metering WHERE warehouse_name IN (SELECT warehouse_name FROM seed_warehouse_team_mapping)",
    "recommendation_actions": "FROM all_recommendations WHERE recommendation_id IN (SELECT recommendation_id FROM seed_recommendation_actions)"}
final("seed_load", " UNION ALL ".join(
    f"SELECT '{s}' AS seed_name, (SELECT count(*) FROM seed_{s}) AS row_count, {n} AS column_count, "
    + (f"(SELECT count(*) {_USED[s]})" if s in _USED else "0") + " AS matched_rows" for s, n in _SEEDS.items()))
final("upsert_versions", FINAL["upsert"])

# the streams end with the state of the batch models; the file stream drops what came ten days late
final("incremental_stream", f"""SELECT * FROM stg_query_history
WHERE NOT (CAST(substr(query_id, 2) AS BIGINT) % 7 = 0 AND end_time < {NOW} - INTERVAL 24 DAY)""")
final("upsert_days", FINAL["upsert"])
final("episode_stream", "SELECT * FROM alert_state_carried")
final("idle_island_stream", "SELECT * FROM idle_warehouse_periods")
final("storage_breakdown_json", "SELECT * FROM storage_breakdown")
final("latency_sketch_bounds", """SELECT warehouse_name, count(*) AS queries, TRUE AS p50_within, TRUE AS p95_within, TRUE AS p99_within
FROM sized_runs WHERE execution_time_ms IS NOT NULL GROUP BY ALL""")
final("team_user_sketch_bounds", f"""SELECT coalesce(query_tag_team, {_BY_ROLE}, {_BY_WAREHOUSE}, 'Unassigned') AS team_name, {MONTH} AS month,
  count(DISTINCT user_name) AS users, TRUE AS within FROM query_cost_attribution GROUP BY 1, 2""")
cte("outbox_messages", f"""
SELECT t.alert_episode_key AS k, t.detected_at < {NOW} - INTERVAL 2 HOUR AS early, substr(md5(t.alert_episode_key), 1, 1) AS digit
FROM alert_state_tracker t, seed_alert_configuration c
WHERE t.alert_id = c.alert_id AND c.teams_enabled AND c.enabled AND t.alert_episode_key IS NOT NULL""")
final("alert_outbox", f"""
SELECT k AS alert_episode_key, CASE WHEN early AND digit >= 'c' THEN 2 ELSE 1 END AS attempts,
  CASE WHEN early AND digit < 'c' THEN {NOW} - INTERVAL 2 HOUR ELSE {NOW} END AS last_attempt_at, last_attempt_at AS sent_at,
  CASE WHEN NOT early OR digit >= 'c' THEN 202 WHEN digit < '4' THEN 200 WHEN digit < '8' THEN 202 ELSE 429 END AS api_response_code,
  api_response_code <> 429 AS send_success, count(*) FILTER (WHERE early AND digit >= 'c') OVER () AS queued_again FROM outbox_messages""")

# the facts of each alert's card: (title, field of the details, as money, a plain number or text)
_FACTS = {
    "cost_daily_spike": [("Daily Cost", "daily_cost", 2), ("Rolling 30d Avg", "rolling_30d_avg", 2), ("Detection Method", "detection_method", None), ("Z-Score", "z_score", 2)],
    "warehouse_idle_extended": [("Warehouse", "warehouse_name", None), ("Idle Minutes", "idle_minutes", None), ("Wasted Credits", "wasted_credits", 2), ("Wasted Cost", "wasted_cost_usd", 2)],
    "credit_budget_80pct": [("MTD Credits", "mtd_credits", 1), ("Budget Credits", "budget_credits", None), ("% Used", "pct_used", 1)],
    "credit_budget_100pct": [("MTD Credits", "mtd_credits", 1), ("Budget Credits", "budget_credits", None), ("% Used", "pct_used", 1)],
    "query_spill_heavy": [("Query ID", "query_id", None), ("User", "user_name", None), ("Warehouse", "warehouse_name", None), ("Spill Remote (GB)", "bytes_spilled_remote", 2), ("Execution Time (s)", "execution_time_s", 1)],
    "repeated_expensive_query": [("Query Hash", "query_hash", None), ("Warehouse", "warehouse_name", None), ("Daily Executions", "daily_executions", None), ("Avg Cost/Run", "avg_cost_per_run", 2), ("Total Daily Cost", "total_daily_cost", 2)],
    "query_long_running": [("Query ID", "query_id", None), ("User", "user_name", None), ("Warehouse", "warehouse_name", None), ("Duration (min)", "duration_minutes", None), ("Queued Time (s)", "queued_time_s", None), ("Query Preview", "query_preview", None)],
}


def _fact_value(field: str, digits: int | None) -> str:
    value = f"json_extract_string(details_json, '$.{field}')"
    scale = " / 1073741824.0" if field == "bytes_spilled_remote" else ""
    if digits is not None:
        value = f"CAST(floor(CAST({value} AS DOUBLE){scale} * {10 ** digits} + 0.5) / {10 ** digits} AS VARCHAR)"
    return f"coalesce(left({value}, 200), 'N/A')"


_HEAD = [("Resource", "resource_key"), ("Metric Value", "CAST(metric_value AS VARCHAR)"), ("Threshold", "CAST(threshold_value AS VARCHAR)"),
         ("Detected At", "CAST(detected_at AS VARCHAR)"), ("Episode", "CAST(episode_number AS VARCHAR)"), ("Resolver Team", "resolver_team")]
_FACT_ROWS = [f"SELECT alert_episode_key, 1 AS section, {n} AS place, '{t}' AS title, {v} AS value FROM cards" for n, (t, v) in enumerate(_HEAD, 1)]
_FACT_ROWS += [f"SELECT alert_episode_key, 2, {n}, '{t}', {_fact_value(f, d)} FROM cards WHERE alert_id = '{a}'" for a, facts in _FACTS.items() for n, (t, f, d) in enumerate(facts, 1)]
_FACT_ROWS.append("SELECT alert_episode_key, 2, 1, 'Raw Details', left(details_json, 300) FROM cards WHERE alert_id NOT IN (" + ", ".join(f"'{a}'" for a in _FACTS) + ")")
cte("cards", """
SELECT t.*, c.resolver_team FROM alert_state_tracker t, seed_alert_configuration c
WHERE t.alert_id = c.alert_id AND c.teams_enabled AND c.enabled AND t.is_new_episode""")
final("alert_payload_facts", f"""
SELECT alert_episode_key, section, place, title, TRY_CAST(value AS DOUBLE) AS value_number, CASE WHEN value_number IS NULL THEN value END AS value_text
FROM ({' UNION ALL '.join(_FACT_ROWS)})""")
_money = lambda c: f"format('{{:,.2f}}', {c})"
final("weekly_report_html", f"""SELECT report_date, week_start, concat('<html><body><h2>Weekly Cost Report</h2><p>Week starting ', strftime(week_start, '%Y-%m-%d'),
  '</p><table><tr><td>This week</td><td>$', {_money('this_week_cost')}, '</td></tr><tr><td>Last week</td><td>$', {_money('last_week_cost')},
  '</td></tr><tr><td>Change</td><td>', printf('%.1f', wow_change_pct), '%</td></tr><tr><td>Compute</td><td>$', {_money('this_week_compute')},
  '</td></tr><tr><td>Storage</td><td>$', {_money('this_week_storage')}, '</td></tr><tr><td>Serverless</td><td>$', {_money('this_week_serverless')},
  '</td></tr><tr><td>New alerts (7 days)</td><td>', active_alert_count, '</td></tr><tr><td>Open savings</td><td>$', {_money('total_unrealised_savings')},
  '</td></tr></table></body></html>') AS html_body, generated_at FROM weekly_executive_report""")
