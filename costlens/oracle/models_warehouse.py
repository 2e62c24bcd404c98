"""Oracle SQL: warehouse analysis. Islands by counting the busy intervals before,
percentiles as quantile lists, shares by filtered counts."""

from costlens.oracle.base import cte, final
from costlens.oracle.models_cost import PRICE, user_work


def pct(condition: str) -> str:
    """Percent of the group's rows that meet the condition."""
    return f"100.0 * count(*) FILTER (WHERE {condition}) / count(*)"


cte("warehouse_utilisation", """
SELECT warehouse_name, start_time AS interval_start, end_time AS interval_end, avg_running, avg_queued_load, avg_blocked,
  avg_running / nullif(load, 0) AS utilisation_pct, avg_queued_load / nullif(load, 0) AS queue_ratio,
  avg_blocked / nullif(load, 0) AS blocked_ratio, coalesce(avg_running = 0 AND load = 0, FALSE) AS is_idle
FROM (SELECT *, avg_running + avg_queued_load + avg_queued_provisioning + avg_blocked AS load FROM stg_warehouse_load)""")

cte("idle_warehouse_periods", f"""
SELECT warehouse_name, min(interval_start) AS idle_start, max(interval_end) AS idle_end,
  date_diff('minute', min(interval_start), max(interval_end)) AS idle_duration_minutes,
  date_diff('second', min(interval_start), max(interval_end)) / 3600.0 AS wasted_credits,
  date_diff('second', min(interval_start), max(interval_end)) / 3600.0 * {PRICE} AS wasted_cost_usd
FROM (SELECT *, count(*) FILTER (WHERE NOT is_idle) OVER (PARTITION BY warehouse_name ORDER BY interval_start) AS busy_before
      FROM warehouse_utilisation)
WHERE is_idle GROUP BY warehouse_name, busy_before HAVING idle_duration_minutes > 0""")

cte("warehouse_queue_analysis", f"""
SELECT warehouse_name, hour(interval_start) AS hour_of_day, count(*) AS total_intervals,
  count(*) FILTER (WHERE avg_queued_load > 0) AS intervals_with_queue, {pct('avg_queued_load > 0')} AS queue_frequency_pct,
  avg(avg_queued_load) FILTER (WHERE avg_queued_load > 0) AS avg_queue_depth
FROM warehouse_utilisation GROUP BY ALL""")

cte("warehouse_schedule_analysis", """
SELECT * EXCLUDE (dow_off), dow_off OR hour NOT BETWEEN 6 AND 19 AS is_off_peak,
  CASE WHEN query_count < 5 AND (dow_off OR hour NOT BETWEEN 6 AND 19) THEN credits_cost ELSE 0 END AS schedulable_savings_usd
FROM (SELECT warehouse_name, dayofweek(start_time) AS day_of_week, hour(start_time) AS hour, count(*) AS query_count,
        sum(estimated_cost_usd) AS credits_cost, dayofweek(start_time) % 6 = 0 AS dow_off
      FROM query_cost_attribution GROUP BY ALL)""")

cte("sized_runs", f"FROM stg_query_history WHERE execution_status = 'SUCCESS' AND warehouse_name IS NOT NULL AND {user_work()}")
cte("size_votes", """
SELECT warehouse_name, list(warehouse_size ORDER BY votes DESC, warehouse_size)[1] AS size
FROM (SELECT warehouse_name, warehouse_size, count(*) AS votes FROM sized_runs WHERE warehouse_size IS NOT NULL GROUP BY ALL) GROUP BY ALL""")
cte("hour_peaks", """
SELECT warehouse_name, max(u) AS peak FROM (
  SELECT warehouse_name, hour(interval_start) AS h, avg(utilisation_pct) AS u FROM warehouse_utilisation GROUP BY ALL) GROUP BY ALL""")
cte("warehouse_sizing_analysis", f"""
SELECT warehouse_name, any_value(size) AS current_size, count(*) AS total_queries, count(DISTINCT user_name) AS unique_users,
  count(DISTINCT role_name) AS unique_roles, avg(execution_time_ms) AS avg_exec_ms,
  quantile_cont(execution_time_ms, [0.5, 0.95, 0.99])[1] AS p50_exec_ms, quantile_cont(execution_time_ms, [0.5, 0.95, 0.99])[2] AS p95_exec_ms,
  quantile_cont(execution_time_ms, [0.5, 0.95, 0.99])[3] AS p99_exec_ms, avg(queued_overload_time_ms) AS avg_queue_ms,
  {pct('bytes_spilled_to_remote_storage > 0')} AS spill_rate_pct, avg(bytes_scanned) AS avg_bytes_scanned,
  coalesce(any_value(peak), 0) AS peak_hour_utilisation
FROM sized_runs LEFT JOIN size_votes USING (warehouse_name) LEFT JOIN hour_peaks USING (warehouse_name) GROUP BY warehouse_name""")

cte("warehouse_auto_suspend", """
SELECT warehouse_name, 60 AS current_auto_suspend_seconds,
  CAST(round(CASE WHEN m < 60 THEN 60 WHEN m > 300 THEN 300 ELSE m END) AS INTEGER) AS recommended_auto_suspend_seconds,
  idle_period_count, avg_idle_minutes, monthly_idle_credits, monthly_idle_cost_usd,
  CASE WHEN monthly_idle_cost_usd > 0 THEN 0.3 * monthly_idle_cost_usd ELSE 0 END AS potential_savings_usd
FROM (SELECT warehouse_name, 60 * median(idle_duration_minutes) AS m, count(*) AS idle_period_count,
        avg(idle_duration_minutes) AS avg_idle_minutes, sum(wasted_credits) AS monthly_idle_credits,
        sum(wasted_cost_usd) AS monthly_idle_cost_usd FROM idle_warehouse_periods GROUP BY ALL)""")

for _k in ("warehouse_utilisation", "idle_warehouse_periods", "warehouse_queue_analysis",
           "warehouse_schedule_analysis", "warehouse_sizing_analysis", "warehouse_auto_suspend"):
    final(_k, f"SELECT * FROM {_k}")
