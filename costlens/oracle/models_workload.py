"""Oracle SQL: workload shapes on the star schema."""

from costlens.oracle.base import final
from costlens.operators import workload as WL


def rhu(x: str, d: int) -> str:
    return f"CAST(floor(CAST({x} AS DOUBLE) * {10 ** d} + 0.5) / {10 ** d} AS DOUBLE)"


CAT = "split_part(p_type, ' ', 1)"
QN = "CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR)"
YEARS = ", ".join(str(y) for y in WL.SCORECARD_YEARS)
RATE = "stockout_days * 100.0 / NULLIF(total_records, 0)"
final("wl_health_scorecard", f"""
SELECT s_name, category, quarter_name, total_qty, avg_qty, qty_volatility, stockout_days, total_records,
  {rhu(RATE, 2)} AS stockout_rate_pct,
  CASE WHEN {RATE} > 20 THEN 'CRITICAL' WHEN {RATE} > 10 THEN 'AT_RISK' WHEN qty_volatility > avg_qty * 0.5 THEN 'VOLATILE'
       ELSE 'HEALTHY' END AS inventory_health_status
FROM (SELECT s_name, {CAT} AS category, {QN} AS quarter_name, SUM(l_quantity) AS total_qty, AVG(l_quantity) AS avg_qty,
             STDDEV_SAMP(l_quantity) AS qty_volatility, COUNT(CASE WHEN l_quantity < {WL.LOW_STOCK} THEN 1 END) AS stockout_days,
             COUNT(*) AS total_records,
             ROW_NUMBER() OVER (PARTITION BY s_name, {CAT} ORDER BY {QN} DESC) AS quarter_rank
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
      WHERE year(l_shipdate) IN ({YEARS})
      GROUP BY s_name, {CAT}, {QN}) w
WHERE quarter_rank <= 4""")

final("wl_customer_segments", f"""
SELECT generation, state, segment, region, income_decile, COUNT(*) AS customer_count,
  {rhu('AVG(c_acctbal)', 0)} AS avg_income_upper, COUNT(CASE WHEN c_acctbal > 5000 THEN 1 END) AS high_credit_count,
  {rhu('COUNT(CASE WHEN c_acctbal > 5000 THEN 1 END) * 100.0 / NULLIF(COUNT(*), 0)', 1)} AS high_credit_pct
FROM (SELECT c.*, n_name AS state, c_mktsegment AS segment, r_name AS region,
             CASE WHEN byear >= 1997 THEN 'Gen Z' WHEN byear >= 1981 THEN 'Millennial' WHEN byear >= 1965 THEN 'Gen X'
                  WHEN byear >= 1946 THEN 'Boomer' ELSE 'Silent' END AS generation,
             NTILE(10) OVER (ORDER BY c_acctbal, c_custkey) AS income_decile
      FROM (SELECT *, 1930 + c_custkey % 75 AS byear FROM customer) c
      LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
      WHERE byear > 1940) p
GROUP BY generation, state, segment, region, income_decile""")

STATES = ", ".join(f"'{s}'" for s in WL.CUSTOMER_STATES)
final("wl_customer_360", f"""SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE n_name IN ({STATES})""")
final("wl_month_detail", f"""SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE year(l_shipdate) = {WL.DETAIL_YEAR} AND month(l_shipdate) = {WL.DETAIL_MONTH}""")

W = "PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber"
final("wl_demand_signals", f"""
SELECT l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity, ma_7day, ma_30day, volatility_30day,
  CASE WHEN volatility_30day > 0 THEN {rhu('(l_quantity - ma_30day) / volatility_30day', 2)} ELSE 0 END AS z_score,
  CASE WHEN l_quantity = 0 THEN 'STOCKOUT' WHEN l_quantity < ma_30day * 0.3 THEN 'LOW_STOCK'
       WHEN l_quantity > ma_30day * 2.0 THEN 'OVERSTOCK' ELSE 'NORMAL' END AS inventory_status,
  {rhu('(l_quantity - month_start_qty) * 100.0 / NULLIF(month_start_qty, 0)', 1)} AS mtd_change_pct,
  {rhu('(l_quantity - qty_7day_ago) * 100.0 / NULLIF(qty_7day_ago, 0)', 1)} AS wow_change_pct
FROM (SELECT *, AVG(l_quantity) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma_7day,
             AVG(l_quantity) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma_30day,
             STDDEV_SAMP(l_quantity) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS volatility_30day,
             LAG(l_quantity, 7) OVER ({W}) AS qty_7day_ago,
             FIRST_VALUE(l_quantity) OVER (PARTITION BY l_partkey, l_suppkey, month(l_shipdate)
                                           ORDER BY l_shipdate, l_orderkey, l_linenumber) AS month_start_qty
      FROM lineitem WHERE year(l_shipdate) = {WL.SIGNAL_YEAR} AND month(l_shipdate) BETWEEN {WL.SIGNAL_MONTHS[0]} AND {WL.SIGNAL_MONTHS[1]}) d
ORDER BY z_score DESC, l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber LIMIT {WL.TOP_SIGNALS}""")

final("wl_category_report", f"""
SELECT report_date, s_name, category, class, total_qty, unique_items, out_of_stock_items,
  {rhu('out_of_stock_items * 100.0 / NULLIF(unique_items, 0)', 1)} AS oos_rate_pct, {rhu('inventory_value', 2)} AS inventory_value,
  RANK() OVER (PARTITION BY report_date, s_name ORDER BY inventory_value DESC) AS value_rank
FROM (SELECT CAST(l_shipdate AS DATE) AS report_date, s_name, {CAT} AS category, p_brand AS class,
             SUM(l_quantity) AS total_qty, COUNT(DISTINCT l_partkey) AS unique_items,
             COUNT(CASE WHEN l_quantity < {WL.LOW_STOCK} THEN 1 END) AS out_of_stock_items,
             SUM(l_quantity * p_retailprice) AS inventory_value
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
      WHERE CAST(l_shipdate AS DATE) >= DATE '{WL.REPORT_FIRST_DAY}'
        AND CAST(l_shipdate AS DATE) < DATE '{WL.REPORT_FIRST_DAY}' + INTERVAL {WL.REPORT_DAYS} DAY
      GROUP BY 1, 2, 3, 4) d""")

final("wl_affinity_cross", """
SELECT r_name, c_mktsegment, COUNT(*) AS customers, COUNT(CASE WHEN c_acctbal > 7500 THEN 1 END) AS premium_targets,
  COUNT(CASE WHEN c_acctbal > 2500 AND c_acctbal <= 7500 THEN 1 END) AS standard_targets,
  COUNT(CASE WHEN c_acctbal <= 2500 THEN 1 END) AS nurture_targets
FROM customer, nation, region
WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
GROUP BY r_name, c_mktsegment""")

SPENT = f"(SELECT o_custkey, {rhu('SUM(o_totalprice)', 2)} AS spent, COUNT(*) AS order_count, MAX(o_orderdate) AS last_order FROM orders GROUP BY 1)"
final("wl_ltv_ranking", f"""
WITH people AS (
  SELECT c_custkey, c_name, n_name AS state, COALESCE(spent, 0) AS lifetime_value, COALESCE(order_count, 0) AS order_count,
    1 + CAST(c_acctbal > 2500 AS INT) + CAST(c_acctbal > 5000 AS INT) + CAST(c_acctbal > 7500 AS INT) AS credit_score
  FROM customer LEFT JOIN {SPENT} o ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
tiers(tier, over_, upto, points) AS (VALUES ('BRONZE', -1.0, 1e5, 10), ('SILVER', 1e5, 5e5, 40), ('GOLD', 5e5, 1e6, 70), ('PLATINUM', 1e6, 1e300, 100))
SELECT c_custkey, c_name, state, lifetime_value, order_count, tier, credit_score,
  DENSE_RANK() OVER (PARTITION BY state ORDER BY lifetime_value DESC) AS state_rank,
  {rhu('credit_score * 30 + lifetime_value / 1000 + points', 2)} AS ltv_score
FROM people JOIN tiers ON lifetime_value > over_ AND lifetime_value <= upto""")

LINES = f"(SELECT *, {QN} AS quarter_name, {CAT} AS category, p_size AS class, l_quantity * p_retailprice AS line_value FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE year(l_shipdate) = 1998)"
final("wl_quarterly_valuation", f"""
WITH lines AS (SELECT *, SUM(line_value) OVER (PARTITION BY quarter_name, s_suppkey ORDER BY category, class, l_orderkey, l_linenumber
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
               FROM {LINES} l WHERE month(l_shipdate) <= 3),
sums AS (SELECT quarter_name, s_suppkey, s_name, s_nationkey, category, COUNT(*) AS record_count, {rhu('SUM(line_value)', 2)} AS total_value,
           AVG(line_value) AS avg_line_value, MAX(upto) AS max_cumulative, COUNT(DISTINCT p_brand) AS brand_count,
           COUNT(*) FILTER (l_quantity < 5) AS zero_stock_records
         FROM lines GROUP BY ALL)
SELECT quarter_name, s_name, n_name AS supplier_state, category, r_name, record_count, total_value, avg_line_value, max_cumulative,
  brand_count, zero_stock_records, {rhu('zero_stock_records * 100.0 / record_count', 2)} AS zero_stock_pct,
  RANK() OVER (PARTITION BY quarter_name ORDER BY total_value DESC) AS value_rank
FROM sums LEFT JOIN nation ON s_nationkey = n_nationkey CROSS JOIN region""")

final("wl_burst_health", f"""
SELECT *, RANK() OVER (PARTITION BY s_name ORDER BY total_qty DESC) AS qty_rank, {rhu('stockout_count * 100.0 / total_records', 2)} AS stockout_pct
FROM (SELECT s_name, {CAT} AS category, SUM(l_quantity) AS total_qty, COUNT(*) FILTER (l_quantity < 5) AS stockout_count,
        COUNT(*) AS total_records, STDDEV_SAMP(l_quantity) AS qty_stddev
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
      WHERE year(l_shipdate) IN (1997, 1998) GROUP BY 1, 2) g""")

final("wl_burst_volatility", f"""
SELECT l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity,
  AVG(l_quantity) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma_7day,
  STDDEV_SAMP(l_quantity) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS volatility_30day
FROM lineitem
ORDER BY volatility_30day DESC NULLS LAST, l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber
LIMIT {WL.TOP_SIGNALS}""")

final("wl_burst_loyalty", f"""
SELECT c_custkey, c_name, n_name AS state, IF(c_acctbal > 5000, 'HIGH', 'LOW') AS credit_rating, c_acctbal, order_count, last_order,
  CASE WHEN spent > 1000000 AND c_acctbal > 5000 THEN 'PLATINUM' WHEN spent > 500000 THEN 'GOLD' ELSE 'SILVER' END AS loyalty_tier,
  DENSE_RANK() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC NULLS LAST) AS state_rank
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN {SPENT} o ON c_custkey = o_custkey
WHERE n_name IN ('NATION_0', 'NATION_3', 'NATION_7', 'NATION_12', 'NATION_21')""")

final("wl_burst_valuation", f"""
SELECT *, RANK() OVER (PARTITION BY quarter_name ORDER BY total_value DESC) AS value_rank
FROM (SELECT quarter_name, s_name, category, class, {rhu('SUM(line_value)', 2)} AS total_value, COUNT(DISTINCT p_brand) AS brand_count,
        AVG(l_quantity) AS avg_qty, SUM(line_value) / NULLIF(SUM(l_quantity), 0) AS weighted_avg_price
      FROM {LINES} l WHERE month(l_shipdate) <= 6 GROUP BY 1, 2, 3, 4) g""")

final("wl_item_stats", f"""
SELECT {CAT} AS category, p_brand AS class, COUNT(*) AS item_count, AVG(p_retailprice) AS avg_price,
  MAX(p_retailprice) AS max_price, MIN(p_retailprice) AS min_price
FROM part GROUP BY 1, 2""")
