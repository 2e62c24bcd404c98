"""Workload query shapes, re-aimed at the star schema.

Mapping: inventory -> lineitem (item l_partkey, warehouse l_suppkey, date
l_shipdate, quantity l_quantity), item -> part (category = first word of
p_type, class = p_brand, price = p_retailprice), warehouse -> supplier,
customer demographics -> customer x nation x region (state = nation, segment =
c_mktsegment, income = c_acctbal, credit = bands of c_acctbal). A quantity under 5
counts as "out of stock". The shapes that also count brands (valuations) take
class = p_size and brand = p_brand. Ranked sums are rounded to cents first, so that
the order of a float sum cannot part a tie.

Supplier, part and customer grow with the data, so their joins are left to
AQE, which broadcasts a side only when its measured size is under the
broadcast threshold; only nation and region (fixed 25 / 5 rows) are hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.functions.exprs import round_half_up
from costlens.plans.rank import global_ntile, rank_within, top_rows

LOW_STOCK = 5
# FIXED VALUES: parameters of the workload shapes
SCORECARD_YEARS = [1996, 1997, 1998]
DETAIL_YEAR, DETAIL_MONTH = 1998, 12
SIGNAL_YEAR, SIGNAL_MONTHS = 1998, (1, 6)
REPORT_FIRST_DAY, REPORT_DAYS = "1998-01-01", 25
CUSTOMER_STATES = ["NATION_0", "NATION_3", "NATION_7", "NATION_12", "NATION_21"]
TOP_SIGNALS = 100000
VALUATION_YEAR, VALUATION_MONTHS = 1998, (1, 3)
BURST_HEALTH_YEARS = [1997, 1998]


def _category():
    return F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))


def _line_order() -> list:
    return [F.col(c) for c in ("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")]


def _quarter_name(c):
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def _inventory(t: dict) -> DataFrame:
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                                "l_extendedprice")


def _shipped(*ranges: tuple[str, str]):
    """Ship date in one of the half-open ranges; plain comparisons reach the scan."""
    cond = F.lit(False)
    for a, b in ranges:
        cond = cond | ((F.col("l_shipdate") >= F.expr(f"TIMESTAMP_NTZ '{a} 00:00:00'")) & (F.col("l_shipdate") < F.expr(f"TIMESTAMP_NTZ '{b} 00:00:00'")))
    return cond


def _months(year: int, first: int, last: int) -> tuple[str, str]:
    return f"{year}-{first:02d}-01", f"{year + last // 12}-{last % 12 + 1:02d}-01"


def health_scorecard(t: dict) -> DataFrame:
    inv = _inventory(t).filter(_shipped(*[(f"{y}-01-01", f"{y + 1}-01-01") for y in SCORECARD_YEARS]))
    j = inv.join(t["supplier"], inv["l_suppkey"] == F.col("s_suppkey")).join(t["part"], inv["l_partkey"] == F.col("p_partkey"))
    g = j.groupBy("s_name", _category().alias("category"), _quarter_name("l_shipdate").alias("quarter_name")).agg(
        F.sum("l_quantity").alias("total_qty"), F.avg("l_quantity").alias("avg_qty"),
        F.stddev_samp("l_quantity").alias("qty_volatility"),
        F.count(F.when(F.col("l_quantity") < LOW_STOCK, 1)).alias("stockout_days"),
        F.count(F.lit(1)).alias("total_records"))
    g = g.withColumn("quarter_rank", F.row_number().over(
        Window.partitionBy("s_name", "category").orderBy(F.col("quarter_name").desc())))
    rate = F.col("stockout_days") * 100.0 / F.when(F.col("total_records") != 0, F.col("total_records"))
    return g.filter(F.col("quarter_rank") <= 4).select(
        "s_name", "category", "quarter_name", "total_qty", "avg_qty", "qty_volatility", "stockout_days",
        "total_records", round_half_up(rate, 2).alias("stockout_rate_pct"),
        F.when(rate > 20, "CRITICAL").when(rate > 10, "AT_RISK")
        .when(F.col("qty_volatility") > F.col("avg_qty") * 0.5, "VOLATILE").otherwise("HEALTHY")
        .alias("inventory_health_status"))


def _birth_year():
    return (F.lit(1930) + F.col("c_custkey") % 75).cast("long")


def customer_segments(t: dict) -> DataFrame:
    """Global income deciles (NTILE over the whole table) are computed without
    a single-partition window: distributed row number + total count."""
    c = (t["customer"].join(F.broadcast(t["nation"]), F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey"), "left")
         .withColumn("birth_year", _birth_year()).filter(F.col("birth_year") > 1940))
    by = F.col("birth_year")
    c = c.withColumn("generation", F.when(by >= 1997, "Gen Z").when(by >= 1981, "Millennial")
                     .when(by >= 1965, "Gen X").when(by >= 1946, "Boomer").otherwise("Silent"))
    c = global_ntile(c, [F.col("c_acctbal").asc(), F.col("c_custkey").asc()], 10, "income_decile")
    high = F.col("c_acctbal") > 5000
    return c.groupBy("generation", F.col("n_name").alias("state"), F.col("c_mktsegment").alias("segment"),
                     F.col("r_name").alias("region"), "income_decile").agg(
        F.count(F.lit(1)).alias("customer_count"), round_half_up(F.avg("c_acctbal"), 0).alias("avg_income_upper"),
        F.count(F.when(high, 1)).alias("high_credit_count"),
        round_half_up(F.count(F.when(high, 1)) * 100.0 / F.count(F.lit(1)), 1).alias("high_credit_pct"))


def customer_360(t: dict) -> DataFrame:
    return (t["customer"].join(F.broadcast(t["nation"]), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey"))
            .filter(F.col("n_name").isin(*CUSTOMER_STATES)))


def month_detail(t: dict) -> DataFrame:
    inv = t["lineitem"].filter(_shipped(_months(DETAIL_YEAR, DETAIL_MONTH, DETAIL_MONTH)))
    return (inv.join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
            .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")))


def demand_signals(t: dict, top: int = TOP_SIGNALS) -> DataFrame:
    """Moving averages, volatility, lags and month-start baselines per
    (item, warehouse). Windows are partitioned by the item-warehouse pair, so
    they spread over all tasks; the top-k is the query's own LIMIT, taken without a
    merge in one task."""
    inv = _inventory(t).filter(_shipped(_months(SIGNAL_YEAR, *SIGNAL_MONTHS)))
    order = [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")]
    w = Window.partitionBy("l_partkey", "l_suppkey").orderBy(*order)
    wm = Window.partitionBy("l_partkey", "l_suppkey", F.month("l_shipdate")).orderBy(*order)
    q = F.col("l_quantity")
    s = inv.select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity",
                   F.avg(q).over(w.rowsBetween(-6, 0)).alias("ma_7day"),
                   F.avg(q).over(w.rowsBetween(-29, 0)).alias("ma_30day"),
                   F.stddev_samp(q).over(w.rowsBetween(-29, 0)).alias("volatility_30day"),
                   F.lag(q, 7).over(w).alias("qty_7day_ago"),
                   F.first(q).over(wm.rowsBetween(Window.unboundedPreceding, 0)).alias("month_start_qty"))
    z = F.when(F.col("volatility_30day") > 0,
               round_half_up((q - F.col("ma_30day")) / F.col("volatility_30day"), 2)).otherwise(0.0)
    out = s.select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "ma_7day", "ma_30day",
        "volatility_30day", z.alias("z_score"),
        F.when(q == 0, "STOCKOUT").when(q < F.col("ma_30day") * 0.3, "LOW_STOCK")
        .when(q > F.col("ma_30day") * 2.0, "OVERSTOCK").otherwise("NORMAL").alias("inventory_status"),
        round_half_up((q - F.col("month_start_qty")) * 100.0 / F.when(F.col("month_start_qty") != 0,
                                                                       F.col("month_start_qty")), 1).alias("mtd_change_pct"),
        round_half_up((q - F.col("qty_7day_ago")) * 100.0 / F.when(F.col("qty_7day_ago") != 0,
                                                                    F.col("qty_7day_ago")), 1).alias("wow_change_pct"))
    return top_rows(out, "z_score", _line_order(), top)


def category_report(t: dict) -> DataFrame:
    """The repeated daily report for 25 dates as one query: the date is part of
    the grouping key instead of 25 separate scans."""
    first = F.to_date(F.lit(REPORT_FIRST_DAY))
    inv = _inventory(t).filter((F.to_date("l_shipdate") >= first)
                               & (F.to_date("l_shipdate") < F.date_add(first, REPORT_DAYS)))
    j = inv.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(
        t["part"], F.col("l_partkey") == F.col("p_partkey"))
    g = j.groupBy(F.to_date("l_shipdate").alias("report_date"), "s_name", _category().alias("category"),
                  F.col("p_brand").alias("class")).agg(
        F.sum("l_quantity").alias("total_qty"), F.count_distinct("l_partkey").alias("unique_items"),
        F.count(F.when(F.col("l_quantity") < LOW_STOCK, 1)).alias("out_of_stock_items"),
        F.sum(F.col("l_quantity") * F.col("p_retailprice")).alias("inventory_value"))
    return g.select("report_date", "s_name", "category", "class", "total_qty", "unique_items", "out_of_stock_items",
                    round_half_up(F.col("out_of_stock_items") * 100.0 / F.col("unique_items"), 1).alias("oos_rate_pct"),
                    round_half_up("inventory_value", 2).alias("inventory_value"),
                    F.rank().over(Window.partitionBy("report_date", "s_name")
                                  .orderBy(F.col("inventory_value").desc())).alias("value_rank"))


def affinity_cross(t: dict) -> DataFrame:
    """Customer x region offers: a cross join against the 5-row region table
    (broadcast) with the nation key as the one equi condition."""
    c = t["customer"].join(F.broadcast(t["nation"]), F.col("c_nationkey") == F.col("n_nationkey"))
    x = c.crossJoin(F.broadcast(t["region"].withColumnRenamed("r_regionkey", "target_region")))
    x = x.filter(F.col("n_regionkey") == F.col("target_region"))
    bal = F.col("c_acctbal")
    return x.groupBy("r_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(bal > 7500, 1)).alias("premium_targets"),
        F.count(F.when((bal > 2500) & (bal <= 7500), 1)).alias("standard_targets"),
        F.count(F.when(bal <= 2500, 1)).alias("nurture_targets"))


def _lifetime(t: dict) -> DataFrame:
    return t["orders"].groupBy("o_custkey").agg(
        round_half_up(F.sum("o_totalprice"), 2).alias("lifetime_value"), F.count(F.lit(1)).alias("order_count"),
        F.max("o_orderdate").alias("last_order"))


def ltv_ranking(t: dict) -> DataFrame:
    """Tier, credit band, dense rank of the lifetime value per state and a composite
    score, as a full sort without a limit. States are few: ``rank_within``."""
    o = _lifetime(t)
    c = (t["customer"].join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
         .join(F.broadcast(t["nation"]), F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    ltv, bal, tier = F.coalesce("lifetime_value", F.lit(0.0)), F.col("c_acctbal"), F.col("tier")
    c = c.select("c_custkey", "c_name", F.col("n_name").alias("state"), ltv.alias("lifetime_value"),
                 F.coalesce("order_count", F.lit(0)).alias("order_count"),
                 F.when(ltv > 1000000, "PLATINUM").when(ltv > 500000, "GOLD").when(ltv > 100000, "SILVER")
                 .otherwise("BRONZE").alias("tier"),
                 F.when(bal > 7500, 4).when(bal > 5000, 3).when(bal > 2500, 2).otherwise(1).alias("credit_score"))
    c = rank_within(c, "state", "lifetime_value", "state_rank", dense=True)
    points = F.when(tier == "PLATINUM", 100).when(tier == "GOLD", 70).when(tier == "SILVER", 40).otherwise(10)
    return c.withColumn("ltv_score", round_half_up(F.col("credit_score") * 30 + F.col("lifetime_value") / 1000 + points, 2)).orderBy(
        F.col("ltv_score").desc(), "state", "c_custkey")


def _valued(t: dict, year: int, first: int, last: int) -> DataFrame:
    """Line values of some months with supplier, category, class (part size) and brand."""
    inv = _inventory(t).filter(_shipped(_months(year, first, last)))
    return (inv.join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
            .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
            .withColumn("quarter_name", _quarter_name("l_shipdate")).withColumn("category", _category())
            .withColumn("class", F.col("p_size")).withColumn("line_value", F.col("l_quantity") * F.col("p_retailprice")))


def quarterly_valuation(t: dict) -> DataFrame:
    """Quarter, supplier and category totals for every region. Line values are never
    negative, so the highest running value of a category within its supplier's quarter
    is the one at its end: the running sum is taken over the category totals, and no
    task orders the lines of a hot supplier."""
    g = _valued(t, VALUATION_YEAR, *VALUATION_MONTHS).groupBy("quarter_name", "s_suppkey", "s_name", "s_nationkey", "category").agg(
        F.count(F.lit(1)).alias("record_count"), F.sum("line_value").alias("value"),
        F.avg("line_value").alias("avg_line_value"), F.count_distinct("p_brand").alias("brand_count"),
        F.count(F.when(F.col("l_quantity") < LOW_STOCK, 1)).alias("zero_stock_records"))
    upto = F.sum("value").over(Window.partitionBy("quarter_name", "s_suppkey").orderBy("category")
                               .rowsBetween(Window.unboundedPreceding, 0))
    g = (g.withColumn("max_cumulative", upto).withColumn("total_value", round_half_up("value", 2))
         .join(F.broadcast(t["nation"]), F.col("s_nationkey") == F.col("n_nationkey"), "left"))
    x = g.crossJoin(F.broadcast(t["region"].select("r_name"))).select(
        "quarter_name", "s_name", F.col("n_name").alias("supplier_state"), "category", "r_name", "record_count",
        "total_value", "avg_line_value", "max_cumulative", "brand_count", "zero_stock_records",
        round_half_up(F.col("zero_stock_records") * 100.0 / F.col("record_count"), 2).alias("zero_stock_pct"))
    return rank_within(x, "quarter_name", "total_value", "value_rank").orderBy(
        F.col("total_value").desc(), "quarter_name", "s_name", "category", "r_name")


def burst_health(t: dict) -> DataFrame:
    inv = _inventory(t).filter(_shipped(*[(f"{y}-01-01", f"{y + 1}-01-01") for y in BURST_HEALTH_YEARS]))
    j = inv.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(
        t["part"], F.col("l_partkey") == F.col("p_partkey"))
    g = j.groupBy("s_name", _category().alias("category")).agg(
        F.sum("l_quantity").alias("total_qty"), F.count(F.when(F.col("l_quantity") < LOW_STOCK, 1)).alias("stockout_count"),
        F.count(F.lit(1)).alias("total_records"), F.stddev_samp("l_quantity").alias("qty_stddev"))
    return (g.withColumn("qty_rank", F.rank().over(Window.partitionBy("s_name").orderBy(F.col("total_qty").desc())))
            .withColumn("stockout_pct", round_half_up(F.col("stockout_count") * 100.0 / F.col("total_records"), 2))
            .orderBy(F.col("stockout_pct").desc(), "s_name", "category"))


def burst_volatility(t: dict, top: int = TOP_SIGNALS) -> DataFrame:
    order = [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")]
    w = Window.partitionBy("l_partkey", "l_suppkey").orderBy(*order)
    s = _inventory(t).select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity",
                             F.avg("l_quantity").over(w.rowsBetween(-6, 0)).alias("ma_7day"),
                             F.stddev_samp("l_quantity").over(w.rowsBetween(-29, 0)).alias("volatility_30day"))
    return top_rows(s, "volatility_30day", _line_order(), top)


def burst_loyalty(t: dict) -> DataFrame:
    """Tier by lifetime value and credit, dense rank of the balance per state."""
    c = (t["customer"].join(F.broadcast(t["nation"]), F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .filter(F.col("n_name").isin(*CUSTOMER_STATES))
         .join(_lifetime(t), F.col("c_custkey") == F.col("o_custkey"), "left"))
    rating = F.when(F.col("c_acctbal") > 5000, "HIGH").otherwise("LOW")
    tier = F.when((F.col("lifetime_value") > 1000000) & (rating == "HIGH"), "PLATINUM").when(
        F.col("lifetime_value") > 500000, "GOLD").otherwise("SILVER")
    c = c.select("c_custkey", "c_name", F.col("n_name").alias("state"), rating.alias("credit_rating"), "c_acctbal",
                 "order_count", "last_order", tier.alias("loyalty_tier"))
    return rank_within(c, "state", "c_acctbal", "state_rank", dense=True).orderBy(
        F.col("c_acctbal").desc_nulls_last(), "c_custkey")


def burst_valuation(t: dict) -> DataFrame:
    g = _valued(t, SIGNAL_YEAR, *SIGNAL_MONTHS).groupBy("quarter_name", "s_name", "category", "class").agg(
        round_half_up(F.sum("line_value"), 2).alias("total_value"), F.count_distinct("p_brand").alias("brand_count"),
        F.avg("l_quantity").alias("avg_qty"),
        (F.sum("line_value") / F.nullif(F.sum("l_quantity"), F.lit(0.0))).alias("weighted_avg_price"))
    return rank_within(g, "quarter_name", "total_value", "value_rank").orderBy(
        F.col("total_value").desc(), "quarter_name", "s_name", "category", "class")


def item_stats(t: dict) -> DataFrame:
    return t["part"].groupBy(_category().alias("category"), F.col("p_brand").alias("class")).agg(
        F.count(F.lit(1)).alias("item_count"), F.avg("p_retailprice").alias("avg_price"),
        F.max("p_retailprice").alias("max_price"), F.min("p_retailprice").alias("min_price"))


WORKLOAD = {
    "wl_health_scorecard": health_scorecard, "wl_customer_segments": customer_segments,
    "wl_customer_360": customer_360, "wl_month_detail": month_detail, "wl_demand_signals": demand_signals,
    "wl_category_report": category_report, "wl_affinity_cross": affinity_cross, "wl_ltv_ranking": ltv_ranking,
    "wl_quarterly_valuation": quarterly_valuation, "wl_burst_health": burst_health,
    "wl_burst_volatility": burst_volatility, "wl_burst_loyalty": burst_loyalty,
    "wl_burst_valuation": burst_valuation, "wl_item_stats": item_stats,
}
