"""Anti-pattern detection.

Each rule is a row-local predicate on query history. The per-query cost the
rules report is a row-local expression too (NULL when the query carries no
attributable cost), so no self-join of query history to its own costs is
needed. ``antipattern_union`` evaluates all row-local rules in ONE scan: every
row gets an array of the rules it matches, which is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf
from costlens.operators.attribution import attributable, query_cost_columns, with_price

COMMON = ["query_id", "user_name", "warehouse_name", "antipattern_type", "severity",
          "estimated_waste_usd", "recommendation", "sample_query_text", "end_time"]

# FIXED VALUES: advice texts appended to each finding.
FIX_FULL_SCAN = ("FIX: (1) Add a WHERE filter on the partition/date column to prune partitions. "
                 "(2) Add a clustering key: ALTER TABLE <table> CLUSTER BY (<date_col>). "
                 "(3) If joining, ensure join keys align with clustering keys.")
FIX_SELECT_STAR = ("FIX: (1) Replace SELECT * with only the columns you need. "
                   "(2) This reduces I/O, memory usage, and network transfer. "
                   "(3) In Snowflake columnar storage, fewer columns = proportionally less data scanned.")
FIX_SPILL_REMOTE = ("FIX: (1) Increase warehouse size by one level to add more memory. "
                    "(2) Break query into smaller steps using temp tables. "
                    "(3) Reduce data volume with tighter WHERE filters or pre-aggregation. "
                    "(4) Avoid wide SELECT * — select only needed columns.")
FIX_SPILL_LOCAL = ("FIX: (1) Optimize JOINs — ensure join keys are selective. "
                   "(2) Add WHERE filters to reduce intermediate result set size. "
                   "(3) If persistent, increase warehouse size by one level.")
FIX_REPEATED = ("FIX: (1) Materialize results into a table and read from it instead of re-running. "
                "(2) Use Snowflake result caching — ensure same role, warehouse, and no DDL changes between runs. "
                "(3) Schedule the query once via a task and store output in a results table. "
                "(4) If used by a dashboard, cache at the application layer with a TTL.")
FIX_CARTESIAN = ("rows — likely a cartesian/cross join. "
                 "FIX: (1) Check all JOIN conditions — a missing or incorrect ON clause causes row explosion. "
                 "(2) Ensure every JOIN has a proper equality condition on the correct key columns. "
                 "(3) Use INNER JOIN instead of CROSS JOIN unless intentional. "
                 "(4) Add a WHERE clause to filter before joining to reduce intermediate rows.")
FIX_LARGE_SORT = ("rows without a LIMIT clause. "
                  "FIX: (1) Add LIMIT N if you only need top/bottom results. "
                  "(2) Remove ORDER BY if the consuming application does its own sorting. "
                  "(3) If sorting is needed, add WHERE filters to reduce row count before sorting. "
                  "(4) Consider using QUALIFY with ROW_NUMBER() instead of ORDER BY + LIMIT for top-N queries.")
FIX_LONG_RUNNING = ("FIX: (1) Add WHERE filters to reduce data scanned. "
                    "(2) Check for missing clustering keys on large tables. "
                    "(3) Break into smaller queries or use materialized intermediate tables. "
                    "(4) Consider upgrading warehouse size if query is I/O bound.")
SELECT_STAR_PATTERN = r"\A(?i)SELECT\s+\*\s+FROM.*\z"
SELECT_STAR_PATTERN_MULTILINE = r"\A(?is)SELECT\s+\*\s+FROM.*\z"


def num(c, digits: int) -> Column:
    """Number as text with fixed decimals, rounded half up before printing so
    the text is the same in every engine."""
    scale = 10 ** digits
    r = X.floor_double(X.col(c).cast("double") * scale + 0.5) / scale
    return F.format_string(f"%.{digits}f", r)


def grouped(c) -> Column:
    """Integer as text with thousands separators."""
    return F.format_number(X.col(c).cast("long"), 0)


def costed(qh: DataFrame, price: DataFrame) -> DataFrame:
    """Query history plus its row-local cost (NULL if not attributable)."""
    cost = query_cost_columns()["estimated_cost_usd"]
    q = with_price(qh, price)
    return q.withColumn("estimated_waste_usd", F.when(_attributable_cond(), cost))


def _attributable_cond() -> Column:
    text = F.col("query_text")
    return ((F.col("execution_status") == "SUCCESS") & F.col("warehouse_name").isNotNull() & text.isNotNull()
            & (F.trim(text) != "") & X.not_like_any(text, X.INTERNAL_PREFIXES_ATTRIBUTION))


def _base() -> Column:
    text = F.upper(F.col("query_text"))
    cond = (F.col("execution_status") == "SUCCESS") & \
        (F.coalesce(F.col("database_name"), F.lit("")) != X.SYSTEM_DATABASE)
    for m in X.SYSTEM_TEXT_MARKERS:
        cond = cond & ~text.contains(m)
    return cond


def _scan_ratio() -> Column:
    return X.safe_divide("partitions_scanned", "partitions_total")


def rules(as_of: AsOf, multiline: bool = False) -> dict[str, tuple[Column, Column, Column]]:
    """rule -> (predicate, severity, recommendation), all row-local."""
    mb = F.col("bytes_scanned") / 1048576.0
    base = _base()
    star = SELECT_STAR_PATTERN_MULTILINE if multiline else SELECT_STAR_PATTERN
    elapsed = F.col("total_elapsed_time_ms")
    return {
        "FULL_TABLE_SCAN": (
            base & (F.col("partitions_total") > 100) & (_scan_ratio() > 0.8) & (F.col("partitions_scanned") > 0),
            F.lit("P2"),
            F.concat(F.lit("Scanned "), F.col("partitions_scanned").cast("string"), F.lit(" of "),
                     F.col("partitions_total").cast("string"), F.lit(" partitions ("), num(_scan_ratio() * 100, 0),
                     F.lit("%). Scanned "), num(mb, 1), F.lit(" MB. "), F.lit(FIX_FULL_SCAN))),
        "SELECT_STAR": (
            base & F.col("warehouse_name").isNotNull()
            & F.upper(F.trim(F.col("query_text"))).rlike(star) & (F.col("bytes_scanned") > 1048576),
            F.lit("P3"),
            F.concat(F.lit("Scanned "), num(mb, 1), F.lit(" MB using SELECT *. "), F.lit(FIX_SELECT_STAR))),
        "SPILL_TO_STORAGE": (
            base & ((F.col("bytes_spilled_to_local_storage") > 0) | (F.col("bytes_spilled_to_remote_storage") > 0)),
            F.when(F.col("bytes_spilled_to_remote_storage") > 0, "P1").otherwise("P2"),
            F.when(F.col("bytes_spilled_to_remote_storage") > 0, F.concat(
                F.lit("Spilled "), num(F.col("bytes_spilled_to_remote_storage") / 1073741824.0, 2),
                F.lit(" GB to REMOTE storage (slow). "), F.lit(FIX_SPILL_REMOTE)))
            .otherwise(F.concat(
                F.lit("Spilled "), num(F.col("bytes_spilled_to_local_storage") / 1073741824.0, 2),
                F.lit(" GB to LOCAL storage. "), F.lit(FIX_SPILL_LOCAL)))),
        "CARTESIAN_JOIN": (
            base & (F.col("query_type") == "SELECT") & (F.col("rows_produced") > 0) & (F.col("bytes_scanned") > 0)
            & (F.col("rows_produced") > 10 * (F.col("bytes_scanned") / 100.0))
            & (F.col("rows_produced") > 1000000),
            F.lit("P1"),
            F.concat(F.lit("Produced "), grouped("rows_produced"), F.lit(" "), F.lit(FIX_CARTESIAN))),
        "LARGE_SORT_NO_LIMIT": (
            base & (F.col("rows_produced") > 100000) & F.upper(F.col("query_text")).contains("ORDER BY")
            & ~F.upper(F.col("query_text")).contains("LIMIT"),
            F.lit("P3"),
            F.concat(F.lit("Sorted "), grouped("rows_produced"), F.lit(" "), F.lit(FIX_LARGE_SORT))),
        "LONG_RUNNING": (
            base & (elapsed > 5 * 60000) & F.col("warehouse_name").isNotNull()
            & (F.col("end_time") >= as_of.ts_col() - F.expr("INTERVAL 30 DAYS"))
            & (F.col("user_name") != "SYSTEM")
            & X.not_like_any("query_text", X.INTERNAL_PREFIXES_LONG_RUNNING),
            F.when(elapsed > 30 * 60000, "P1").when(elapsed > 15 * 60000, "P2").otherwise("P3"),
            F.concat(F.lit("Ran for "), num(elapsed / 60000.0, 1), F.lit(" minutes"),
                     F.when(F.col("queued_overload_time_ms") > 10000,
                            F.concat(F.lit(" (incl. "), num(F.col("queued_overload_time_ms") / 1000.0, 0),
                                     F.lit("s queued)"))).otherwise(F.lit("")),
                     F.lit(". Scanned "), num(mb, 1), F.lit(" MB. "), F.lit(FIX_LONG_RUNNING))),
    }


EXTRA = {
    "FULL_TABLE_SCAN": ["partitions_scanned", "partitions_total", "scan_ratio", "bytes_scanned"],
    "SELECT_STAR": ["bytes_scanned"],
    "SPILL_TO_STORAGE": ["bytes_spilled_to_local_storage", "bytes_spilled_to_remote_storage"],
    "CARTESIAN_JOIN": ["rows_produced", "bytes_scanned"],
    "LARGE_SORT_NO_LIMIT": ["rows_produced"],
    "LONG_RUNNING": [],
}


def single_rule(costed_qh: DataFrame, rule: str, as_of: AsOf, multiline: bool = False) -> DataFrame:
    """One detector as its own table (the per-rule models)."""
    pred, sev, rec = rules(as_of, multiline)[rule]
    df = costed_qh.filter(pred).withColumn("scan_ratio", _scan_ratio())
    return df.select("query_id", "user_name", "warehouse_name", F.lit(rule).alias("antipattern_type"),
                     sev.alias("severity"), "estimated_waste_usd", rec.alias("recommendation"),
                     F.col("query_text").alias("sample_query_text"), *EXTRA[rule], "end_time")


def repeated_queries(patterns: DataFrame) -> DataFrame:
    rec = F.concat(F.lit("Ran "), F.col("execution_count").cast("string"), F.lit(" times (avg "),
                   num("avg_execution_time_s", 1), F.lit("s, avg cost $"), num("avg_cost_per_execution", 4),
                   F.lit("/run). "), F.lit(FIX_REPEATED))
    return (patterns.filter((F.col("execution_count") > 10) & (F.col("total_cost_usd") > 5.0))
            .select(F.coalesce("sample_query_id", "query_hash").alias("query_id"),
                    F.col("sample_user_name").alias("user_name"), "warehouse_name",
                    F.lit("REPEATED_EXPENSIVE").alias("antipattern_type"), F.lit("P2").alias("severity"),
                    F.col("total_cost_usd").alias("estimated_waste_usd"), rec.alias("recommendation"),
                    F.coalesce("sample_query_text", "query_hash").alias("sample_query_text"),
                    "execution_count", "avg_execution_time_s", "avg_cost_per_execution",
                    F.col("query_date").alias("end_time")))


def antipattern_union(costed_qh: DataFrame, patterns: DataFrame, as_of: AsOf, multiline: bool = False) -> DataFrame:
    """All findings in the shared schema. The row-local rules share one pass over
    query history: the names of the rules that hit are exploded, and a finding's
    severity and text are built only after that, for its own rule. The rules are columns
    of a projection first, in which Spark works their common part out once per row; in
    the generator's own expression each rule would do so anew."""
    by_name = rules(as_of, multiline)
    judged = costed_qh.withColumns({f"_{name}": pred for name, (pred, _, _) in by_name.items()})
    names = F.array(*[F.when(F.col(f"_{name}"), F.lit(name)) for name in by_name])
    hits = judged.withColumn("antipattern_type", F.explode(names)).filter(F.col("antipattern_type").isNotNull())

    def of_rule(part: int):
        pick = None
        for name, parts in by_name.items():
            hit = F.col("antipattern_type") == name
            pick = F.when(hit, parts[part]) if pick is None else pick.when(hit, parts[part])
        return pick

    row_local = hits.select("query_id", "user_name", "warehouse_name", "antipattern_type", of_rule(1).alias("severity"),
                            "estimated_waste_usd", of_rule(2).alias("recommendation"),
                            F.col("query_text").alias("sample_query_text"), "end_time")
    rep = repeated_queries(patterns).select(*COMMON).withColumn("end_time", F.col("end_time").cast("timestamp_ntz"))
    text = F.col("sample_query_text")
    return (row_local.unionByName(rep)
            .filter(text.isNotNull() & (F.trim(text) != "") & X.not_like_any(text, X.INTERNAL_PREFIXES_UNION)))
