"""Storage analysis: per-table breakdown with last read date, and the four
storage findings with their recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf

TB = float(1024 ** 4)
USD_PER_TB_MONTH = 23.0

# FIXED VALUES: finding texts.
TT_TEXT = "Reduce TIME_TRAVEL_RETENTION_IN_DAYS to 1 — TT storage exceeds active data"
TRANSIENT_TEXT = "Convert to TRANSIENT table to eliminate fail-safe storage cost"
CLONE_TEXT = "Review clone — diverged storage adding cost. Consider dropping if no longer needed."
TRANSIENT_NAME_MARKERS = ["staging", "stg", "temp", "tmp"]


def _fqn() -> F.Column:
    return F.concat(F.col("database_name"), F.lit("."), F.col("schema_name"), F.lit("."), F.col("table_name"))


def last_access(access: DataFrame) -> DataFrame:
    """Latest read per object name. ``access`` has the read objects of a query nested,
    as structs or as JSON text, or one object per row (``object_name``). Queries without
    objects give no row, as a flatten of their empty lists; so do JSON texts that are not
    valid, and elements without a name. Partial aggregation keeps one row per object and
    task before the shuffle."""
    types = dict(access.dtypes)
    if "object_name" in types:
        reads = access.select("query_start_time", F.col("object_name").alias("full_table_name"))
    elif types["base_objects_accessed"] in ("string", "variant"):
        reads = _json_reads(access)
    else:
        reads = access.select("query_start_time", F.explode("base_objects_accessed").alias("o")).select(
            "query_start_time", F.col("o.objectName").alias("full_table_name"))
    return reads.groupBy("full_table_name").agg(F.max("query_start_time").alias("last_read_date"))


def _json_reads(access: DataFrame) -> DataFrame:
    """The reads of an access history that came as JSON, by a lateral join with the
    elements of each list."""
    objects = F.col("base_objects_accessed")
    if dict(access.dtypes)["base_objects_accessed"] == "string":
        access = access.select("query_start_time", F.try_parse_json(objects).alias("objects"))
    else:
        access = access.select("query_start_time", objects.alias("objects"))
    each = access.sparkSession.tvf.variant_explode(F.col("objects").outer())
    return access.lateralJoin(each).select(
        "query_start_time", F.try_variant_get("value", "$.objectName", "string").alias("full_table_name")).filter("full_table_name IS NOT NULL")


def storage_breakdown(tables: DataFrame, access: DataFrame, as_of: AsOf) -> DataFrame:
    live = tables.filter(F.col("table_dropped").isNull() & F.col("database_name").isNotNull())
    s = live.select(
        "database_name", "schema_name", "table_name", "table_type", "is_transient", "active_bytes",
        "time_travel_bytes", "failsafe_bytes", "retained_for_clone_bytes",
        (F.col("active_bytes") / TB).alias("active_tb"), (F.col("time_travel_bytes") / TB).alias("time_travel_tb"),
        (F.col("failsafe_bytes") / TB).alias("failsafe_tb"),
        ((F.col("active_bytes") + F.col("time_travel_bytes") + F.col("failsafe_bytes")) / TB).alias("total_tb"),
        "table_created", "last_altered", _fqn().alias("fqn"))
    la = last_access(access)
    return s.join(la, s["fqn"] == la["full_table_name"], "left").select(
        "database_name", "schema_name", "table_name", "table_type", "is_transient", "active_bytes",
        "time_travel_bytes", "failsafe_bytes", "retained_for_clone_bytes", "active_tb", "time_travel_tb",
        "failsafe_tb", "total_tb", (F.col("total_tb") * USD_PER_TB_MONTH).alias("estimated_monthly_cost_usd"),
        "table_created", "last_altered", "last_read_date",
        X.days_between(F.coalesce("last_read_date", "table_created"), as_of.ts_col()).alias("days_since_last_read"))


def storage_unused_tables(sb: DataFrame) -> DataFrame:
    return (sb.filter((F.col("days_since_last_read") > 90) & (F.col("active_bytes") > 0)
                      & F.col("last_read_date").isNotNull())
            .select("database_name", "schema_name", "table_name", "active_bytes", "active_tb", "time_travel_tb",
                    "failsafe_tb", "total_tb", "estimated_monthly_cost_usd", "last_read_date", "days_since_last_read",
                    F.concat(F.lit("DROP or archive table — no reads in "), F.col("days_since_last_read").cast("string"),
                             F.lit(" days")).alias("recommendation"),
                    F.col("estimated_monthly_cost_usd").alias("savings_if_dropped_usd")))


def storage_time_travel_waste(sb: DataFrame) -> DataFrame:
    return (sb.filter((F.col("time_travel_bytes") > F.col("active_bytes")) & (F.col("active_bytes") > 0)
                      & (F.col("time_travel_bytes") > 0))
            .select("database_name", "schema_name", "table_name", "active_bytes", "time_travel_bytes", "active_tb",
                    "time_travel_tb", X.safe_divide("time_travel_bytes", "active_bytes").alias("tt_to_active_ratio"),
                    (F.col("time_travel_tb") * USD_PER_TB_MONTH * 0.7).alias("estimated_savings_usd"),
                    F.lit(TT_TEXT).alias("recommendation"),
                    F.concat(F.lit("ALTER TABLE "), _fqn(), F.lit(" SET DATA_RETENTION_TIME_IN_DAYS = 1;"))
                    .alias("action_sql")))


def storage_transient_candidates(sb: DataFrame) -> DataFrame:
    schema_l, table_l = F.lower("schema_name"), F.lower("table_name")
    named = None
    for m in TRANSIENT_NAME_MARKERS:
        hit = schema_l.contains(m) | table_l.contains(m)
        named = hit if named is None else named | hit
    return (sb.filter((F.col("is_transient") == "NO") & (F.col("failsafe_bytes") > 0) & named)
            .select("database_name", "schema_name", "table_name", "table_type", "is_transient", "failsafe_bytes",
                    "failsafe_tb", (F.col("failsafe_tb") * USD_PER_TB_MONTH).alias("estimated_savings_usd"),
                    F.lit(TRANSIENT_TEXT).alias("recommendation"),
                    F.concat(F.lit("CREATE OR REPLACE TRANSIENT TABLE "), _fqn(), F.lit(" CLONE "), _fqn(), F.lit(";"))
                    .alias("action_sql")))


def storage_clone_overhead(sb: DataFrame) -> DataFrame:
    tb = F.col("retained_for_clone_bytes") / TB
    return (sb.filter(F.col("retained_for_clone_bytes") > 0)
            .select("database_name", "schema_name", "table_name", "table_type", "active_bytes",
                    "retained_for_clone_bytes", tb.alias("clone_overhead_tb"),
                    (tb * USD_PER_TB_MONTH).alias("estimated_clone_cost_usd"), F.lit(CLONE_TEXT).alias("recommendation")))


def storage_recommendations(unused: DataFrame, tt: DataFrame, transient: DataFrame, clone: DataFrame) -> DataFrame:
    cols = ["recommendation_type", "target_object", "description", "current_cost_usd", "savings_if_applied_usd",
            "effort", "confidence", "action_sql"]
    a = unused.select(F.lit("UNUSED_TABLE").alias("recommendation_type"), _fqn().alias("target_object"),
                      F.col("recommendation").alias("description"),
                      F.col("estimated_monthly_cost_usd").alias("current_cost_usd"),
                      F.col("savings_if_dropped_usd").alias("savings_if_applied_usd"), F.lit("MEDIUM").alias("effort"),
                      F.when(F.col("days_since_last_read") > 180, "HIGH").otherwise("MEDIUM").alias("confidence"),
                      F.concat(F.lit("DROP TABLE "), _fqn(), F.lit(";")).alias("action_sql"))
    b = tt.select(F.lit("TIME_TRAVEL_WASTE").alias("recommendation_type"), _fqn().alias("target_object"),
                  F.col("recommendation").alias("description"),
                  (F.col("time_travel_tb") * USD_PER_TB_MONTH).alias("current_cost_usd"),
                  F.col("estimated_savings_usd").alias("savings_if_applied_usd"), F.lit("LOW").alias("effort"),
                  F.lit("HIGH").alias("confidence"), "action_sql")
    c = transient.select(F.lit("TRANSIENT_CANDIDATE").alias("recommendation_type"), _fqn().alias("target_object"),
                         F.col("recommendation").alias("description"),
                         (F.col("failsafe_tb") * USD_PER_TB_MONTH).alias("current_cost_usd"),
                         F.col("estimated_savings_usd").alias("savings_if_applied_usd"), F.lit("MEDIUM").alias("effort"),
                         F.lit("MEDIUM").alias("confidence"), "action_sql")
    d = clone.select(F.lit("CLONE_OVERHEAD").alias("recommendation_type"), _fqn().alias("target_object"),
                     F.col("recommendation").alias("description"),
                     F.col("estimated_clone_cost_usd").alias("current_cost_usd"),
                     F.col("estimated_clone_cost_usd").alias("savings_if_applied_usd"), F.lit("MEDIUM").alias("effort"),
                     F.lit("MEDIUM").alias("confidence"),
                     F.concat(F.lit("-- Review and potentially drop clone: "), _fqn()).alias("action_sql"))
    return a.select(cols).unionByName(b.select(cols)).unionByName(c.select(cols)).unionByName(d.select(cols))


def storage_analysis(sb: DataFrame) -> DataFrame:
    return (sb.filter((F.col("active_bytes") > 0) | (F.col("time_travel_bytes") > 0) | (F.col("failsafe_bytes") > 0))
            .select("database_name", "schema_name", "table_name", "table_type", "is_transient", "active_bytes",
                    "time_travel_bytes", "failsafe_bytes", "retained_for_clone_bytes", "active_tb", "time_travel_tb",
                    "failsafe_tb", "total_tb", "estimated_monthly_cost_usd", "last_read_date", "days_since_last_read",
                    F.coalesce((F.col("days_since_last_read") > 90) & (F.col("active_bytes") > 0), F.lit(False))
                    .alias("is_unused"),
                    F.coalesce((F.col("time_travel_bytes") > F.col("active_bytes")) & (F.col("active_bytes") > 0),
                               F.lit(False)).alias("has_tt_waste"))
            .orderBy(F.col("total_tb").desc()))
