"""Telemetry adapter.

The account telemetry the models read (query history, metering, load, storage,
access, serverless usage, logins, sessions) is not part of the test data. It is
derived from the given tables by plain column expressions. The expressions are
SQL text, evaluated by Spark through ``selectExpr`` and rendered verbatim into
the DuckDB oracle, so both engines start from identical inputs.

Each block is ``(source, prefilter, [(column, expression), ...])``; ``{AS_OF}``
and ``{AS_OF_DATE}`` are replaced by typed literals of the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf

# FIXED VALUES: derivation of the telemetry tables (FIXTURES.md section 2).
QUERY_HISTORY_BASE = [
    ("query_id", "'Q' || lpad(CAST(o_orderkey AS STRING), 10, '0')"),
    ("query_text", """CASE o_orderkey % 50
    WHEN 0 THEN 'SELECT * FROM db' || CAST(o_orderkey % 4 AS STRING) || '.pub.t' || CAST(o_custkey % 40 AS STRING)
    WHEN 1 THEN 'SELECT a FROM t' || CAST(o_custkey % 40 AS STRING) || ' ORDER BY a'
    WHEN 2 THEN 'call refresh_all()'
    WHEN 3 THEN 'alter table t set x = 1'
    WHEN 4 THEN 'SELECT 1 FROM SNOWFLAKE.ACCOUNT_USAGE.QUERY_HISTORY'
    WHEN 5 THEN 'execute dbt project p'
    WHEN 6 THEN '  '
    WHEN 7 THEN NULL
    ELSE 'SELECT a, b FROM db' || CAST(o_orderkey % 4 AS STRING) || '.pub.t' || CAST(o_custkey % 40 AS STRING) || ' JOIN pub.d1 WHERE k = ' || CAST(o_custkey AS STRING) || ' LIMIT 10' END"""),
    ("query_type", "CASE WHEN o_orderkey % 10 < 8 THEN 'SELECT' WHEN o_orderkey % 10 = 8 THEN 'INSERT' ELSE 'MERGE' END"),
    ("query_tag", "CASE o_custkey % 4 WHEN 0 THEN 'team:ml;scenario:repeated_query;run_id:1' WHEN 1 THEN 'adhoc' ELSE NULL END"),
    ("session_id", "o_custkey"),
    ("user_name", "CASE WHEN o_custkey % 41 = 0 THEN 'SYSTEM' ELSE 'USER_' || CAST(o_custkey % 25 AS STRING) END"),
    ("role_name", "CASE o_custkey % 7 WHEN 0 THEN 'SYSADMIN' WHEN 1 THEN 'ANALYST_RO' WHEN 2 THEN 'DATA_ENGINEER' WHEN 3 THEN 'TRANSFORMER' WHEN 4 THEN 'PUBLIC' WHEN 5 THEN 'TENSOR_RO' ELSE 'READER' END"),
    ("warehouse_name", "CASE o_custkey % 6 WHEN 0 THEN 'COMPUTE_WH' WHEN 1 THEN 'ANALYTICS_WH' WHEN 2 THEN 'ETL_WH' WHEN 3 THEN 'COST_OPT_WH' WHEN 4 THEN 'LEARNING_WH' ELSE NULL END"),
    ("warehouse_size", "CASE o_custkey % 6 WHEN 0 THEN 'X-Small' WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' WHEN 3 THEN 'Large' ELSE NULL END"),
    ("database_name", "CASE WHEN o_orderkey % 97 = 0 THEN 'SNOWFLAKE' ELSE 'DB' || CAST(o_orderkey % 4 AS STRING) END"),
    ("execution_status", "CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'FAIL' ELSE 'SUCCESS' END"),
    ("start_time", "{AS_OF} - (o_orderkey % 120 + 1) * INTERVAL '1' DAY + (CASE WHEN o_custkey % 6 = 1 AND o_orderkey % 40 <> 0 THEN 28800 + (o_orderkey * 7919) % 36000 ELSE (o_orderkey * 7919) % 86400 END) * INTERVAL '1' SECOND"),
    ("total_elapsed_time_ms", "CAST(floor(o_totalprice * 5) AS BIGINT)"),
    ("execution_time_ms", "CAST(floor(o_totalprice * 4) AS BIGINT)"),
    ("queued_overload_time_ms", "CAST(floor(o_totalprice) AS BIGINT) % 20000"),
    ("bytes_scanned", "(o_orderkey * 104729) % 5000000000"),
    ("rows_produced", "CASE WHEN o_orderkey % 20 = 0 THEN (o_orderkey * 104729) % 5000000000 WHEN o_orderkey % 50 = 1 THEN 200000 + o_orderkey ELSE (o_orderkey * 31) % 400000 END"),
    ("partitions_scanned", "(o_orderkey * 13) % 400"),
    ("partitions_total", "CASE WHEN o_orderkey % 30 = 29 THEN 0 ELSE 400 END"),
    ("bytes_spilled_to_local_storage", "CASE WHEN o_orderkey % 9 = 0 THEN 100000000 + o_orderkey * 1000 ELSE 0 END"),
    ("bytes_spilled_to_remote_storage", "CASE WHEN o_custkey % 6 = 3 THEN 0 WHEN o_orderkey % 18 = 0 OR (o_custkey % 6 = 2 AND o_orderkey % 5 = 0) THEN 900000000 + (o_orderkey * 100003) % 400000000 ELSE 0 END"),
    ("query_parameterized_hash", "CASE WHEN o_custkey % 6 = 2 THEN 'H_HOT' WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'H' || CAST(o_orderkey % 500 AS STRING) END"),
    ("credits_used_cloud_services", "o_totalprice / 100000000"),
]
QUERY_HISTORY_END = "start_time + CAST(floor(total_elapsed_time_ms / 1000) AS BIGINT) * INTERVAL '1' SECOND"

WH_NAME_BY_5 = "CASE {k} % 5 WHEN 0 THEN 'COMPUTE_WH' WHEN 1 THEN 'ANALYTICS_WH' WHEN 2 THEN 'ETL_WH' WHEN 3 THEN 'COST_OPT_WH' ELSE 'LEARNING_WH' END"

BLOCKS = {
    "warehouse_metering_history": ("lineitem", None, [
        ("warehouse_name", WH_NAME_BY_5.format(k="l_orderkey")),
        ("start_time", "{AS_OF} - (l_partkey % 120 + 1) * INTERVAL '1' DAY + (l_linenumber * 3) * INTERVAL '1' HOUR"),
        ("end_time", "{AS_OF} - (l_partkey % 120 + 1) * INTERVAL '1' DAY + (l_linenumber * 3 + 1) * INTERVAL '1' HOUR"),
        ("credits_used_compute", "l_quantity / 500 * (CASE WHEN l_partkey % 120 = 0 THEN 5 ELSE 1 END)"),
        ("credits_used_cloud_services", "l_quantity / 5000"),
        ("credits_used", "l_quantity / 500 * (CASE WHEN l_partkey % 120 = 0 THEN 5 ELSE 1 END) + l_quantity / 5000"),
    ]),
    "warehouse_load_history": ("events", None, [
        ("warehouse_name", WH_NAME_BY_5.format(k="event_id")),
        ("start_time", "ts"),
        ("end_time", "ts + INTERVAL '5' MINUTE"),
        ("avg_running", "CASE WHEN floor(event_id / 5) % 7 < 3 THEN 0.0 ELSE value / 10 END"),
        ("avg_queued_load", "CASE WHEN event_type = 'error' AND floor(event_id / 5) % 7 >= 3 THEN value / 20 ELSE 0.0 END"),
        ("avg_queued_provisioning", "CASE WHEN event_type = 'signup' AND floor(event_id / 5) % 7 >= 3 THEN value / 50 ELSE 0.0 END"),
        ("avg_blocked", "CASE WHEN event_id % 5 = 3 AND floor(event_id / 5) % 7 >= 3 THEN value ELSE 0.0 END"),
    ]),
    "table_storage_metrics": ("part", None, [
        ("id", "p_partkey"),
        ("table_name", "CASE WHEN p_partkey % 6 = 0 THEN 'tmp_t' ELSE 't' END || CAST(p_partkey AS STRING)"),
        ("table_schema", "CASE WHEN p_partkey % 5 = 0 THEN 'staging' ELSE 'pub' END"),
        ("table_catalog", "'DB' || CAST(p_partkey % 4 AS STRING)"),
        ("is_transient", "CASE WHEN p_partkey % 4 = 0 THEN 'YES' ELSE 'NO' END"),
        ("active_bytes", "p_partkey * 1000000000"),
        ("time_travel_bytes", "CASE WHEN p_partkey % 10 = 0 THEN p_partkey * 3000000000 ELSE 1000 END"),
        ("failsafe_bytes", "CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE p_partkey * 500000000 END"),
        ("retained_for_clone_bytes", "CASE WHEN p_partkey % 8 = 0 THEN p_partkey * 100000000 ELSE 0 END"),
        ("table_created", "{AS_OF} - (p_partkey % 300 + 200) * INTERVAL '1' DAY"),
        ("table_dropped", "CASE WHEN p_partkey % 33 = 0 THEN {AS_OF} ELSE NULL END"),
    ]),
    # every line of an order is a read of its part's table, so any table can be read
    "access_objects": ("lineitem", None, [
        ("query_id", "'Q' || lpad(CAST(l_orderkey AS STRING), 10, '0')"),
        ("query_start_time", "{AS_OF} - (l_partkey % 200 + 1 + l_orderkey % 5) * INTERVAL '1' DAY"),
        ("object_name", "'DB' || CAST(l_partkey % 4 AS STRING) || '.' || CASE WHEN l_partkey % 5 = 0 THEN 'staging' ELSE 'pub' END || '.' || CASE WHEN l_partkey % 6 = 0 THEN 'tmp_t' ELSE 't' END || CAST(l_partkey AS STRING)"),
    ]),
    "pipe_usage_history": ("lineitem", "l_linenumber % 5 = 1", [
        ("pipe_name", "'PIPE_' || CAST(l_suppkey % 7 AS STRING)"),
        ("start_time", "{AS_OF} - (l_partkey % 120 + 1) * INTERVAL '1' DAY"),
        ("credits_used", "l_quantity / 5000"),
        ("bytes_inserted", "l_partkey * 1000"),
        ("files_inserted", "l_suppkey"),
    ]),
    "serverless_objects": ("lineitem", "l_linenumber % 5 <> 1", [
        ("service_type", "CASE l_linenumber % 5 WHEN 2 THEN 'AUTOMATIC_CLUSTERING' WHEN 3 THEN 'MATERIALIZED_VIEW' WHEN 4 THEN 'SERVERLESS_TASK' ELSE 'SEARCH_OPTIMIZATION' END"),
        ("database_name", "'DB' || CAST(l_suppkey % 4 AS STRING)"),
        ("schema_name", "'pub'"),
        ("object_name", "'t' || CAST(l_suppkey % 9 AS STRING)"),
        ("start_time", "{AS_OF} - (l_partkey % 120 + 1) * INTERVAL '1' DAY"),
        ("credits_used", "l_quantity / 5000"),
    ]),
    "login_history": ("customer", None, [
        ("event_id", "c_custkey"),
        ("event_timestamp", "{AS_OF} - (c_custkey % 120 * 1440 + c_custkey % 1440 + 1) * INTERVAL '1' MINUTE"),
        ("event_type", "'LOGIN'"),
        ("user_name", "'USER_' || CAST(c_custkey % 25 AS STRING)"),
        ("is_success", "CASE WHEN c_custkey % 10 = 0 THEN 'NO' ELSE 'YES' END"),
    ]),
    "sessions": ("customer", None, [
        ("session_id", "c_custkey"),
        ("user_name", "'USER_' || CAST(c_custkey % 25 AS STRING)"),
        ("created_on", "{AS_OF} - (c_custkey % 120 * 1440 + c_custkey % 1440 + 1) * INTERVAL '1' MINUTE"),
    ]),
}

# day offsets present in the history (one per distinct order key residue)
DAY_SET = "SELECT DISTINCT o_orderkey % 120 AS d FROM orders"
DB_SET = "SELECT DISTINCT o_orderkey % 4 AS b FROM orders"
STORAGE_USAGE = [
    ("usage_date", "CAST({AS_OF_DATE} - CAST(d + 1 AS INT) AS DATE)"),
    ("storage_bytes", "5000000000000 + (120 - d) * 10000000000"),
    ("stage_bytes", "200000000000"),
    ("failsafe_bytes", "300000000000"),
]
DATABASE_STORAGE = [
    ("usage_date", "CAST({AS_OF_DATE} - CAST(d + 1 AS INT) AS DATE)"),
    ("database_name", "'DB' || CAST(b AS STRING)"),
    ("average_database_bytes", "((b + 1) * 1000000000000 + (120 - d) * 10000000000) * (CASE WHEN b = 0 AND d = 0 THEN 2 ELSE 1 END)"),
]
SERVERLESS_SPLIT = {
    "automatic_clustering_history": "AUTOMATIC_CLUSTERING",
    "materialized_view_refresh_history": "MATERIALIZED_VIEW",
    "serverless_task_history": "SERVERLESS_TASK",
    "search_optimization_history": "SEARCH_OPTIMIZATION",
}
# object column of each serverless history table
SERVERLESS_OBJECT_COLUMN = {
    "automatic_clustering_history": "table_name",
    "materialized_view_refresh_history": "table_name",
    "serverless_task_history": "task_name",
    "search_optimization_history": "table_name",
}

#: Derived tables that are written before use: each of their columns is a long
#: expression, which the filters and sums of a model would otherwise work out many times.
WRITTEN = ("query_history",)

INPUT_TABLES = ("orders", "lineitem", "events", "part", "customer")


def render(expr: str, as_of: AsOf, engine: str) -> str:
    return expr.replace("{AS_OF_DATE}", as_of.date_sql(engine)).replace("{AS_OF}", as_of.ts_sql(engine))


def _select(df: DataFrame, cols, as_of: AsOf) -> DataFrame:
    return df.selectExpr(*[f"{render(e, as_of, 'spark')} AS {c}" for c, e in cols])


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` in as many parts as a shuffle has. A row group of a file is read by one task,
    so a file of few row groups would have few tasks work out the long expressions above
    it, and the table written from them would be read again in as few."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def derive(spark: SparkSession, sf_dir: str, as_of: AsOf) -> dict[str, DataFrame]:
    """Raw telemetry tables (before staging) derived from the test tables."""
    base = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in INPUT_TABLES}
    out: dict[str, DataFrame] = {}

    qh = _select(dealt(base["orders"], "o_orderkey"), QUERY_HISTORY_BASE, as_of)
    out["query_history"] = qh.withColumn("end_time", F.expr(QUERY_HISTORY_END))

    for name, (src, pre, cols) in BLOCKS.items():
        df = base[src]
        if pre:
            df = df.filter(pre)
        out[name] = _select(df, cols, as_of)

    # day / database sets are bounded (<= 120 and <= 4 rows): broadcast-safe
    days = base["orders"].selectExpr("o_orderkey % 120 AS d").distinct()
    dbs = base["orders"].selectExpr("o_orderkey % 4 AS b").distinct()
    out["storage_usage"] = _select(days, STORAGE_USAGE, as_of)
    out["database_storage_usage_history"] = _select(days.crossJoin(F.broadcast(dbs)), DATABASE_STORAGE, as_of)

    # access history: objects nested per query, as the account view holds them
    acc = out.pop("access_objects")
    out["access_history"] = acc.groupBy("query_id").agg(
        F.min("query_start_time").alias("query_start_time"),
        F.sort_array(F.collect_list(F.struct(F.col("object_name").alias("objectName")))).alias("base_objects_accessed"),
    )

    sv = out.pop("serverless_objects")
    for table, service in SERVERLESS_SPLIT.items():
        obj = SERVERLESS_OBJECT_COLUMN[table]
        out[table] = sv.filter(F.col("service_type") == service).select(
            F.col("object_name").alias(obj), "schema_name", "database_name", "start_time", "credits_used")
    return out


def access_reads(spark: SparkSession, sf_dir: str, as_of: AsOf) -> DataFrame:
    """The reads of the derived access history as rows, the latest per object, for
    models that would only take its arrays apart again."""
    columns = {c: render(e, as_of, "spark") for c, e in BLOCKS["access_objects"][2]}
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey").withColumn("own", F.expr(columns["query_start_time"]))
    query = F.min("own").over(Window.partitionBy("l_orderkey"))
    latest = lines.withColumn("query_start_time", query).groupBy("l_partkey").agg(F.max("query_start_time").alias("query_start_time"))
    return latest.selectExpr(f"{columns['object_name']} AS object_name", "query_start_time")


_SERVERLESS = "schema_name string, database_name string, start_time timestamp_ntz, credits_used double"
# FIXED VALUES: columns of the account's usage tables.
SOURCES = {
    "query_history": (
        "query_id string, query_text string, query_type string, query_tag string, session_id bigint, user_name string, role_name string, "
        "warehouse_name string, warehouse_size string, database_name string, execution_status string, start_time timestamp_ntz, "
        "total_elapsed_time_ms bigint, execution_time_ms bigint, queued_overload_time_ms bigint, bytes_scanned bigint, rows_produced bigint, "
        "partitions_scanned bigint, partitions_total int, bytes_spilled_to_local_storage bigint, bytes_spilled_to_remote_storage bigint, "
        "query_parameterized_hash string, credits_used_cloud_services double, end_time timestamp_ntz"),
    "warehouse_metering_history": "warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used_compute double, credits_used_cloud_services double, credits_used double",
    "warehouse_load_history": "warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, avg_running double, avg_queued_load double, avg_queued_provisioning double, avg_blocked double",
    "table_storage_metrics": (
        "id bigint, table_name string, table_schema string, table_catalog string, is_transient string, active_bytes bigint, time_travel_bytes bigint, "
        "failsafe_bytes bigint, retained_for_clone_bytes bigint, table_created timestamp_ntz, table_dropped timestamp_ntz"),
    "pipe_usage_history": "pipe_name string, start_time timestamp_ntz, credits_used double, bytes_inserted bigint, files_inserted bigint",
    "login_history": "event_id bigint, event_timestamp timestamp_ntz, event_type string, user_name string, is_success string",
    "sessions": "session_id bigint, user_name string, created_on timestamp_ntz",
    "storage_usage": "usage_date date, storage_bytes bigint, stage_bytes bigint, failsafe_bytes bigint",
    "database_storage_usage_history": "usage_date date, database_name string, average_database_bytes bigint",
    "access_history": "query_id string, query_start_time timestamp_ntz, base_objects_accessed array<struct<objectName:string>>",
    "automatic_clustering_history": f"table_name string, {_SERVERLESS}",
    "materialized_view_refresh_history": f"table_name string, {_SERVERLESS}",
    "serverless_task_history": f"task_name string, {_SERVERLESS}",
    "search_optimization_history": f"table_name string, {_SERVERLESS}",
}


def read_sources(spark: SparkSession, folder: str, form: str = "parquet") -> dict[str, DataFrame]:
    """The 14 usage tables from ``<folder>/<table>`` under their fixed schemas, for
    ``Pipeline(spark, read_sources(...), as_of, config)``. Folders partitioned by a
    date column are pruned by filters on it; a missing table is an error."""
    return {name: spark.read.schema(schema).format(form).load(f"{folder}/{name}") for name, schema in SOURCES.items()}
