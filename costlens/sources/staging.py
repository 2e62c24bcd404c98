"""Staging projector: one generic rename + cast + ``_loaded_at`` step driven by a
column table, instead of one hand-written function per source.

A spec row is ``(output column, source expression or None, type)``. ``None``
means "the same-named source column"; a source column that does not exist in
the raw table becomes a typed NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from costlens.functions.exprs import DAY, AsOf

_OBJ = "array<struct<objectName:string>>"

STAGING = {
    "stg_query_history": ("query_history", [
        ("query_id", None, "string"), ("query_text", None, "string"), ("query_type", None, "string"),
        ("query_tag", None, "string"), ("session_id", None, "long"), ("user_name", None, "string"),
        ("role_name", None, "string"), ("warehouse_name", None, "string"), ("warehouse_size", None, "string"),
        ("warehouse_type", None, "string"), ("database_name", None, "string"), ("schema_name", None, "string"),
        ("execution_status", None, "string"), ("error_code", None, "string"), ("error_message", None, "string"),
        ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"),
        ("total_elapsed_time_ms", None, "long"), ("execution_time_ms", None, "long"),
        ("queued_provisioning_time_ms", None, "long"), ("queued_repair_time_ms", None, "long"),
        ("queued_overload_time_ms", None, "long"), ("compilation_time_ms", None, "long"),
        ("bytes_scanned", None, "long"), ("rows_produced", None, "long"), ("bytes_written", None, "long"),
        ("bytes_written_to_result", None, "long"), ("bytes_read_from_result", None, "long"),
        ("partitions_scanned", None, "long"), ("partitions_total", None, "long"),
        ("bytes_spilled_to_local_storage", None, "long"), ("bytes_spilled_to_remote_storage", None, "long"),
        ("query_parameterized_hash", None, "string"), ("query_hash", None, "string"),
        ("credits_used_cloud_services", None, "double"),
    ]),
    "stg_warehouse_metering": ("warehouse_metering_history", [
        ("warehouse_name", None, "string"), ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"),
        ("credits_used", None, "double"), ("credits_used_compute", None, "double"),
        ("credits_used_cloud_services", None, "double"),
    ]),
    "stg_warehouse_load": ("warehouse_load_history", [
        ("warehouse_name", None, "string"), ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"),
        ("avg_running", None, "double"), ("avg_queued_load", None, "double"),
        ("avg_queued_provisioning", None, "double"), ("avg_blocked", None, "double"),
    ]),
    "stg_table_storage": ("table_storage_metrics", [
        ("table_id", "id", "long"), ("table_name", None, "string"), ("schema_name", "table_schema", "string"),
        ("database_name", "table_catalog", "string"),
        ("table_type", "CASE WHEN is_transient = 'YES' THEN 'TRANSIENT TABLE' ELSE 'BASE TABLE' END", "string"),
        ("is_transient", None, "string"), ("active_bytes", None, "long"), ("time_travel_bytes", None, "long"),
        ("failsafe_bytes", None, "long"), ("retained_for_clone_bytes", None, "long"),
        ("table_created", None, "timestamp_ntz"), ("table_dropped", None, "timestamp_ntz"),
        ("table_entered_failsafe", None, "timestamp_ntz"), ("is_deleted", "deleted", "boolean"),
        ("last_altered", "table_created", "timestamp_ntz"), ("comment", None, "string"),
    ]),
    "stg_storage_usage": ("storage_usage", [
        ("usage_date", None, "date"), ("storage_bytes", None, "long"), ("stage_bytes", None, "long"),
        ("failsafe_bytes", None, "long"),
    ]),
    "stg_database_storage": ("database_storage_usage_history", [
        ("usage_date", None, "date"), ("database_name", None, "string"),
        ("average_database_bytes", None, "long"), ("average_failsafe_bytes", None, "long"),
    ]),
    "stg_access_history": ("access_history", [
        ("query_id", None, "string"), ("query_start_time", None, "timestamp_ntz"), ("user_name", None, "string"),
        ("direct_objects_accessed", None, _OBJ), ("base_objects_accessed", None, _OBJ),
        ("objects_modified", None, _OBJ), ("object_modified_by_ddl", None, "string"),
        ("policies_referenced", None, _OBJ),
    ]),
    "stg_login_history": ("login_history", [
        ("event_id", None, "long"), ("event_timestamp", None, "timestamp_ntz"), ("event_type", None, "string"),
        ("user_name", None, "string"), ("client_ip", None, "string"), ("reported_client_type", None, "string"),
        ("reported_client_version", None, "string"), ("first_authentication_factor", None, "string"),
        ("second_authentication_factor", None, "string"), ("is_success", None, "string"),
        ("error_code", None, "long"), ("error_message", None, "string"),
    ]),
    "stg_sessions": ("sessions", [
        ("session_id", None, "long"), ("user_name", None, "string"), ("created_on", None, "timestamp_ntz"),
        ("authentication_method", None, "string"), ("client_application_id", None, "string"),
        ("client_application_version", None, "string"), ("client_build_id", None, "string"),
        ("client_environment", None, "string"),
    ]),
    "stg_clustering": ("automatic_clustering_history", [
        ("table_name", None, "string"), ("schema_name", None, "string"), ("database_name", None, "string"),
        ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"), ("credits_used", None, "double"),
        ("num_bytes_reclustered", None, "long"), ("num_rows_reclustered", None, "long"),
    ]),
    "stg_mv_refresh": ("materialized_view_refresh_history", [
        ("table_id", None, "long"), ("table_name", None, "string"), ("schema_id", None, "long"),
        ("schema_name", None, "string"), ("database_id", None, "long"), ("database_name", None, "string"),
        ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"), ("credits_used", None, "double"),
    ]),
    "stg_pipe_usage": ("pipe_usage_history", [
        ("pipe_name", None, "string"), ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"),
        ("credits_used", None, "double"), ("bytes_inserted", None, "long"), ("files_inserted", None, "long"),
    ]),
    "stg_serverless_task": ("serverless_task_history", [
        ("task_name", None, "string"), ("database_name", None, "string"), ("schema_name", None, "string"),
        ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"), ("credits_used", None, "double"),
    ]),
    "stg_search_optimization": ("search_optimization_history", [
        ("table_name", None, "string"), ("schema_name", None, "string"), ("database_name", None, "string"),
        ("start_time", None, "timestamp_ntz"), ("end_time", None, "timestamp_ntz"), ("credits_used", None, "double"),
    ]),
}

DUCK_TYPES = {
    "string": "VARCHAR", "long": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "boolean": "BOOLEAN", _OBJ: "STRUCT(objectName VARCHAR)[]",
}


def _exprs(spec, raw_cols, as_of: AsOf, engine: str) -> list[str]:
    out = []
    for name, src, typ in spec:
        t = typ if engine == "spark" else DUCK_TYPES[typ]
        if src is None:
            src = name
        ident = src.split()[0] if " " not in src else None
        if ident is not None and ident not in raw_cols:
            out.append(f"CAST(NULL AS {t}) AS {name}")
        else:
            out.append(f"CAST({src} AS {t}) AS {name}")
    out.append(f"{as_of.ts_sql(engine)} AS _loaded_at")
    return out


def project(name: str, raw: DataFrame, as_of: AsOf) -> DataFrame:
    _, spec = STAGING[name]
    laid = [DAY] if DAY in raw.columns else []  # of a table laid out by day, for pruning
    return raw.selectExpr(*_exprs(spec, set(raw.columns), as_of, "spark"), *laid)


def project_sql(name: str, raw_cols: set[str], as_of: AsOf) -> str:
    source, spec = STAGING[name]
    return f"SELECT {', '.join(_exprs(spec, raw_cols, as_of, 'duckdb'))} FROM {source}"
