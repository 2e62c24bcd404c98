"""Raw tables of long expressions are written once, so that the models over them do not
work the expressions out again for every filter and column."""

import glob
import os

from costlens.functions.exprs import AsOf
from costlens.plans.pipeline import Pipeline
from costlens.session import checkpoint_root
from costlens.sources import telemetry
from costlens.sources.seeds import test_config as config

ROWS = [("'Q' || CAST(id AS STRING)", "query_id"), ("CASE id % 3 WHEN 0 THEN 'SELECT * FROM t' WHEN 1 THEN NULL ELSE 'call x' END", "query_text"),
        ("IF(id % 5 = 4, 'FAIL', 'SUCCESS')", "execution_status"), ("IF(id % 4 = 3, NULL, 'ETL_WH')", "warehouse_name"),
        ("id * 1000", "execution_time_ms"), ("TIMESTAMP_NTZ '2024-01-30 00:00:00' + id * INTERVAL '1' SECOND", "start_time")]


def _written(spark):
    return set(glob.glob(os.path.join(checkpoint_root(spark), "models", "raw-query_history-*")))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_derived_history_is_written_once_and_read_by_all(spark):
    raw = {"query_history": spark.range(60).unionByName(spark.range(5)).selectExpr(*[f"{e} AS {c}" for e, c in ROWS])}
    before = _written(spark)
    p = Pipeline(spark, raw, AsOf(), config(), derived=("query_history",))
    plain = Pipeline(spark, raw, AsOf(), config())
    for key in ("stg_query_history", "query_cost_attribution", "query_history_costed"):
        assert "call x" in _plan(plain[key]) and "call x" not in _plan(p[key])
        assert p[key].dtypes == plain[key].dtypes
        assert sorted(map(repr, p[key].collect())) == sorted(map(repr, plain[key].collect()))
    (costs,) = p.published("query_cost_attribution")  # written layers read the same table
    assert sorted(map(repr, costs.collect())) == sorted(map(repr, plain["query_cost_attribution"].collect()))
    assert len(_written(spark) - before) == 1


def test_test_data_pipelines_write_their_history(spark):
    import __spark_entry__ as E

    scans = _plan(E.queries()["query_cost_attribution"](spark, E.SF_SMOKE))
    assert "o_orderkey" not in scans and "query_text" in scans


ORDERS = [("id", "o_orderkey"), ("id % 7", "o_custkey"), ("'O'", "o_orderstatus"), ("id * 1000.0D", "o_totalprice")]


def test_history_of_a_file_of_one_row_group_is_written_in_parts(spark, tmp_path):
    import __spark_entry__ as E

    for table in telemetry.INPUT_TABLES:
        rows = spark.read.parquet(f"{E.SF_SMOKE}/{table}.parquet").limit(0)
        if table == "orders":
            rows = spark.range(0, 2000, 1, 1).unionByName(spark.range(0, 3, 1, 1)).selectExpr(*[f"{e} AS {c}" for e, c in ORDERS])
        rows.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    before = _written(spark)
    history = Pipeline.from_testdata(spark, str(tmp_path)).source("query_history")
    (folder,) = _written(spark) - before
    assert len(glob.glob(f"{folder}/*.parquet")) > 1
    assert history.count() == 2003 and history.select("query_id").distinct().count() == 2000


def test_history_with_costs_is_not_written_again(spark):
    raw = {"query_history": spark.range(60).selectExpr(
        *[f"{e} AS {c}" for e, c in ROWS], *[f"CAST(id AS BIGINT) AS {c}" for c in ("rows_produced", "bytes_scanned", "bytes_spilled_to_remote_storage")])}
    p = Pipeline(spark, raw, AsOf(), config(), derived=("query_history",))
    (spills,) = p.published("ap_spill")
    assert spills.dtypes == p["ap_spill"].dtypes and sorted(map(repr, spills.collect())) == sorted(map(repr, p["ap_spill"].collect()))
    root = checkpoint_root(spark)
    assert "ap_spill" in p._run().materialize and "query_history_costed" not in p._run().materialize
    assert not glob.glob(os.path.join(root, "models", "query_history_costed-*"))
