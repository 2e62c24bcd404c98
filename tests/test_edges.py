
import math

import pytest
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf
from costlens.operators import alerts as AL
from costlens.operators import antipatterns as AP
from costlens.operators import warehouse as W
from costlens.plans.rank import global_ntile, global_row_number, rank_within

T0 = datetime(2024, 1, 10, 0, 0)


def _util(spark, rows):
    data = [("WH", T0 + timedelta(minutes=5 * i), T0 + timedelta(minutes=5 * i + 5), idle) for i, idle in rows]
    return spark.createDataFrame(data, "warehouse_name string, interval_start timestamp_ntz, "
                                       "interval_end timestamp_ntz, is_idle boolean")


def test_idle_islands_busy_row_ends_island(spark):
    # idle, idle, busy, idle, <gap>, idle  -> 2 islands (a gap without rows does not end one: Q1)
    util = _util(spark, [(0, True), (1, True), (2, False), (3, True), (10, True)])
    got = sorted((r.idle_start, r.idle_end) for r in W.idle_islands(util).collect())
    assert got == [(T0, T0 + timedelta(minutes=10)), (T0 + timedelta(minutes=15), T0 + timedelta(minutes=55))]


def test_idle_islands_split_on_gap(spark):
    util = _util(spark, [(0, True), (1, True), (2, False), (3, True), (10, True)])
    assert W.idle_islands(util, split_on_gap=True).count() == 3


def test_idle_islands_cross_day_border(spark):
    # an island spanning midnight stays one island although windows are per day
    start = datetime(2024, 1, 10, 23, 50)
    data = [("WH", start + timedelta(minutes=5 * i), start + timedelta(minutes=5 * i + 5), True) for i in range(5)]
    util = spark.createDataFrame(data, "warehouse_name string, interval_start timestamp_ntz, "
                                       "interval_end timestamp_ntz, is_idle boolean")
    assert W.idle_islands(util).count() == 1


def test_team_rules(spark):
    df = spark.createDataFrame([("team:a;x",), ("team:;",), ("team:a",), (None,), ("xteam:a",)], "t string")
    got = [r[0] for r in df.select(X.tag_team("t")).collect()]
    assert got == ["a", "", "a", None, None]
    roles = spark.createDataFrame([("ACCOUNTADMIN", "X"), ("SYSADMIN", "X"), ("PUBLIC", "ETL_WH"),
                                   (None, "COSTXOPT_WH"), ("TENSOR_RO", "X")], "role_name string, warehouse_name string")
    got = [r[0] for r in roles.select(F.coalesce(X.role_team_attribution("role_name"),
                                                 X.warehouse_team("warehouse_name"))).collect()]
    # PUBLIC maps to Unassigned before the warehouse rule; '_' in COST_OPT is a wildcard
    assert got == ["Platform", "Platform", "Unassigned", "Cost Optimization", "AI/ML"]


def test_select_star_regex(spark):
    texts = ["  select * from t", "SELECT  * FROM t", "SELECT * FROM t\nWHERE x", "SELECT *\nFROM t", "SELECT a.* FROM t"]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    got = [r[0] for r in df.select(F.upper(F.trim("q")).rlike(AP.SELECT_STAR_PATTERN)).collect()]
    # \s matches a newline before FROM; "." does not match one after it (Q4)
    assert got == [True, True, False, True, False]


def test_boundary_datediff(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 23, 59), datetime(2024, 1, 8, 0, 1),
                                 datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 0, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz, d timestamp_ntz")
    r = df.select(X.weeks_between("a", "b"), X.minutes_between("c", "d"), X.days_between("a", "b")).first()
    assert tuple(r) == (1, 1, 1)  # Sunday -> Monday crosses a week boundary


def test_greatest_strict(spark):
    r = spark.range(1).select(X.greatest_strict(F.lit(0.0), F.lit(None).cast("double")),
                              X.greatest_strict(F.lit(0.0), F.lit(-2.0))).first()
    assert r[0] is None and r[1] == 0.0


def test_global_row_number_and_ntile(spark):
    df = spark.range(0, 1003).withColumn("v", (F.col("id") * 7919) % 101)
    ranked = global_row_number(df, [F.col("v").desc(), F.col("id")], "rn", partitions=4)
    from pyspark.sql import Window
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("v").desc(), F.col("id"))))
    assert ranked.join(ref, "id").filter(F.col("rn") != F.col("ref")).count() == 0
    tiles = global_ntile(df, [F.col("v"), F.col("id")], 10, "tile")
    ref = df.withColumn("ref", F.ntile(10).over(Window.orderBy("v", "id")))
    assert tiles.join(ref, "id").filter(F.col("tile") != F.col("ref")).count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_rank_within_equals_a_window(spark, dense):
    # a hot key, a null key, null values and ties, over more ranges than keys
    from pyspark.sql import Window
    df = spark.range(0, 2000).selectExpr(
        "id", "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'k' || id % 5 END AS k",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE (id * 7919 % 301) / 4.0D END AS v")
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    ref = df.withColumn("ref", (F.dense_rank() if dense else F.rank()).over(w))
    got = rank_within(df, "k", "v", "r", dense=dense)
    assert got.columns == ["id", "k", "v", "r"] and got.count() == 2000
    assert got.join(ref.select("id", "ref"), "id").filter(F.col("r") != F.col("ref")).count() == 0
    assert rank_within(df.limit(0), "k", "v", "r", dense=dense).count() == 0


ALERT_SCHEMA = ("alert_id string, detected_at timestamp_ntz, resource_key string, metric_value double, "
                "threshold_value double, details_json string")


def test_episode_tracker_two_runs(spark):
    now1 = AsOf("2024-01-31 00:00:00")
    a1 = spark.createDataFrame([("x", datetime(2024, 1, 30, 23, 0), "r1", 1.0, 0.5, "{}"),
                                ("x", datetime(2024, 1, 30, 12, 0), "r2", 1.0, 0.5, "{}")], ALERT_SCHEMA)
    run1 = AL.alert_state_tracker(a1, None, now1)
    assert {r.episode_number for r in run1.collect()} == {1}
    now2 = AsOf("2024-01-31 04:59:00")
    a2 = spark.createDataFrame([("x", datetime(2024, 1, 31, 5, 0), "r1", 2.0, 0.5, "{}"),
                                ("x", datetime(2024, 1, 31, 5, 0), "r2", 2.0, 0.5, "{}")], ALERT_SCHEMA)
    run2 = {r.resource_key: r for r in AL.alert_state_tracker(a2, run1, now2).collect()}
    # r1 last seen 23:00 (within 6 h of 04:59) continues; r2 last seen 12:00 re-fires
    assert (run2["r1"].episode_number, run2["r1"].is_continuation) == (1, True)
    assert (run2["r2"].episode_number, run2["r2"].is_new_episode) == (2, True)


def test_delivery_merge(spark):
    payload = spark.createDataFrame(
        [("k1", None, None, None), ("k2", None, None, None), ("k3", None, None, None), ("k4", None, None, None),
         ("k5", datetime(2024, 1, 1), 200, True)],
        "alert_episode_key string, sent_at timestamp_ntz, api_response_code int, send_success boolean")
    resp = spark.createDataFrame([("k1", 200), ("k2", 202), ("k3", 400), ("k4", None), ("k5", 500)],
                                 "alert_episode_key string, response_code int")
    got = {r.alert_episode_key: r for r in AL.alert_delivery_merge(payload, resp, AsOf()).collect()}
    assert got["k1"].send_success and got["k2"].send_success and not got["k3"].send_success
    assert got["k3"].sent_at is not None and got["k4"].sent_at is None and got["k4"].api_response_code == -1
    assert got["k5"].api_response_code == 200  # already sent: unchanged


def test_upsert_idempotent(spark, tmp_path):
    from costlens.streaming.incremental import upsert
    root = str(tmp_path / "t")
    u1 = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "c", 2)], "k long, v string, ts long")
    upsert(spark, root, u1, ["k"], [F.col("ts").desc()])
    out = upsert(spark, root, u1, ["k"], [F.col("ts").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "a"), (2, "c")]
    u2 = spark.createDataFrame([(2, "z", 3)], "k long, v string, ts long")
    out = upsert(spark, root, u2, ["k"], [F.col("ts").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "a"), (2, "z")]


def test_quality_checks_fail_on_bad_rows(spark):
    from costlens.operators import quality as Q
    bad = spark.createDataFrame([(date(2024, 1, 1), 1.0, 0.5, 0.2, 0.1), (date(2024, 1, 1), -1.0, 0.0, 0.0, 0.0)],
                                "date date, total_cost double, compute_cost double, storage_cost double, "
                                "serverless_cost double")
    frames = {"daily_cost_rollup": bad}.__getitem__
    assert Q.unique(frames, {"daily_cost_rollup": {"unique": ["date"]}}).first().failures == 1
    assert Q.column_report(frames, {"daily_cost_rollup": {"non_negative": ["total_cost"]}}).first().failures == 1
    nulls = spark.createDataFrame([(None, "x"), ("a", "y"), ("a", None)], "k string, v string")
    report = {(r.check_type, r.column_name): r.failures for r in Q.column_report(
        {"t": nulls}.__getitem__, {"t": {"not_null": ["k", "v"], "accepted": {"v": ["x"]}}}).collect()}
    assert report == {("not_null", "k"): 1, ("not_null", "v"): 1, ("accepted_values", "v"): 1}
    assert Q.rollup_components(bad).count() == 2  # both rows break total = parts


def test_upsert_survives_a_dead_writer(spark, tmp_path):
    from costlens.streaming.incremental import read_current, upsert
    root = str(tmp_path / "t")
    order = [F.col("ts").desc()]
    upsert(spark, root, spark.createDataFrame([(1, "a", 1)], "k long, v string, ts long"), ["k"], order)
    (tmp_path / "t" / "v0000000002").mkdir()  # a writer that died before its commit mark
    assert [r.v for r in read_current(spark, root).collect()] == ["a"]
    out = upsert(spark, root, spark.createDataFrame([(2, "b", 1)], "k long, v string, ts long"), ["k"], order)
    assert sorted(r.v for r in out.collect()) == ["a", "b"]
    (tmp_path / "u" / "v0000000001").mkdir(parents=True)
    (tmp_path / "u" / "v0000000002").mkdir()
    with pytest.raises(ValueError):
        read_current(spark, str(tmp_path / "u"))


def test_rounding_of_nan_and_large_values(spark):
    from costlens.functions.exprs import round4, round_half_up
    df = spark.createDataFrame([(float("nan"),), (2.0e15,), (-2.0e15,), (1.00005,), (None,)], "x double")
    got = [tuple(r) for r in df.select(round4("x"), round_half_up("x", 2)).collect()]
    assert math.isnan(got[0][0]) and math.isnan(got[0][1])
    assert got[1:3] == [(pytest.approx(2.0e15), 2.0e15), (pytest.approx(-2.0e15), -2.0e15)]
    assert got[3][0] == 1.0001 and got[4] == (None, None)


def test_ids_beyond_four_digits_do_not_clash(spark):
    from costlens.operators import recommend as R
    n = 12_000
    none = spark.createDataFrame([], "warehouse_name string, recommendation_type string, current_state string, recommended_state string, "
                                     "estimated_monthly_savings_usd double, effort string, confidence string, sql_to_apply string")
    cands = spark.createDataFrame([], "optimization_rank int, antipattern_type string, warehouse_name string, user_name string, recommendation string, "
                                      "estimated_waste_usd double, severity string, sample_query_text string, query_id string")
    storage = spark.range(n).selectExpr("'UNUSED_TABLE' AS recommendation_type", "concat('t', id) AS target_object", "'d' AS description",
                                        "1.0D AS current_cost_usd", "CAST(id + 1 AS DOUBLE) AS savings_if_applied_usd", "'LOW' AS effort",
                                        "'HIGH' AS confidence", "'x' AS action_sql")
    recs = R.all_recommendations(none, cands, storage)
    assert recs.select("recommendation_id").distinct().count() == n == recs.select("stable_id").distinct().count()
    assert recs.filter("overall_rank = 10001").first().recommendation_id == "REC-10001"
    actions = spark.createDataFrame([("REC-1000", "ACCEPTED", None, None, None, None), ("REC-10000", "REJECTED", None, None, None, None)],
                                    "recommendation_id string, status string, actioned_by string, actioned_at string, implemented_at string, notes string")
    daily = spark.createDataFrame([], "date date, warehouse_name string, estimated_cost_usd double")
    life = R.recommendation_lifecycle(recs, actions, daily, AsOf())
    assert life.count() == n and {r.status for r in life.filter("status <> 'OPEN'").collect()} == {"ACCEPTED", "REJECTED"}


def test_config_from_csv(spark, tmp_path):
    from costlens.sources import seeds
    for name in seeds.SCHEMAS:
        text = getattr(seeds, f"{name.upper()}_CSV", None) or ",".join(f.split()[0] for f in seeds.SCHEMAS[name].split(", ")) + "\n"
        (tmp_path / f"{name}.csv").write_text(text)
    read = seeds.Config.from_csv(spark, str(tmp_path))
    assert read == seeds.Config()
    assert [tuple(r) for r in read.frame(spark, "monthly_budget").collect()] == list(read.monthly_budget)
    assert read.frame(spark, "recommendation_actions").count() == 0


def test_exact_percentiles(spark):
    import numpy as np
    from costlens.plans.rank import exact_percentiles
    rng = np.random.default_rng(3)
    rows = [("a", int(v)) for v in rng.integers(0, 50, 1001)] + [("b", 7), ("c", 1), ("c", 2), ("d", None)]
    got = {r.k: (r.p50, r.p95) for r in exact_percentiles(spark.createDataFrame(rows, "k string, v long"), "k", "v", {"p50": 0.5, "p95": 0.95}).collect()}
    for k in "abc":
        values = [v for x, v in rows if x == k]
        assert got[k] == pytest.approx((np.percentile(values, 50), np.percentile(values, 95)))
    assert set(got) == {"a", "b", "c"}


def test_sources_from_files(spark, tmp_path):
    from costlens.plans.pipeline import Pipeline
    from costlens.sources import telemetry
    from costlens.sources.seeds import Config
    derived = telemetry.derive(spark, "/root/testdata/sf0.001", AsOf())
    for name, df in derived.items():
        df.write.parquet(str(tmp_path / name))
    read = telemetry.read_sources(spark, str(tmp_path))
    assert {n: d.dtypes for n, d in read.items()} == {n: d.dtypes for n, d in derived.items()}
    p, q = Pipeline(spark, read, AsOf(), Config()), Pipeline.from_testdata(spark, "/root/testdata/sf0.001", config=Config())
    assert p["daily_cost_rollup"].count() == q["daily_cost_rollup"].count() > 0
    with pytest.raises(TypeError):
        Pipeline(spark, read)  # clock and config have no default
