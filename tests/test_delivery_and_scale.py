"""Outbox, suppressions, sketches, top rows, pruning, sinks, and checks that must fail."""

import json
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf
from costlens.operators import alerts as AL
from costlens.operators import quality as Q
from costlens.operators import sketches as SK
from costlens.operators import workload as WL
from costlens.plans import rank
from costlens.plans.pipeline import Pipeline
from costlens.sources import sinks
from costlens.streaming import daily

SF = "/root/testdata/sf0.001"
ALERTS = "alert_id string, detected_at timestamp_ntz, resource_key string, metric_value double, threshold_value double, details_json string"
RULES = "alert_id string, resource_value string, suppression_reason string, start_date date, end_date date"


@pytest.fixture(scope="module")
def p(spark):
    return Pipeline.from_testdata(spark, SF)


def plan(df):
    return df._jdf.queryExecution().toString()


# --- delivery ----------------------------------------------------------------

def test_outbox_over_two_rounds(spark):
    now = [AsOf("2024-01-31 00:00:00").ts_col(), AsOf("2024-01-31 02:00:00").ts_col()]
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "alert_episode_key string")
    codes = lambda *c: spark.createDataFrame(c, "alert_episode_key string, response_code int")
    queue = AL.outbox_queue(keys("a", "b", "c", "d", "a", None), None)
    assert sorted(r[0] for r in queue.collect()) == ["a", "b", "c", "d"]
    box = AL.outbox_update(queue, None, codes(("a", 202), ("b", None), ("c", 429), ("zz", 200)), now[0])
    got = {r.alert_episode_key: r for r in box.collect()}
    assert set(got) == {"a", "b", "c"}  # d was not tried
    assert (got["a"].send_success, got["b"].api_response_code, got["b"].sent_at, got["c"].send_success, got["c"].sent_at is None) == (True, -1, None, False, False)
    again = AL.outbox_queue(keys("a", "b", "c", "d", "e"), box)
    assert sorted(r[0] for r in again.collect()) == ["b", "d", "e"]
    second = {r.alert_episode_key: r.attempts for r in AL.outbox_update(again, box, codes(("b", 202), ("d", 202), ("e", None)), now[1]).collect()}
    assert second == {"b": 2, "d": 1, "e": 1}


def test_outbox_status_reaches_the_payload(spark, p):
    payload = p["alert_payload"].filter("alert_episode_key IS NOT NULL")  # without a key there is no telling what was sent
    before = AL.unsent_payloads(payload).count()
    after = AL.unsent_payloads(AL.with_delivery(payload, p["alert_outbox"])).count()
    assert before > 0 and after == 0


# --- suppressions --------------------------------------------------------------

def test_suppressions_by_month_equal_the_interval_join(spark):
    rng = np.random.default_rng(4)
    day = date(2023, 11, 1)
    alerts = [(f"a{rng.integers(3)}", None if i % 17 == 0 else datetime(2023, 11, 1) + timedelta(hours=int(rng.integers(4000))), None if i % 11 == 0 else f"r{rng.integers(4)}", 1.0, 1.0, str(i)) for i in range(500)]
    rules = [(f"a{rng.integers(3)}", f"r{rng.integers(4)}", "x", day + timedelta(days=int(s)), day + timedelta(days=int(s + n))) for s, n in zip(rng.integers(0, 150, 40), rng.integers(-2, 12, 40))]
    rules += [("a0", "r0", "open", date(2024, 3, 1), date(9999, 12, 31)), ("a1", "r1", "none", None, date(2024, 1, 1))]
    got = {r.details_json for r in AL.not_suppressed(spark.createDataFrame(alerts, ALERTS), spark.createDataFrame(rules, RULES)).collect()}
    hit = lambda a: any(a[1] and r[0] == a[0] and r[1] == a[2] and r[3] and r[3] <= a[1].date() <= r[4] for r in rules)
    assert got == {a[5] for a in alerts if not hit(a)} and 0 < len(got) < 500


def test_many_suppressions_need_no_nested_loop(spark):
    alerts = spark.range(2000).selectExpr("'a' AS alert_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 2000) AS detected_at", "'hot' AS resource_key",
                                          "1.0D AS metric_value", "1.0D AS threshold_value", "CAST(id AS STRING) AS details_json")
    rules = spark.range(100_000).selectExpr("'a' AS alert_id", "IF(id % 1000 = 0, 'hot', 'r' || id) AS resource_value", "'x' AS suppression_reason",
                                            "DATE '2024-01-10' + CAST(id % 7 AS INT) AS start_date", "DATE '2024-01-12' + CAST(id % 7 AS INT) AS end_date")
    left = AL.not_suppressed(alerts, rules)
    assert "NestedLoop" not in plan(left) and "Cartesian" not in plan(left)
    assert left.count() == 2000 - 24 * 9  # the days 10 to 18


# --- sketches and top rows -------------------------------------------------------

def test_latency_sketches_merge_within_the_bound(spark):
    rng = np.random.default_rng(5)
    rows = [("A", datetime(2024, 1, 1 + i % 20), int(v)) for i, v in enumerate(rng.lognormal(8, 2, 30_000))] + [("B", datetime(2024, 1, 1), 7), ("C", datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "warehouse_name string, start_time timestamp_ntz, execution_time_ms long")
    days = SK.latency_days(df)
    assert days.count() == 21
    got = {r.warehouse_name: r for r in SK.latency_percentiles(days).collect()}
    values = np.sort([r[2] for r in rows if r[0] == "A"])
    for name, r in SK.RANKS.items():
        assert abs(np.searchsorted(values, got["A"][name]) / len(values) - r) < SK.RANK_BOUND
    assert got["B"].p99_exec_ms == 7 and set(got) == {"A", "B"}
    bounds = SK.latency_bounds(df, SK.latency_percentiles(days)).collect()
    assert all(r.p50_within and r.p95_within and r.p99_within for r in bounds)
    wrong = SK.latency_percentiles(days).withColumn("p95_exec_ms", F.col("p50_exec_ms"))
    assert not SK.latency_bounds(df, wrong).filter("warehouse_name = 'A'").first().p95_within


def test_distinct_users_of_a_month_are_no_sum(spark, p):
    q = Pipeline(spark, p.raw, p.as_of, p.config, options={"distinct_users": True, "sketched_percentiles": True})
    plain, both = p["team_cost_dashboard"], q["team_cost_dashboard"]
    assert set(both.columns) - set(plain.columns) == {"distinct_users"}
    rows = both.collect()
    assert all(r.distinct_users <= r.unique_users for r in rows) and any(r.distinct_users < r.unique_users for r in rows)
    assert all(r.within for r in p["team_user_sketch_bounds"].collect())
    assert {r.warehouse_name for r in q["warehouse_sizing_analysis"].collect()} == {r.warehouse_name for r in p["warehouse_sizing_analysis"].collect()}


@pytest.mark.parametrize("k", [1, 50, 700, 1990, 5000])
def test_top_rows_are_those_of_a_sort(spark, k):
    df = spark.range(2000).selectExpr("id", "CASE WHEN id % 9 = 0 THEN NULL ELSE CAST(hash(id) % 40 AS DOUBLE) END AS v")
    got = sorted(r.id for r in rank.top_rows(df, "v", [F.col("id")], k).collect())
    want = sorted(r.id for r in df.orderBy(F.col("v").desc_nulls_last(), "id").limit(k).collect())
    assert got == want


def test_the_signal_cut_is_reached(spark, p):
    t = p.star()
    for shape, value in ((WL.demand_signals, "z_score"), (WL.burst_volatility, "volatility_30day")):
        every = shape(t, top=10**9)
        order = [F.col(value).desc_nulls_last(), *WL._line_order()]
        got = shape(t, top=200)
        assert every.count() > 300 and "TakeOrdered" not in plan(got) and "GlobalLimit" not in plan(got)
        key = lambda df: sorted((r.l_orderkey, r.l_linenumber) for r in df.collect())
        assert key(got) == key(every.orderBy(*order).limit(200))


def test_percentiles_and_ranks_have_no_window_per_key(spark):
    df = spark.range(1000).selectExpr("'hot' AS k", "id AS v")
    text = plan(rank.exact_percentiles(df, "k", "v", {"p50": 0.5}))
    assert "partitionBy=[k]" not in text.replace(" ", "") and rank.exact_percentiles(df, "k", "v", {"p50": 0.5}).first().p50 == 499.5


# --- tables laid out by day --------------------------------------------------------

def test_alerts_read_recent_days_alone(spark, p, tmp_path):
    root = str(tmp_path / "history")
    daily.upsert_days(spark, root, p["stg_query_history"].drop("_loaded_at"), ["query_id"], [F.col("end_time")], F.to_date("end_time"))
    laid = Pipeline(spark, p.raw | {"query_history": daily.read_days(spark, root)}, p.as_of, p.config)
    for key, days in (("alert_query_spill", 2), ("alert_query_long_running", 8)):
        df = laid[key]
        assert "PartitionFilters: [isnotnull(load_day" in plan(df)
        assert sorted(map(repr, df.collect())) == sorted(map(repr, p[key].collect()))
        scan = [x for x in plan(df).split("\\n") if "load_day" in x and "PartitionFilters" in x]
        assert scan
        recent = daily.read_days(spark, root, since=date(2024, 1, 31) - timedelta(days=days))
        assert 0 < len(recent.inputFiles()) < len(daily.read_days(spark, root).inputFiles()) / 5


# --- sinks ---------------------------------------------------------------------------

def test_sinks_round_trip(spark, tmp_path):
    rows = [(1, 'a "quoted", text', 1.5, date(2024, 1, 1)), (2, None, None, date(2024, 1, 2)), (3, "zwei\\tTabs", -0.25, date(2024, 1, 2))]
    schema = "id int, text string, usd double, day date"
    df = spark.createDataFrame(rows, schema)
    same = lambda back: sorted(map(tuple, back.select("id", "text", "usd", "day").collect())) == rows
    at = lambda name: str(tmp_path / name)
    sinks.sink_table(df, at("t"), ["day"])
    assert same(spark.read.parquet(at("t"))) and (tmp_path / "t/day=2024-01-02").is_dir()
    sinks.sink_table(df.limit(1), at("t"))
    assert spark.read.parquet(at("t")).count() == 1  # a full refresh
    sinks.sink_view(df, "sink_rows")
    assert spark.sql("SELECT count(*) AS n FROM sink_rows WHERE usd IS NULL").first().n == 1
    sinks.export_csv(df, at("c"))
    assert same(spark.read.schema(schema).option("header", True).option("escape", "\\").csv(at("c")))
    sinks.export_json(df, at("j"))
    assert same(spark.read.schema(schema).json(at("j")))
    name = f"merge-{tmp_path.name}"
    sinks.sink_merge(df, name, ["id"], [F.col("day").desc()])
    merged = sinks.sink_merge(spark.createDataFrame([(2, "new", 2.0, date(2024, 1, 3))], schema), name, ["id"], [F.col("day").desc()])
    assert sorted((r.id, r.text) for r in merged.collect()) == [(1, 'a "quoted", text'), (2, "new"), (3, "zwei\\tTabs")]
    assert sinks.layer_path("r", "l", "n") == "r/l/n"


def test_cards_are_json_with_their_facts(spark, p):
    cards = p["alert_payload"].collect()
    facts = p["alert_payload_facts"].groupBy("alert_episode_key").count().collect()
    count = {r.alert_episode_key: r["count"] for r in facts}
    for r in cards:
        body = json.loads(r.teams_payload_json)["attachments"][0]["content"]["body"]
        assert [b["type"] for b in body] == ["TextBlock", "TextBlock", "FactSet", "TextBlock", "FactSet"]
        assert sum(len(b["facts"]) for b in body if b["type"] == "FactSet") == count[r.alert_episode_key]


# --- checks that must be able to fail ----------------------------------------------------

def test_every_singular_check_fails_on_bad_rows(spark):
    now = AsOf("2024-01-31 00:00:00")
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    d = date(2024, 1, 1)
    bad = {
        "rollup_components": (Q.rollup_components(one([(d, 10.0, 5.0, 2.0, 1.0), (d, 8.0, 5.0, 2.0, 1.005)], "date date, total_cost double, compute_cost double, storage_cost double, serverless_cost double")), 1),
        "efficiency_range": (Q.efficiency_range(one([("a", -0.1), ("b", 100.5), ("c", 100.0), ("d", 0.0)], "warehouse_name string, efficiency_score double")), 2),
        "forecast_future": (Q.forecast_future(one([(date(2024, 1, 31),), (date(2024, 2, 1),)], "forecast_date date"), now), 1),
        "forecast_positive": (Q.forecast_positive(one([(-0.01,), (0.0,)], "predicted_total_cost double")), 1),
        "freshness_sources": (Q.freshness_sources(one([("a",), ("b",), ("b",)], "source_name string")), 1),
        "no_duplicate_recs": (Q.no_duplicate_recs(one([("R1",), ("R1",), ("R2",)], "recommendation_id string")), 1),
        "no_future_dates": (Q.no_future_dates(one([(datetime(2024, 1, 31, 1, 1),), (datetime(2024, 1, 31, 1),)], "end_time timestamp_ntz"), now), 1),
        "seasonality_days": (Q.seasonality_days(one([(d,), (d,)], "date date")), 1),
        "team_sum": (Q.team_sum(one([(98.0,)], "compute_cost double"), one([(100.0,)], "estimated_cost_usd double")), 1),
        "warehouse_metered": (Q.warehouse_metered(one([("A",), ("B",)], "warehouse_name string"), one([("A",)], "warehouse_name string")), 1),
    }
    assert {k: df.count() for k, (df, _) in bad.items()} == {k: n for k, (_, n) in bad.items()}
    good = Q.team_sum(one([(99.5,)], "compute_cost double"), one([(100.0,)], "estimated_cost_usd double"))
    assert good.count() == 0


def test_aligned_forecast(spark, p):
    costs = spark.createDataFrame([("t", date(2024, m, 1), 100.0 * m) for m in (1, 2, 3)], "team_name string, month date, total_cost double")
    from costlens.operators.forecast import team_cost_forecast
    got = {a: [(r.forecast_month, r.projected_offset, round(r.predicted_monthly_cost, 6)) for r in sorted(team_cost_forecast(spark, costs, AsOf(), aligned=a).collect(), key=lambda r: r.forecast_month)] for a in (False, True)}
    assert got[True] == [(date(2024, 4, 1), 3, 400.0), (date(2024, 5, 1), 4, 500.0), (date(2024, 6, 1), 5, 600.0)]
    assert got[False][0] == (date(2024, 4, 1), 4, 500.0)
