"""Streams and daily tables: replays against the batch models, what is written where,
and what happens when a step is run twice or dies."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf
from costlens.operators import alerts as AL
from costlens.operators import storage as S
from costlens.operators import warehouse as W
from costlens.plans.pipeline import Pipeline
from costlens.streaming import daily, replays

SF = "/root/testdata/sf0.001"
ROW = "k long, v string, ts timestamp_ntz"


def newest():
    return [F.col("ts").desc(), F.col("v")]


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def put(spark, root, rows, **kw):
    return daily.upsert_days(spark, root, spark.createDataFrame(rows, ROW), ["k"], newest(), F.to_date("ts"), **kw)


def table(spark, root, **kw):
    found = daily.read_days(spark, root, **kw)
    return None if found is None else sorted((r.k, r.v, r.load_day) for r in found.collect())


def test_upsert_writes_only_the_touched_days(spark, tmp_path):
    root = str(tmp_path / "t")
    assert daily.read_days(spark, root) is None
    put(spark, root, [(1, "a", day(1)), (2, "b", day(2)), (3, "c", day(3)), (3, "old", day(3)), (4, "d", None)])
    first = {f for f in daily.read_days(spark, root).inputFiles()}
    got = put(spark, root, [(2, "B", day(2, 5)), (5, "e", day(5))])
    assert got.days == {date(2024, 1, 1): 1, date(2024, 1, 2): 2, date(2024, 1, 3): 1, date(2024, 1, 5): 2, None: 1}
    kept = {f for f in daily.read_days(spark, root).inputFiles() if "version=1" in f}
    assert kept == {f for f in first if "load_day=2024-01-02" not in f}
    assert sorted(p.name for p in (tmp_path / "t/data/version=2").iterdir() if p.is_dir()) == ["load_day=2024-01-02", "load_day=2024-01-05"]
    assert table(spark, root) == [(1, "a", date(2024, 1, 1)), (2, "B", date(2024, 1, 2)), (3, "c", date(2024, 1, 3)), (4, "d", None), (5, "e", date(2024, 1, 5))]
    assert table(spark, root, since=date(2024, 1, 3)) == [(3, "c", date(2024, 1, 3)), (5, "e", date(2024, 1, 5))]
    assert len(daily.read_days(spark, root, until=date(2024, 1, 1)).inputFiles()) == 1


def test_a_row_that_moves_to_another_day(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, [(1, "a", day(1)), (2, "b", day(2))])
    got = put(spark, root, [(1, "moved", day(2))])
    assert got.days == {date(2024, 1, 2): 2}  # the first day has no rows left
    assert [r[:2] for r in table(spark, root)] == [(1, "moved"), (2, "b")]


def test_replayed_epochs_and_dead_writers(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, [(1, "a", day(1))], stream="s", epoch=0)
    again = put(spark, root, [(1, "WRONG", day(1, 9))], stream="s", epoch=0)
    assert again.number == 1 and [r[:2] for r in table(spark, root)] == [(1, "a")]
    other = put(spark, root, [(2, "b", day(1))], stream="another", epoch=0)
    assert other.epochs == {"s": 0, "another": 0}
    # a writer that died after its data, and one that died in its manifest
    (tmp_path / "t/data/version=3/load_day=2024-01-01").mkdir(parents=True)
    (tmp_path / "t/manifest/v0000000004").mkdir()
    assert [r[:2] for r in table(spark, root)] == [(1, "a"), (2, "b")]
    assert put(spark, root, [(3, "c", day(1))], stream="s", epoch=1).number == 5
    assert [r[:2] for r in table(spark, root)] == [(1, "a"), (2, "b"), (3, "c")]


def test_empty_updates_leave_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, [(1, "a", day(1))])
    daily.upsert_days(spark, root, spark.createDataFrame([], ROW), ["k"], newest(), F.to_date("ts"))
    assert [r[:2] for r in table(spark, root)] == [(1, "a")]


def test_history_through_the_file_stream(spark):
    p = Pipeline.from_testdata(spark, SF)
    history = p["stg_query_history"]
    loads = [x.count() for x in replays.query_loads(history, p.as_of)]
    root, states = replays.load_history(history, p.as_of)
    got = daily.read_days(spark, root)
    late = history.filter("CAST(substr(query_id, 2) AS BIGINT) % 7 = 0").filter(F.col("end_time") < F.expr("TIMESTAMP_NTZ '2024-01-07 00:00:00'"))
    assert late.count() > 0 and min(loads) > 0 and sum(loads) > history.count()
    assert got.count() == got.select("query_id").distinct().count() == history.count() - late.count()
    assert got.join(late, "query_id", "left_semi").count() == 0
    first = {d for d, v in states[0].days.items() if v == states[0].number}
    assert all(states[2].days[d] == states[0].number for d in first if d < date(2024, 1, 16))  # later loads leave them
    assert states[0].epochs != states[2].epochs


ALERTS = "alert_id string, detected_at timestamp_ntz, resource_key string, metric_value double, threshold_value double, details_json string"


def test_episodes_carry_state_and_expire(spark):
    t = datetime(2024, 1, 30, 22)
    runs = [
        [("x", t, "r1", 1.0, 0.5, "{}"), ("x", t - timedelta(hours=9), "r2", 1.0, 0.5, "{}"), ("x", t, None, 1.0, 0.5, "{}"), ("y", t, "r1", None, None, None)],
        [("x", t + timedelta(hours=5), "r1", 2.0, 0.5, "b"), ("x", t + timedelta(hours=5), "r1", 2.0, 0.5, "a"), ("x", t + timedelta(hours=5), "r2", 2.0, 0.5, "{}")],
        [("x", t + timedelta(days=2), "r1", 2.0, 0.5, "{}")],
    ]
    clocks = ["2024-01-31 00:00:00", "2024-01-31 04:00:00", "2024-02-02 00:00:00"]
    frames = [(spark.createDataFrame(r, ALERTS), AsOf(c).ts_col()) for r, c in zip(runs, clocks)]
    second = {r.resource_key: r for r in replays.episodes_of_last_run(frames[:2]).collect()}
    batch = AL.alert_state_tracker(frames[1][0], AL.alert_state_tracker(frames[0][0], None, AsOf(clocks[0])), AsOf(clocks[1]))
    assert {k: (r.episode_number, r.is_new_episode, r.details_json, r.alert_episode_key) for k, r in second.items()} == {
        r.resource_key: (r.episode_number, r.is_new_episode, r.details_json, r.alert_episode_key) for r in batch.collect()}
    assert second["r1"].details_json == "a" and second["r2"].episode_number == 2
    third = replays.episodes_of_last_run(frames).collect()
    assert [(r.resource_key, r.episode_number, r.is_new_episode) for r in third] == [("r1", 2, True)]


def test_idle_islands_as_they_close(spark):
    t0 = datetime(2024, 1, 10)

    def rows(name, states, step=5):
        return [(name, t0 + timedelta(minutes=step * i), t0 + timedelta(minutes=step * i + 5), s) for i, s in enumerate(states) if s is not None]

    idle, busy, gap = True, False, None
    data = rows("A", [idle, idle, busy, idle, gap, gap, idle, busy, busy, idle]) + rows("B", [busy] + [idle] * 400)
    data += [("C", t0, t0 + timedelta(minutes=5), idle), ("C", t0, t0 + timedelta(minutes=7), busy), (None, t0, None, idle)]
    util = spark.createDataFrame(data, "warehouse_name string, interval_start timestamp_ntz, interval_end timestamp_ntz, is_idle boolean")
    got = sorted(map(repr, replays.closed_islands(util).collect()))
    want = W.idle_islands(util.filter("warehouse_name IS NOT NULL")).select("warehouse_name", "idle_start", "idle_end").collect()
    assert [g for g in got if "None" not in g] == sorted(map(repr, want)) and len(got) == len(want) + 1
    assert replays.closed_islands(util.limit(0)).count() == 0


def test_access_history_as_json(spark):
    texts = ['[{"objectName": "D.s.t1"}, {"objectName": "D.s.t2", "columns": [1]}]', "[]", None, "not json", '[{"other": 1}, "text", null]', '[{"objectName": "D.s.t1"}]']
    data = [(datetime(2024, 1, 1 + i), x) for i, x in enumerate(texts)]
    got = {r.full_table_name: r.last_read_date for r in S.last_access(spark.createDataFrame(data, "query_start_time timestamp_ntz, base_objects_accessed string")).collect()}
    assert got == {"D.s.t1": datetime(2024, 1, 6), "D.s.t2": datetime(2024, 1, 1)}


@pytest.mark.parametrize("form", ["rows", "structs", "json"])
def test_storage_breakdown_of_each_form(spark, form):
    p = Pipeline.from_testdata(spark, SF)
    if form == "structs":
        del p.raw["access_reads"]
    key = "storage_breakdown_json" if form == "json" else "storage_breakdown"
    got = {(r.database_name, r.schema_name, r.table_name): r.last_read_date for r in p[key].collect()}
    want = {r.o: r.t for r in p["stg_access_history"].select(F.explode("base_objects_accessed.objectName").alias("o"), F.col("query_start_time").alias("t"))
            .groupBy("o").agg(F.max("t").alias("t")).collect()}
    assert got and all(t == want.get(".".join(k)) for k, t in got.items())
