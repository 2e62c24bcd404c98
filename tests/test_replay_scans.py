"""A replay works its alerts out once, however many runs and jobs use them."""

from concurrent.futures import Future

from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf
from costlens.operators import alerts
from costlens.plans.models import _earlier_clock
from costlens.plans.pipeline import Pipeline
from costlens.streaming import replays

ROWS = [("a", "2024-01-29 10:00:00"), ("b", "2024-01-29 11:00:00"), ("b", "2024-01-30 00:00:00"), ("c", "2024-01-30 23:59:00"), (None, "2024-01-29 09:00:00"), ("d", None)]


def _counted(spark, df):
    """``df`` with an accumulator of the rows that were worked out."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(count, df.schema), seen


def test_outbox_reads_its_payload_once(spark):
    rows = spark.createDataFrame(ROWS, "alert_episode_key string, at string").select("alert_episode_key", F.col("at").cast("timestamp_ntz").alias("detected_at"))
    payload, seen = _counted(spark, rows.withColumn("teams_payload_json", F.lit("{}")))
    box = replays.delivered(payload, AsOf("2024-01-31 00:00:00")).collect()
    assert {r.alert_episode_key for r in box} == {"a", "b", "c", "d"} and len(box) == 4
    assert all(r.attempts in (1, 2) and r.queued_again is not None for r in box)
    assert seen.value == len(ROWS)


def test_episode_stream_reads_its_alerts_once(spark):
    p = Pipeline.from_testdata(spark, "/root/testdata/sf0.001")
    plain = p["alert_union"].localCheckpoint()
    union, seen = _counted(spark, plain)
    p._models["alert_union"] = Future()
    p._models["alert_union"].set_result(union)
    got = sorted(map(repr, p["episode_stream"].collect()))
    assert seen.value == plain.count() > 0
    runs = [(plain.filter((F.col("detected_at") < _earlier_clock(p)) & F.col("resource_key").isNotNull()), _earlier_clock(p)), (plain, p.as_of.ts_col())]
    assert got == sorted(map(repr, alerts.one_per_episode(replays.episodes_of_last_run(runs)).collect()))
