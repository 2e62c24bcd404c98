"""The history of a pipeline sent through the streams in several loads.

Each replay writes the loads to a new folder of the shared storage, one after another,
and runs its stream after every load as a scheduled job would, so that files, state,
watermark and epochs are carried from one run to the next."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf
from costlens.operators import alerts
from costlens.session import checkpoint_root
from costlens.streaming import daily, episodes, idle, incremental
from costlens.streaming.state import run_to_end

#: The loads of the query history end so many days before the run.
LOAD_DAYS = (14, 7)
#: Rows that come after the watermark has passed them, and rows that come late within it.
TOO_LATE, IN_TIME = "k % 7 = 0 AND end_time < first_load - INTERVAL 10 DAYS", "k % 5 = 0 AND end_time >= second_load - INTERVAL 1 HOURS"


def _folder(df: DataFrame, name: str) -> str:
    return f"{checkpoint_root(df.sparkSession)}/streams/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder and read back. A replay uses its alerts in every run
    and in several jobs of a run; each of them would work out all detectors anew."""
    path = _folder(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_first() -> list[Column]:
    return [F.col("end_time").desc(), F.col("_loaded_at").desc()]


def query_loads(history: DataFrame, as_of: AsOf) -> list[DataFrame]:
    """Three loads of the query history by end time. The second sends rows of the first
    load's last hour again and some of its own twice, and keeps back some of its last
    hour; the third brings those, and rows that are ten days too late."""
    first, second = (f"TIMESTAMP_NTZ '{as_of.ts}' - INTERVAL {d} DAYS" for d in LOAD_DAYS)
    rows = history.withColumns({"k": F.expr("CAST(substr(query_id, 2) AS BIGINT)"), "first_load": F.expr(first), "second_load": F.expr(second)})
    rows = rows.withColumn("load", F.expr(
        f"CASE WHEN end_time < first_load THEN IF({TOO_LATE}, 3, 1) WHEN end_time < second_load THEN IF({IN_TIME}, 3, 2) ELSE 3 END"))
    again = rows.filter("load = 1 AND end_time >= first_load - INTERVAL 1 HOURS OR load = 2 AND k % 3 = 0")
    loads = [rows.filter("load = 1"), rows.filter("load = 2").unionByName(again), rows.filter("load = 3")]
    return [x.select(history.columns) for x in loads]


def load_history(history: DataFrame, as_of: AsOf) -> tuple[str, list[daily.Manifest]]:
    """The loads through the file stream into a daily table: its root, and the
    manifest after each load."""
    spark, base = history.sparkSession, _folder(history, "query-history")
    states = []
    for n, load in enumerate(query_loads(history, as_of)):
        load.write.parquet(f"{base}/files/load-{n}")
        incremental.load_new_files(spark, f"{base}/files", history.schema, f"{base}/table", f"{base}/checkpoint", latest_first())
        states.append(daily.manifest(spark, f"{base}/table"))
    return f"{base}/table", states


def loaded_history(history: DataFrame, as_of: AsOf) -> DataFrame:
    root, _ = load_history(history, as_of)
    return daily.read_days(history.sparkSession, root).select(history.columns)


def upserted_days(history: DataFrame, first: DataFrame) -> DataFrame:
    """Two upserts into a new daily table, read back."""
    spark, root = history.sparkSession, _folder(history, "daily")
    daily.upsert_days(spark, root, first, ["query_id"], latest_first(), F.to_date("end_time"))
    more = incremental.incremental_extract(history, daily.read_days(spark, root))
    daily.upsert_days(spark, root, more, ["query_id"], latest_first(), F.to_date("end_time"))
    return daily.read_days(spark, root).select(history.columns)


def episodes_of_last_run(runs: list[tuple[DataFrame, AsOf | Column]]) -> DataFrame:
    """The episodes that the newest of ``runs`` (alerts and the time they were
    evaluated) gives with the state that those before have left."""
    spark, base = runs[0][0].sparkSession, _folder(runs[0][0], "episodes")
    for n, (found, now) in enumerate(runs):
        found = found.withColumn("evaluated_at", now)
        found.write.parquet(f"{base}/alerts/run-{n}")
        files = spark.readStream.schema(found.schema).option("recursiveFileLookup", "true").parquet(f"{base}/alerts")
        run_to_end(episodes.episode_stream(files, F.col("evaluated_at")), f"{base}/out", f"{base}/checkpoint")
    out = spark.read.schema(episodes.OUT_SCHEMA).parquet(f"{base}/out")
    return out.filter(F.col("evaluated_at") == runs[-1][1])


def closed_islands(utilisation: DataFrame, loads: int = 3) -> DataFrame:
    """The idle islands of a history, its intervals sent by days in ``loads`` loads, some
    of them a load late within the watermark. Two busy intervals per warehouse after the
    end close what is open and bring the watermark past it."""
    spark, base = utilisation.sparkSession, _folder(utilisation, "idle")
    rows = utilisation.select("warehouse_name", "interval_start", "interval_end", "is_idle")
    span = rows.agg(F.min("interval_start").alias("low"), F.max("interval_start").alias("high")).first()
    if span.low is None:
        return spark.createDataFrame([], idle.OUT_SCHEMA)
    step = (span.high - span.low) / loads
    place = sum((F.when(F.col("interval_start") >= F.lit(span.low + step * n), 1).otherwise(0) for n in range(1, loads)), F.lit(0))
    # of the last half hour of a load, the busy intervals come with the next one
    late = sum((F.when(~F.col("is_idle") & F.col("interval_start").between(F.lit(span.low + step * n) - F.expr("INTERVAL 30 MINUTES"), F.lit(span.low + step * n) - F.expr("INTERVAL 1 SECONDS")), 1).otherwise(0) for n in range(1, loads)), F.lit(0))
    rows = rows.withColumn("load", place + late)
    names = rows.select("warehouse_name").distinct()
    ends = [names.select("warehouse_name", (F.lit(span.high) + F.expr(f"INTERVAL {d} DAYS")).alias("interval_start"),
                         (F.lit(span.high) + F.expr(f"INTERVAL {d} DAYS")).alias("interval_end"), F.lit(False).alias("is_idle")) for d in (1, 3)]
    parts = [rows.filter(F.col("load") == n).drop("load") for n in range(loads)]
    for n, part in enumerate([*parts, *ends]):
        part.write.parquet(f"{base}/intervals/load-{n}")
        files = spark.readStream.schema(part.schema).option("recursiveFileLookup", "true").parquet(f"{base}/intervals")
        run_to_end(idle.idle_stream(files), f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(idle.OUT_SCHEMA).parquet(f"{base}/out")


def answers(keys: DataFrame, attempt: int) -> DataFrame:
    """Stand-ins for the answers of the message service, by the key's hash: at the
    first attempt 200, 202, 429 and failed calls, later on 202 alone."""
    digit = F.substring(F.md5("alert_episode_key"), 1, 1)
    code = F.when(digit < "4", 200).when(digit < "8", 202).when(digit < "c", 429) if attempt == 1 else F.lit(202)
    return keys.select("alert_episode_key", code.alias("response_code"))


def delivered(payload: DataFrame, as_of: AsOf) -> DataFrame:
    """Two rounds of delivery through one outbox: a run two hours before this one sends
    what was detected by then, and this run, its payload built anew, the rest and what
    has failed. Returns the outbox with the number of unsent messages of the first run
    that were queued again."""
    spark, root = payload.sparkSession, _folder(payload, "outbox")
    payload = written_once(payload.select("alert_episode_key", "detected_at"), "outbox-payload")
    then = F.expr(as_of.ts_sql()) - F.expr("INTERVAL 2 HOURS")
    newest = [F.col("attempts").desc()]
    box, again = None, None
    for attempt, (messages, at) in enumerate([(payload.filter(F.col("detected_at") < then), then), (payload, as_of.ts_col())], 1):
        queue = written_once(alerts.outbox_queue(messages, box), "outbox-queue")
        if box is not None:
            again = box.join(queue, "alert_episode_key", "left_semi").agg(F.count(F.lit(1)).alias("queued_again"))
        changes = alerts.outbox_update(queue, box, answers(queue, attempt), at)
        incremental.upsert(spark, root, changes, ["alert_episode_key"], newest)
        box = incremental.read_current(spark, root)
    return box.crossJoin(F.broadcast(again))
