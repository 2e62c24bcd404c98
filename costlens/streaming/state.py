"""What the stateful streams share: the state store, times, and replays of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB store; another setting of the user's
    that extends it is left alone."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, "") or ""):
        spark.conf.set(key, STORE)


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def micros(wall_clock: Column) -> Column:
    """A wall-clock time as microseconds, the form in which state and processors hold
    times: exact, and the same whatever the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), wall_clock.cast("timestamp_ntz"))


def wall_clock(us: Column) -> Column:
    """What ``micros`` was given."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def event_time(time: Column) -> Column:
    """A wall-clock time as the timestamp that watermarks need."""
    return F.timestamp_micros(micros(time))


def run_to_end(rows: DataFrame, out: str, checkpoint: str) -> None:
    """Take all that has arrived, append the results to the folder ``out``, and
    return. Called again, it carries on behind what was taken."""
    query = (rows.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
