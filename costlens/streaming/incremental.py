"""Incremental extract (N01) and keyed upsert (N02).

``upsert`` writes each merged state as the next numbered version under a table
root in the shared checkpoint folder. Spark's committer marks a finished write
with ``_SUCCESS``; a reader takes the highest marked version, so there is no
pointer to lose: a writer that dies leaves a version without the mark, which
nobody reads and the next writer steps over. A version folder is never written
twice, so of two writers at once the later one fails instead of dropping the
other's rows. Versions below the newest are left for the storage's own retention
rules. Each call rewrites the table, which suits small ones; large histories go to
``daily.upsert_days``, which writes the touched days alone, and the streaming load
(``load_new_files``) merges its micro-batches there.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlens.session import checkpoint_root
from costlens.streaming import daily
from costlens.streaming.state import event_time


def incremental_extract(source: DataFrame, target: DataFrame | None, ts: str = "end_time") -> DataFrame:
    """Rows newer than the target's high-water mark (all rows on first load).
    The mark is a scalar subquery, so the comparison is a plain filter and there is
    no join. As in the model, a late row with an older timestamp is not picked up."""
    if target is None:
        return source
    mark = target.agg(F.max(ts)).scalar()
    return source.filter(mark.isNull() | (F.col(ts) > mark))


def merge(target: DataFrame | None, updates: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """New row wins: the latest update per key, plus target rows whose key
    is not updated (left anti join)."""
    w = Window.partitionBy(*key).orderBy(*order)
    latest = updates.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if target is None:
        return latest
    keep = target.join(latest.select(*key), key, "left_anti")
    return keep.unionByName(latest)


def table_root(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), "tables", name)


def versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(number, finished) of the versions under ``root``, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)  # the store of the folder, whichever it is
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v") and name[1:].isdigit():
            mark = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            found.append((int(name[1:]), fs.exists(mark)))
    return sorted(found)


def _folder(root: str, number: int) -> str:
    return os.path.join(root, f"v{number:010d}")


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest finished version; None before the first load. A root with
    versions of which none is finished is an error, not a first load."""
    found = versions(spark, root)
    done = [n for n, finished in found if finished]
    if not done:
        if len(found) > 1:
            raise ValueError(f"no finished version under {root}")
        return None
    return spark.read.parquet(_folder(root, done[-1]))


def upsert(spark: SparkSession, root: str, updates: DataFrame, key: list[str], order: list[Column],
           partition: list[str] | None = None) -> DataFrame:
    """Merge ``updates`` into the table at ``root`` as its next version, laid out by
    the columns ``partition`` where given."""
    found = versions(spark, root)
    path = _folder(root, found[-1][0] + 1 if found else 1)
    merged = merge(read_current(spark, root), updates, key, order)
    writer = merged.write.mode("errorifexists")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    return spark.read.parquet(path)


def stream_extract(spark: SparkSession, path: str, schema, ts: str = "end_time", key: str = "query_id",
                   lateness: str = "3 hours") -> DataFrame:
    """Streaming variant of N01: new files of the source folder, late rows kept
    up to ``lateness`` and duplicates of a key dropped inside the watermark."""
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    return (rows.withColumn("_event_time", event_time(F.col(ts)))
            .withWatermark("_event_time", lateness)
            .dropDuplicatesWithinWatermark([key]).drop("_event_time"))


def load_new_files(spark: SparkSession, path: str, schema, root: str, checkpoint: str, order: list[Column],
                   ts: str = "end_time", key: str = "query_id", lateness: str = "3 hours") -> None:
    """Load what has come to the folder ``path`` since the last call into the daily
    table at ``root``, and return. The file source's log in ``checkpoint`` takes each
    file once, and the table's manifest keeps the last epoch, so a run that dies at any
    point is carried on by the next one without loss and without doubling."""
    write = daily.batch_writer(root, [key], order, F.to_date(ts), stream=checkpoint)
    query = (stream_extract(spark, path, schema, ts, key, lateness).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
