"""Keyed upsert into a table laid out by day, by copy-on-write of whole days (N02).

::

    <root>/data/version=N/<day column>=.../   the days that version N wrote
    <root>/manifest/v000000000N/              day, version: where each day's rows are now

A version writes the days that its updates touch, and no other: those the updates fall
on, and those that hold an older row of an updated key. Its manifest names a version for
every day of the table. Spark's commit mark on the manifest finishes the version, so a
writer that dies leaves files that no manifest names, and the next writer steps over
them. Version folders are never written twice: of two writers at once, the later fails.

Readers list the newest manifest (one row per day, whatever the number of rows), read
the folders it names, and prune days by it. A streaming writer records its name and the
epoch in the manifest, so a replayed micro-batch finds itself done and writes nothing.
Old versions are left for the storage's own retention rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlens.functions.exprs import DAY

#: Spark's folder name of a null partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
MANIFEST = f"{DAY} date, version long, stream string, epoch long"


@dataclass
class Manifest:
    """Version of each day, and the last epoch of each stream that wrote here."""

    number: int = 0
    days: dict[date | None, int] = field(default_factory=dict)
    epochs: dict[str, int] = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        return [(d, v, None, None) for d, v in self.days.items()] + [(None, None, s, e) for s, e in self.epochs.items()]


def _folders(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # the store of the folder, whichever it is
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _is_done(spark: SparkSession, path: str) -> bool:
    return "_SUCCESS" in _folders(spark, path)


def _numbers(spark: SparkSession, root: str, part: str, prefix: str) -> list[int]:
    return [int(n[len(prefix):]) for n in _folders(spark, f"{root}/{part}") if n.startswith(prefix)]


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest finished manifest; an empty one before the first load."""
    for number in sorted(_numbers(spark, root, "manifest", "v"), reverse=True):
        path = f"{root}/manifest/v{number:010d}"
        if _is_done(spark, path):
            rows = spark.read.schema(MANIFEST).parquet(path).collect()
            return Manifest(number, {r[DAY]: r["version"] for r in rows if r["stream"] is None},
                            {r["stream"]: r["epoch"] for r in rows if r["stream"] is not None})
    return Manifest()


def _read(spark: SparkSession, root: str, days: dict[date | None, int]) -> DataFrame | None:
    if not days:
        return None
    paths = [f"{root}/data/version={v}/{DAY}={NO_DAY if d is None else d}" for d, v in days.items()]
    return spark.read.option("basePath", f"{root}/data").parquet(*paths).drop("version").withColumn(DAY, F.col(DAY).cast("date"))


def read_days(spark: SparkSession, root: str, since: date | None = None, until: date | None = None) -> DataFrame | None:
    """The table, or its days from ``since`` to ``until``, both included; None where
    there is no such day. The column ``load_day`` is the day of a row."""
    days = manifest(spark, root).days
    bounded = since is not None or until is not None
    wanted = {d: v for d, v in days.items() if not bounded or d is not None and (since or d) <= d <= (until or d)}
    return _read(spark, root, wanted)


def _touched(table: DataFrame | None, latest: DataFrame, key: list[str]) -> set[date | None]:
    """Days of the updates, and of stored rows under their keys. Reads the key
    columns of the table alone, and nothing of it where there are no updates, as in the
    micro-batches that only move the watermark on."""
    days = {r[DAY] for r in latest.select(DAY).distinct().collect()}
    if table is not None and days:
        days |= {r[DAY] for r in table.select(*key, DAY).join(latest.select(*key), key, "left_semi").select(DAY).distinct().collect()}
    return days


def _dealt(rows: DataFrame, key: list[str]) -> DataFrame:
    """Days in files of even size: large days split, small ones joined. Micro-batches run
    without adaptive execution, in which the hint does nothing and every task would write
    a file of every day; there the rows are dealt by ranges of day and key."""
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", DAY)
    return rows.repartitionByRange(F.col(DAY), F.xxhash64(*key))


def upsert_days(spark: SparkSession, root: str, updates: DataFrame, key: list[str], order: list[Column], day: Column,
                stream: str | None = None, epoch: int | None = None) -> Manifest:
    """Merge ``updates`` into the table at ``root``: the first row by ``order`` of a
    key among the updates replaces what is stored under that key. ``day`` is the day a
    row belongs to. With ``stream`` and ``epoch``, an epoch that was merged before is
    a no-op. Returns the manifest in force."""
    head = manifest(spark, root)
    if stream is not None and head.epochs.get(stream, -1) >= epoch:
        return head
    w = Window.partitionBy(*key).orderBy(*order)
    latest = updates.withColumn(DAY, day.cast("date")).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn").persist()
    try:
        touched = _touched(_read(spark, root, head.days), latest, key)
        known = _numbers(spark, root, "data", "version=") + _numbers(spark, root, "manifest", "v")
        number = max(known, default=0) + 1
        old = _read(spark, root, {d: v for d, v in head.days.items() if d in touched})
        merged = latest if old is None else old.join(latest.select(*key), key, "left_anti").unionByName(latest)
        path = f"{root}/data/version={number}"
        _dealt(merged, key).write.mode("errorifexists").partitionBy(DAY).parquet(path)
    finally:
        latest.unpersist()
    names = [n.removeprefix(f"{DAY}=") for n in _folders(spark, path) if n.startswith(f"{DAY}=")]
    written = {None if n == NO_DAY else date.fromisoformat(n): number for n in names}
    new = Manifest(number, {d: v for d, v in head.days.items() if d not in touched} | written,
                   head.epochs | ({stream: epoch} if stream is not None else {}))
    spark.createDataFrame(new.rows(), MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifest/v{number:010d}")
    return new


def batch_writer(root: str, key: list[str], order: list[Column], day: Column, stream: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: every epoch of ``stream`` is merged once, however often
    it is run."""
    def write(batch: DataFrame, epoch: int) -> None:
        upsert_days(batch.sparkSession, root, batch, key, order, day, stream, epoch)
    return write
