"""Helpers shared by the training-data operators.

``shared_root`` is the folder that driver and executors both see; ``cut`` ends a
lineage by writing a table there, so a lost executor costs a re-read and not a
recomputation of everything before it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"

_LOCAL_ROOTS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Unset, a scratch folder serves
    sessions whose tasks run inside the driver; any other session is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _LOCAL_ROOTS[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch of the jobs run inside. A batch lies in the
    JVM and in the worker at once, beside the heap, so whole texts take smaller ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")
