"""Sinks: full-refresh table, view, keyed merge, CSV and JSON exports.

Paths are folders under the shared checkpoint/output root; Spark writes one
file per task, never through the driver.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame

from costlens.streaming.incremental import table_root, upsert


def layer_path(root: str, layer: str, name: str) -> str:
    """``<root>/<layer>/<name>``: the layer takes the place of the schema."""
    return os.path.join(root, layer, name)


def sink_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def sink_merge(df: DataFrame, name: str, key: list[str], order: list[Column]) -> DataFrame:
    return upsert(df.sparkSession, table_root(df.sparkSession, name), df, key, order)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
