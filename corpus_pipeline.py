"""The corpus pipeline: five stages, each writing its result for the next.

A stage gets (spark, docs, sf_dir) and works on every row its predecessor kept. All
but the last return the columns of ``documents``. Null, empty, repeated and
missing rows: as each stage's operator defines them; an empty table passes through
all stages and packs to no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costlens.llm import exact_dedup, packing, quality_rules, secret_ledger, simhash
from costlens.llm.common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_ledger.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("exact dedup", dedup), ("simhash near-dedup", near_dedup), ("secret scans", secrets), ("best-fit packing", pack)]

#: Binary fingerprints, components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name.replace(" ", "-"))
    return docs
