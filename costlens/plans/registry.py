"""
oracle SQL. Values are normalised at the query boundary: integral columns as
bigint, fractional columns as double rounded to 4 places (both engines)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.plans.pipeline import Pipeline

_PIPELINES: dict[tuple, Pipeline] = {}

#: The test metering is sparser than an account's, so that two hours may have no rows.
TEST_OPTIONS = {"recent_hours": 6}

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


from costlens.functions.exprs import round4  # noqa: E402


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _INTEGRAL):
            c = c.cast("long")
        elif isinstance(f.dataType, _FRACTIONAL):
            c = round4(c.cast("double"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PIPELINES:
        _PIPELINES[key] = Pipeline.from_testdata(spark, sf_dir, options=TEST_OPTIONS)
    return _PIPELINES[key]


def model_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(pipeline(spark, sf_dir)[name])
    run.__name__ = name
    return run


def keys() -> list[str]:
    from costlens.oracle import registry as oracle_registry
    return oracle_registry.ALL_KEYS


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: model_query(k) for k in keys()}
