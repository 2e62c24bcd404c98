"""costlens: warehouse cost analytics as Spark DataFrame transformations.

Layers:
    sources/    telemetry adapter, staging projector, config tables
    functions/  reusable column expressions (rates, team rules, date maths)
    operators/  one function per analytic model, DataFrame in -> DataFrame out
    plans/      the model graph (Pipeline), distributed ranking, query registry
    streaming/  incremental extract, keyed upsert, stateful episode stream
    oracle/     independent DuckDB SQL used as the correctness oracle
"""

from costlens.plans.pipeline import Pipeline

__all__ = ["Pipeline"]
