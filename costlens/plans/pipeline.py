"""The model graph.

``Pipeline`` holds the raw telemetry frames, the config tables and ``as_of``,
and builds every model lazily on first access (``p["daily_cost_rollup"]``).
Each build is a plain DataFrame expression over other models, so asking for a
publication table yields one logical plan that Catalyst optimises end to end.

Models reused by many downstream plans (query cost attribution, utilisation,
the daily rollup) can be materialised to parquet in the shared checkpoint folder
with ``materialize=(...)``; this cuts lineage and makes lost executors cheap to
recover from at scale. Raw tables whose columns are long expressions are written the
same way, on first access (``derived=(...)``): every filter above would otherwise hold
the expressions again, for each use of each column.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costlens.functions.exprs import AsOf
from costlens.operators import quality
from costlens.session import checkpoint_root
from costlens.sources import staging, telemetry
from costlens.sources.seeds import Config, test_config  # the test copy serves from_testdata alone

#: Models that are written at the same time.
WRITERS = 8

#: How the written form of a raw table is named among the models.
RAW = "raw:"

#: Models that are never written: a copy of a written table with a row-local column more.
ROW_LOCAL = ("query_history_costed",)

BUILDERS: dict[str, Callable[["Pipeline"], DataFrame]] = {}


def model(name: str):
    def deco(fn):
        BUILDERS[name] = fn
        return fn
    return deco


class Pipeline:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], as_of: AsOf, config: Config,
                 materialize: tuple[str, ...] = (), options: dict | None = None, derived: tuple[str, ...] = ()):
        self.spark = spark
        self.raw = raw
        self.derived = derived
        self.as_of = as_of
        self.config = config
        self.materialize = set(materialize)
        self.options = dict(options or {})
        self._cache: dict[str, DataFrame] = {}
        self._models: dict[str, Future] = {}
        self._lock = threading.Lock()
        self._written: Pipeline | None = None
        #: Failures of the null, range and value checks of each model that was written, by check.
        self.observed: dict[str, dict[quality.Check, int]] = {}

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, as_of: AsOf | None = None,
                      config: Config | None = None, **kw) -> "Pipeline":
        as_of = as_of or AsOf()
        raw = telemetry.derive(spark, sf_dir, as_of) | {"access_reads": telemetry.access_reads(spark, sf_dir, as_of)}
        p = cls(spark, raw, as_of, config or test_config(), **{"derived": telemetry.WRITTEN} | kw)
        p.sf_dir = sf_dir
        return p

    STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

    def star(self) -> dict[str, DataFrame]:
        """The star-schema tables the workload shapes run on."""
        if "star" not in self._cache:
            self._cache["star"] = {t: self.spark.read.parquet(f"{self.sf_dir}/{t}.parquet") for t in self.STAR}
        return self._cache["star"]

    # -- access ---------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            future = self._models.get(name)
            mine = future is None
            if mine:
                future = self._models[name] = Future()
        if mine:
            try:
                future.set_result(self._build(name))
            except BaseException as e:
                future.set_exception(e)
                with self._lock:
                    del self._models[name]
        return future.result()

    def _build(self, name: str) -> DataFrame:
        if name in staging.STAGING:
            df = staging.project(name, self.source(staging.STAGING[name][0]), self.as_of)
        elif name.startswith(RAW):
            return self._write(name, self.raw[name.removeprefix(RAW)])
        elif name in BUILDERS:
            df = BUILDERS[name](self)
        else:
            raise KeyError(name)
        return self._write(name, df) if name in self.materialize else df

    def source(self, name: str) -> DataFrame:
        """A raw table, written once where it is ``derived``."""
        return self[RAW + name] if name in self.derived else self.raw[name]

    def together(self, *names: str) -> list[DataFrame]:
        """Models built at the same time: some run jobs while they are built."""
        with ThreadPoolExecutor(WRITERS) as pool:
            return list(pool.map(self.__getitem__, names))

    def published(self, *names: str) -> list[DataFrame]:
        """Models as written tables: the quality checks and the reports read what a run
        has published, each model written once from the written ones below it. Up to
        ``WRITERS`` models are written at the same time; one that needs a model
        which another thread is writing waits for it."""
        run = self._run()
        wanted = [n for n in names if n not in staging.STAGING and not n.startswith("seed_")]
        run.together(*wanted)
        return [self.checked(n) for n in names]

    def _run(self) -> Pipeline:
        """The pipeline that writes all of its models: this one, or one beside it."""
        written = set(BUILDERS).difference(ROW_LOCAL)
        if self.materialize.issuperset(written):
            return self
        raw = self.raw | {name: self.source(name) for name in self.derived}
        with self._lock:
            if self._written is None:
                self._written = Pipeline(self.spark, raw, self.as_of, self.config, options=self.options, materialize=tuple(written))
            return self._written

    def checked(self, name: str) -> DataFrame:
        """One published model; a staging or config table as it is."""
        if name.startswith("seed_"):
            return self.seed(name.removeprefix("seed_"))
        return self[name] if name in staging.STAGING else self._run()[name]

    def failures(self, name: str) -> dict[quality.Check, int] | None:
        """What writing the published model ``name`` has found, None if it was not written."""
        return self._run().observed.get(name)

    def seed(self, name: str) -> DataFrame:
        key = f"seed:{name}"
        if key not in self._cache:
            self._cache[key] = self.config.frame(self.spark, name)
        return self._cache[key]

    def opt(self, key: str, default=None):
        return self.options.get(key, default)

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        """Materialise a model as parquet under the checkpoint folder. Its null, range
        and value checks are counted in the same pass."""
        path = os.path.join(checkpoint_root(self.spark), "models", f"{name.replace(':', '-')}-{uuid.uuid4().hex[:8]}")
        checks = quality.conditions(quality.CHECKS.get(name, {}))
        if checks:
            seen = Observation()
            df = df.observe(seen, *[F.sum(F.when(c, 1).otherwise(0)).alias(f"c{i}") for i, c in enumerate(checks.values())])
        df.write.mode("overwrite").parquet(path)
        if checks:
            got = seen.get  # a plan without rows has no counts
            self.observed[name] = {k: got.get(f"c{i}") or 0 for i, k in enumerate(checks)}
        return self.spark.read.schema(df.schema).parquet(path)


def _register_all():
    # importing the wiring module fills BUILDERS
    from costlens.plans import models  # noqa: F401


_register_all()
