"""Session helpers: a configured local session for tests, and the shared
checkpoint folder taken from the session configuration."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "costlens") -> SparkSession:
    """Session used by tests and the bench. On a cluster the caller builds the
    session; every operator only relies on the settings below being sane."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised tables and checkpoints: ``spark.checkpoint.dir``
    of the session. Only where it is unset and tasks run inside the driver, as in
    tests, a scratch folder serves; other sessions are refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _LOCAL_ROOTS.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="costlens-")
        _LOCAL_ROOTS[context.applicationId] = root
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(os.path.join(root, "rdd"))
    return root
