"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan in this package relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot channel is worth an extra exchange: split it even when the next operator
    # would have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that a Python worker and the Arrow buffers of its JVM hold at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # Python workers must be able to import this package wherever the session was started from.
    here, environment = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))
    return spark


def local_session(cores: str | int = "*", app: str = "freshet", partitions: int = 8, **extra) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or what the context was given.

    Only a local session may leave it unset; it then uses its warehouse folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def working_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark)}/freshet/{label}-{uuid.uuid4().hex}"


def frozen(df: DataFrame, label: str = "frozen") -> DataFrame:
    """``df`` as a table below the shared folder: computed once, and a lost executor can neither
    change nor replay it. (A checkpoint would compute it twice and keep every column as rows.)"""
    path = working_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Submit independent Spark jobs at once, so that one job's tail does not idle the cluster."""
    with ThreadPoolExecutor(len(actions)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        return [future.result() for future in futures]
