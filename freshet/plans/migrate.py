"""Taking over what earlier tooling left: CSV snapshots with stamped names and state documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.scalars import date_stamp_ts, run_stamp
from freshet.operators.state import ids_of_documents, watermark_of_documents
from freshet.plans.store import RunStore
from freshet.session import tune
from freshet.sinks.writers import write_lake
from freshet.sources.files import read_bronze, read_state_documents


def migrate_snapshots(
    spark: SparkSession, source: str, target: str, table: str, schema: T.StructType, admit_dates: bool = False
) -> DataFrame:
    """Move every ``<table>_*.csv`` below ``source`` into the hour lake by the stamp in its name.

    Returns the rejected files with their row counts. ``admit_dates`` takes names that carry only a
    date as midnight of that day. Each snapshot owns its partition, so a repeated move changes nothing.
    """
    tune(spark)
    read = read_bronze(spark, source, schema, f"{table}_*.csv")
    if admit_dates:
        read = read.withColumn("run_ts", F.coalesce("run_ts", date_stamp_ts("file_name")))
    stamped = read.where(F.col("run_ts").isNotNull()).withColumn("run", run_stamp("run_ts"))
    write_lake(stamped.drop("file_name"), f"{target}/{table}", F.col("run_ts"), extra=("run",))
    return read.where(F.col("run_ts").isNull()).groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))


def import_state(spark: SparkSession, documents: str, store: RunStore, run_ts: datetime, multi_line: bool = True) -> DataFrame:
    """Start the store from per-channel state documents; returns the unreadable ones."""
    tune(spark)
    read = read_state_documents(spark, documents, multi_line)
    known = watermark_of_documents(read).where(F.col("last_fetch_ts").isNotNull())
    store.seed(spark, run_ts, ids_of_documents(read), known)
    return read.where("corrupt").select("channel_id")
