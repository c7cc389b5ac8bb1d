"""Sinks: CSV with minimal quoting, tables in four modes, idempotent run partitions, hour lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Minimal quoting, doubled quotes, empty text as an empty field, no trimming.
CSV_WRITE = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
    "lineSep": "\n",
}

MODES = ("append", "overwrite", "error", "ignore")
SAVE_FORMATS = ("csv", "table", "both")

# Quoted newlines make a CSV file unsplittable for its readers, so no file may grow without bound.
CSV_FILE_ROWS = 1_000_000

# A partition of up to so many rows is written by one task.
TASK_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", file_rows: int = CSV_FILE_ROWS) -> None:
    df.write.mode(mode).options(**CSV_WRITE, maxRecordsPerFile=str(file_rows)).csv(path)


def write_snapshot(df: DataFrame, folder: str, name: str, stamp: str, file_rows: int = CSV_FILE_ROWS) -> list[str]:
    """CSV files that carry the run in their names, ``<name>_<stamp>.csv``, so that whoever moves them
    keeps it; rows beyond one file go to ``<name>_part<n>_<stamp>.csv``. The files written are returned.

    They are written below a name that readers pass over and appear whole, and again only, if the run
    is written again.
    """
    spark, hidden = df.sparkSession, f"{folder}/_writing_{name}_{stamp}"
    # Few rows make one file.
    write_csv(df.hint("rebalance"), hidden, file_rows=file_rows)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for pattern in (f"{name}_{stamp}.csv", f"{name}_part[0-9]*_{stamp}.csv"):
        for status in fs.globStatus(path(f"{folder}/{pattern}")) or ():
            fs.delete(status.getPath(), False)
    parts = sorted((status.getPath() for status in fs.globStatus(path(f"{hidden}/part-*"))), key=lambda p: p.getName())
    written = []
    for n, part in enumerate(parts):
        written.append(f"{folder}/{name}_{stamp}.csv" if len(parts) == 1 else f"{folder}/{name}_part{n:05}_{stamp}.csv")
        if not fs.rename(part, path(written[-1])):
            raise OSError(f"{part} could not be renamed")
    fs.delete(path(hidden), True)
    return written


def write_table(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet", partition_by: tuple = ()) -> None:
    """Failures are raised: a run only counts as done once its tables are written."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def save_run(df: DataFrame, name: str, run: str, fmt: str = "parquet") -> None:
    """The rows of one run in a catalog table partitioned by ``run``; a repeated run replaces its own."""
    spark, rows, setting = df.sparkSession, df.withColumn("run", F.lit(run)), "spark.sql.sources.partitionOverwriteMode"
    if not spark.catalog.tableExists(name):
        rows.write.format(fmt).partitionBy("run").saveAsTable(name)
        return
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:  # columns go by place
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def save_table(df: DataFrame, name: str, mode: str = "append", fmt: str = "parquet") -> None:
    """The same four modes for a table of the session's catalog."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    df.write.format(fmt).mode(mode).saveAsTable(name)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet", options: dict | None = None
) -> None:
    """Replace exactly the partitions present in ``df``; writing the same run twice changes nothing.

    Opening a folder costs more than writing few rows, so that folders of ordinary size are dealt out
    over the tasks by their number, one file each. If some folder is too large for one task, rows are
    rebalanced by folder instead, which splits it over several.
    """
    folders = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("many"), F.max("n").alias("largest")).first()
    if (folders["largest"] or 0) <= TASK_ROWS:
        tasks = min(max(folders["many"], 1), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        dealt = df.repartition(tasks, *partition_by)
    else:
        dealt = df.hint("rebalance", *[F.col(c) for c in partition_by])
    (
        dealt.write.format(fmt)
        .mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **(options or {}))
        .partitionBy(*partition_by)
        .save(path)
    )


def hour_columns(ts: Column) -> dict[str, Column]:
    """Zero-padded partition values of the hour lake."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(ts, pattern) for name, pattern in patterns.items()}


def write_lake(df: DataFrame, path: str, ts: Column, fmt: str = "parquet", extra: tuple = ()) -> None:
    """``year=/month=/day=/hour=`` layout, so a range of hours prunes to its folders.

    ``extra`` columns split an hour further, for instance by run.
    """
    parts = hour_columns(ts)
    options = {**CSV_WRITE, "maxRecordsPerFile": str(CSV_FILE_ROWS)} if fmt == "csv" else None
    overwrite_partitions(df.withColumns(parts), path, [*parts, *extra], fmt, options)
