"""File scans: driving list, bronze CSV lake, state documents, run tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.scalars import empty_if_missing, stamp_ts
from freshet.schemas import CHANNEL_LIST, CORRUPT, STATE_DOCUMENT, extended

# Reader settings for CSV written with minimal quoting and doubled quotes.
CSV_READ = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}

STATE_FILE_PATTERN = r"^channel_(.+)_cache\.json$"


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders right below ``path`` that begin with ``prefix``, without it; sorted."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    top = hadoop(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(top) if status.isDirectory()]
    return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix))


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; False if there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return empty(spark, schema)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_READ, **options).csv(path)


def read_channel_list(spark: SparkSession, path: str) -> DataFrame | None:
    """The driving list, or None when the file does not exist (which means: no run).

    Columns are found by the header, in any order and next to others; all of them are read as text.
    """
    try:
        listed = spark.read.options(**CSV_READ).csv(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return None
    for name in CHANNEL_LIST.names:
        if name not in listed.columns and name != "channel_id":
            listed = listed.withColumn(name, F.lit(None).cast("string"))
    return listed.select(*CHANNEL_LIST.names)


def read_lake(spark: SparkSession, path: str, schema: T.StructType, parts: tuple, fmt: str = "parquet") -> DataFrame:
    """A ``key=value`` layout; partition values stay text, so ``month=01`` is not read as 1."""
    full = extended(schema, *[(name, T.StringType()) for name in parts])
    return spark.read.schema(full).options(**(CSV_READ if fmt == "csv" else {})).format(fmt).load(path)


def read_bronze(spark: SparkSession, root: str, schema: T.StructType, glob: str = "*.csv") -> DataFrame:
    """Every CSV snapshot below ``root`` whatever the folder depth.

    Empty text fields come back as ''; ``file_name`` and the stamp in it are added.
    """
    raw = read_csv(spark, root, schema, recursiveFileLookup="true", pathGlobFilter=glob)
    columns = [
        empty_if_missing(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema.fields
    ]
    name = F.col("_metadata.file_name")
    return raw.select(*columns, name.alias("file_name"), stamp_ts(name).alias("run_ts"))


def read_state_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Per-channel state documents; the channel comes from the document or else its file name.

    Unreadable documents are kept with ``corrupt = true`` and no ids.
    """
    try:
        raw = (
            spark.read.schema(STATE_DOCUMENT)
            .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, multiLine=str(multi_line).lower())
            .json(path)
        )
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        raw = empty(spark, STATE_DOCUMENT).withColumn("_metadata", F.struct(F.lit("").alias("file_name")))
    from_name = F.nullif(F.regexp_extract(F.col("_metadata.file_name"), STATE_FILE_PATTERN, 1), F.lit(""))
    return raw.select(
        F.coalesce("channel_id", from_name).alias("channel_id"),
        "last_fetch_time",
        "video_ids",
        "updated_at",
        F.col(CORRUPT).isNotNull().alias("corrupt"),
    )
