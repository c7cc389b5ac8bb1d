"""Registry of runnable queries and their SQL twins over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Events before this instant play the part of what earlier runs have already taken.
CUTOFF = "2024-01-15 00:00:00"
CUTOFF_SQL = f"timestamp '{CUTOFF}'"

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[name] = run
        SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def earlier(df: DataFrame) -> DataFrame:
    return df.where(F.col("ts") < cutoff())


def newest() -> list:
    return [F.col("ts").desc(), F.col("event_id").asc()]


def watermark(df: DataFrame) -> DataFrame:
    """Last fetch per user, from the events earlier runs have taken."""
    return earlier(df).groupBy("user_id").agg(F.max("ts").alias("last_fetch_ts"))


def prop(name: str, kind: str = "bigint"):
    """One field of the JSON text column."""
    return F.from_json("props", f"{name} {kind}")[name]


def stamped(ts: str = "ts"):
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def iso(ts: str = "ts"):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def by_type(**choices):
    """A column chosen by event type; types not named get NULL."""
    column = None
    for kind, value in choices.items():
        column = F.when(F.col("event_type") == kind, value) if column is None else column.when(F.col("event_type") == kind, value)
    return column


def file_name():
    """File names in every accepted and rejected form, depending on the event type."""
    return by_type(
        click=F.concat(F.lit("events_"), stamped(), F.lit(".csv")),
        view=F.concat(F.lit("a_b_20240101_000000_"), stamped(), F.lit(".csv")),
        purchase=F.concat(F.lit("x_"), F.date_format("ts", "yyyy"), F.lit("99"), F.date_format("ts", "dd_HHmmss"), F.lit(".csv")),
        signup=F.concat(F.lit("x_"), stamped(), F.lit(".csv.bak")),
        error=F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")),
    )


FILE_NAME_SQL = """case event_type
    when 'click' then 'events_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv'
    when 'view' then 'a_b_20240101_000000_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv'
    when 'purchase' then 'x_' || strftime(ts, '%Y') || '99' || strftime(ts, '%d_%H%M%S') || '.csv'
    when 'signup' then 'x_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv.bak'
    when 'error' then 'events_' || strftime(ts, '%Y%m%d') || '.csv' end"""


def duration_text():
    """Durations in every accepted form and a rejected one, depending on the event type."""
    return by_type(
        click=F.concat(F.lit("PT"), F.minute("ts"), F.lit("M"), F.second("ts"), F.lit("S")),
        view=F.concat(F.lit("P"), F.dayofmonth("ts"), F.lit("DT"), F.hour("ts"), F.lit("H")),
        purchase=F.concat(F.lit("PT"), F.second("ts"), F.lit(",5S")),
        signup=F.concat(F.lit("P"), F.hour("ts"), F.lit("W")),
        error=F.lit("PT"),
    )


DURATION_SQL = """case event_type
    when 'click' then minute(ts) * 60 + second(ts)
    when 'view' then day(ts) * 86400 + hour(ts) * 3600
    when 'purchase' then second(ts)
    when 'signup' then hour(ts) * 604800
    else 0 end"""


def number_text():
    """Numbers as text: plain, decimal, padded, exponent, junk."""
    key = F.col("event_id").cast("string")
    return by_type(
        click=key,
        view=F.format_string("%.2f", "value"),
        purchase=F.concat(F.lit(" "), key, F.lit(" ")),
        signup=F.concat(key, F.lit("e3")),
        error=F.concat(F.lit("x"), key),
    )


NUMBER_SQL = """case event_type
    when 'click' then event_id
    when 'view' then cast(trunc(value) as bigint)
    when 'purchase' then event_id
    when 'signup' then event_id * 1000
    else 0 end"""

K_SQL = "cast(json_extract_string(props, '$.k') as bigint)"
