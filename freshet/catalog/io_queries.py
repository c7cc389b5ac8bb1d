"""Scans, flattening and sinks: write below the shared folder, read back, compare with the tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.catalog.base import DURATION_SQL, EVENTS, K_SQL, by_type, events, query, table
from freshet.catalog.landed import channel_envelopes, land, search_envelopes, video_envelopes
from freshet.plans.layers import in_hours, since_month
from freshet.plans.quality import violations, with_corrupt
from freshet.plans.retention import sweep_months
from freshet.session import frozen, working_dir
from freshet.sinks.writers import hour_columns, overwrite_partitions, write_csv, write_lake, write_snapshot, write_table
from freshet.sources.files import read_bronze, read_channel_list, read_csv, read_lake
from freshet.sources.landing import (
    ITEMS,
    blocking,
    channel_rows,
    channel_stats,
    read_envelopes,
    rejected,
    search_items,
    search_rows,
    video_details,
    video_rows,
)

HOURS = ("year", "month", "day", "hour")
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@query("scan_channel_list", "select c_name as channel_name, cast(c_custkey as varchar) as channel_id from customer")
def scan_channel_list(spark, sf):
    path = working_dir(spark, "channels")
    listed = table(spark, sf, "customer").select(F.col("c_name").alias("channel_name"), F.col("c_custkey").alias("channel_id"))
    write_csv(listed, path)
    return read_channel_list(spark, path)


@query(
    "channel_stats_flatten",
    """select cast(c_custkey as varchar) as channel_id, c_name as channel_name, c_custkey as subscribers,
              cast(case when c_mktsegment = 'BUILDING' then 0 else trunc(c_acctbal) end as bigint) as total_views,
              cast(c_nationkey as bigint) as video_count from customer""",
)
def channel_stats_flatten(spark, sf):
    path = working_dir(spark, "channels")
    land(channel_envelopes(table(spark, sf, "customer")), path)
    return channel_stats(channel_rows(read_envelopes(spark, path, ITEMS["channels"])))


@query(
    "video_details_flatten",
    f"""select cast(event_id as varchar) as video_id, 'a, "q" ' || event_type as title,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as published_date, {K_SQL} as view_count,
               cast(0 as bigint) as like_count, cast(0 as bigint) as comment_count, cast({DURATION_SQL} as bigint) as duration,
               event_type || ',y' as tags, event_type as category_id, 'en' as language from events
        union all
        select event_id || 'b', 'a, "q" ' || event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
               0, 0, 0, 0, '', '', 'fr' from events""",
)
def video_details_flatten(spark, sf):
    path = working_dir(spark, "videos")
    land(video_envelopes(events(spark, sf)), path)
    return video_details(video_rows(read_envelopes(spark, path, ITEMS["videos"])))


@query(
    "search_all_pages",
    """select cast(user_id as varchar) as channel_id, cast(event_id as varchar) as video_id, ts as published_ts,
              (rn - 1) // 50 as page_no, (rn - 1) % 50 as pos
       from (select *, row_number() over (partition by user_id order by ts desc, event_id) as rn from events)""",
)
def search_all_pages(spark, sf):
    path = working_dir(spark, "search")
    land(search_envelopes(events(spark, sf)), path)
    items = search_items(search_rows(read_envelopes(spark, path, ITEMS["search"])))
    return items.withColumn("published_ts", F.col("published_ts").cast("timestamp_ntz"))


_BAD_USERS = "select user_id from events where event_type = 'error' and value > 120"
_CUT = "event_type = 'signup' and value > 100"


@query(
    "quarantine_channels",
    f"""select cast(user_id as varchar) as channel_id, cast(event_id as varchar) as video_id, 'ok' as state from events
        where user_id not in ({_BAD_USERS}) and not ({_CUT})
        union all
        select cast(user_id as varchar), '', 'error response' from ({_BAD_USERS}) group by 1
        union all
        select '', '', 'corrupt response' from events where {_CUT}""",
)
def quarantine_channels(spark, sf):
    """One response per event. Large errors are error answers and block their channel; other channels
    keep all their items. Cut-off lines name no channel any more and are only reported."""
    path = working_dir(spark, "search")
    item = F.struct(F.struct(F.col("event_id").cast("string").alias("videoId")).alias("id"))
    failed = (F.col("event_type") == "error") & (F.col("value") > 120)
    cut = (F.col("event_type") == "signup") & (F.col("value") > 100)
    answer = F.struct(F.lit(403).alias("code"), F.lit("quotaExceeded").alias("message"))
    body = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("channel_id"),
            F.when(~failed, F.array(item)).alias("items"),
            F.when(failed, answer).alias("error"),
        )
    )
    lines = events(spark, sf).select(body.alias("body"), cut.alias("cut"))
    whole = F.col("body")
    lines.select(F.when(F.col("cut"), F.substring(whole, F.lit(1), F.length(whole) - 2)).otherwise(whole)).write.text(path)
    rows = frozen(search_rows(read_envelopes(spark, path, ITEMS["search"])))
    rejects = rejected(rows, "search")
    blocked = blocking(rejects)
    nothing = F.lit("").alias("video_id")
    kept = search_items(rows).join(blocked, "channel_id", "left_anti")
    parts = [
        kept.select("channel_id", "video_id", F.lit("ok").alias("state")),
        blocked.select("channel_id", nothing, F.col("error").alias("state")),
        rejects.where("channel_id is null").select(F.lit("").alias("channel_id"), nothing, F.col("reason").alias("state")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("csv_roundtrip", "select doc_id, md5(text) as text_md5, lang, source, n_chars from documents")
def csv_roundtrip(spark, sf):
    path = working_dir(spark, "csv")
    write_csv(table(spark, sf, "documents").select(*DOCUMENTS.names), path)
    read = read_csv(spark, path, DOCUMENTS)
    return read.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "lang", "source", "n_chars")


@query(
    "bronze_scan",
    """select event_id, user_id, event_type, case when event_type = 'view' then '' else props end as props,
              case when event_type = 'click' then timestamp '2024-01-15 00:00:00' else timestamp '2024-02-01 12:30:00' end as run_ts
       from events""",
)
def bronze_scan(spark, sf):
    """Snapshots of two runs in hour folders, read at any depth with the run that their names carry;
    empty text comes back as ''."""
    path = working_dir(spark, "bronze")
    props = F.when(F.col("event_type") != "view", F.col("props")).alias("props")
    flat = events(spark, sf).select("event_id", "user_id", "event_type", props, "ts")
    for clicks, hour, stamp in ((True, "day=15/hour=00", "20240115_000000"), (False, "day=01/hour=12", "20240201_123000")):
        rows = flat.where((F.col("event_type") == "click") == F.lit(clicks))
        write_snapshot(rows, f"{path}/events/year=2024/{hour}", "events", stamp, file_rows=2000)
    schema = T.StructType([EVENTS[name] for name in ("event_id", "user_id", "event_type", "props", "ts")])
    read = read_bronze(spark, path, schema, "events_*.csv")
    return read.select("event_id", "user_id", "event_type", "props", F.col("run_ts").cast("timestamp_ntz").alias("run_ts"))


@query(
    "table_modes",
    """select event_type, case when event_type = 'view' then 2 * count(*) else count(*) end as n, true as refused
       from events group by 1""",
)
def table_modes(spark, sf):
    """overwrite, then append the views again; ignore writes nothing, error refuses."""
    path = working_dir(spark, "modes")
    df = events(spark, sf)
    write_table(df.where("event_type = 'click'"), path, "overwrite")
    write_table(df, path, "overwrite")
    write_table(df.where("event_type = 'view'"), path, "append")
    write_table(df, path, "ignore")
    refused = False
    try:
        write_table(df, path, "error")
    except AnalysisException:
        refused = True
    counts = spark.read.schema(EVENTS).parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("refused", F.lit(refused))


@query(
    "run_partition_overwrite",
    """select event_id, strftime(ts, '%Y%m%d') as run from events
       where ts < timestamp '2024-01-15' or event_type = 'purchase'""",
)
def run_partition_overwrite(spark, sf):
    """Write all days as runs, twice; then rewrite the later ones with their purchases only."""
    path = working_dir(spark, "runs")
    df = events(spark, sf).select("event_id", "event_type", "ts", F.date_format("ts", "yyyyMMdd").alias("run"))
    for _ in range(2):
        overwrite_partitions(df, path, ["run"])
    overwrite_partitions(df.where("run >= '20240115' and event_type = 'purchase'"), path, ["run"])
    schema = T.StructType([EVENTS["event_id"], EVENTS["event_type"], EVENTS["ts"]])
    return read_lake(spark, path, schema, ("run",)).select("event_id", "run")


def _event_lake(spark, sf):
    path = working_dir(spark, "lake")
    write_lake(events(spark, sf), path, F.col("ts"))
    return read_lake(spark, path, EVENTS, HOURS)


@query(
    "lake_partitioned_write",
    """select event_id, value, strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day,
              strftime(ts, '%H') as hour from events""",
)
def lake_partitioned_write(spark, sf):
    return _event_lake(spark, sf).select("event_id", "value", *HOURS)


@query(
    "range_query",
    """select event_id, ts from events
       where ts >= timestamp '2024-01-10 06:00:00' and ts < timestamp '2024-01-12 18:00:00'""",
)
def range_query(spark, sf):
    return in_hours(_event_lake(spark, sf), datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 18)).select("event_id", "ts")


@query(
    "retention_filter",
    """select o_orderkey, strftime(o_orderdate, '%Y') as year, strftime(o_orderdate, '%m') as month
       from orders where o_orderdate >= timestamp '1997-06-01'""",
)
def retention_filter(spark, sf):
    path = working_dir(spark, "months")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    months = {name: column for name, column in hour_columns(F.col("o_orderdate")).items() if name in ("year", "month")}
    overwrite_partitions(orders.withColumns(months), path, list(months))
    lake = read_lake(spark, path, T.StructType([T.StructField("o_orderkey", T.LongType())]), tuple(months))
    return since_month(lake, datetime(1997, 6, 1)).select("o_orderkey", "year", "month")


@query(
    "retention_sweep",
    """select o_orderkey, strftime(o_orderdate, '%Y') as year, strftime(o_orderdate, '%m') as month
       from orders where o_orderdate >= timestamp '1997-06-01'""",
)
def retention_sweep(spark, sf):
    """The months before the cutoff are removed; all that is left is read, by a plain scan."""
    path = working_dir(spark, "months")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    months = {name: column for name, column in hour_columns(F.col("o_orderdate")).items() if name in ("year", "month")}
    overwrite_partitions(orders.withColumns(months), path, list(months))
    sweep_months(spark, path, datetime(1997, 6, 15))
    return read_lake(spark, path, T.StructType([T.StructField("o_orderkey", T.LongType())]), tuple(months))


@query(
    "schema_violations",
    """select event_id, 'corrupt' as violation from events where false
       union all
       select event_id, 'missing user_id' from events where event_type = 'signup'
       union all
       select null, 'corrupt' from events where event_type = 'error'""",
)
def schema_violations(spark, sf):
    """JSON lines: errors carry a text where a number belongs, sign-ups lack a required field."""
    path = working_dir(spark, "lines")
    line = by_type(
        error=F.concat(F.lit('{"event_id": oops'), F.col("event_id").cast("string")),
        signup=F.to_json(F.struct("event_id", "event_type")),
    )
    line = F.coalesce(line, F.to_json(F.struct("event_id", "user_id", "event_type")))
    events(spark, sf).select(line.alias("value")).write.text(path)
    schema = with_corrupt(T.StructType([EVENTS["event_id"], EVENTS["user_id"], EVENTS["event_type"]]))
    read = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return violations(read, ["event_id", "user_id"]).select("event_id", "violation")
