"""Projections and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.catalog.base import (
    DURATION_SQL,
    FILE_NAME_SQL,
    K_SQL,
    NUMBER_SQL,
    by_type,
    cutoff,
    duration_text,
    events,
    file_name,
    iso,
    number_text,
    prop,
    query,
    table,
)
from freshet.functions import scalars as S


@query("json_project", f"select event_id, user_id, event_type as kind, {K_SQL} as k from events")
def json_project(spark, sf):
    parsed = events(spark, sf).withColumn("item", F.from_json("props", "k bigint"))
    return parsed.select("event_id", "user_id", F.col("event_type").alias("kind"), F.col("item.k").alias("k"))


@query(
    "json_encode",
    """select event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as doc
       from events""",
)
def json_encode(spark, sf):
    return events(spark, sf).select("event_id", F.to_json(F.struct("event_id", "user_id", "event_type")).alias("doc"))


@query("default_zero", f"select event_id, coalesce({K_SQL}, 0) as k, cast(0 as bigint) as missing from events")
def default_zero(spark, sf):
    return events(spark, sf).select(
        "event_id", S.zero_if_missing(prop("k")).alias("k"), S.zero_if_missing(prop("missing")).alias("missing")
    )


@query("default_empty", "select event_id, json_extract_string(props, '$.k') as k, '' as missing from events")
def default_empty(spark, sf):
    return events(spark, sf).select(
        "event_id",
        S.empty_if_missing(prop("k", "string")).alias("k"),
        S.empty_if_missing(prop("missing", "string")).alias("missing"),
    )


@query(
    "coalesce_chain",
    """select event_id, case event_type when 'click' then 'en' when 'view' then 'fr' when 'error' then '' else '' end as language
       from events""",
)
def coalesce_chain(spark, sf):
    # For 'error' the present but empty first value must win over the second one.
    audio = by_type(click=F.lit("en"), error=F.lit(""))
    default = by_type(click=F.lit("de"), view=F.lit("fr"), error=F.lit("es"))
    return events(spark, sf).select("event_id", S.first_present(audio, default).alias("language"))


@query(
    "tags_join",
    "select doc_id, md5(case when lang = 'de' then '' else replace(text, ' ', ',') end) as tags_md5 from documents",
)
def tags_join(spark, sf):
    tags = F.when(F.col("lang") != "de", F.split("text", " "))
    return table(spark, sf, "documents").select("doc_id", F.md5(S.tags_joined(tags)).alias("tags_md5"))


@query("iso_duration_seconds", f"select event_id, cast({DURATION_SQL} as bigint) as seconds from events")
def iso_duration_seconds(spark, sf):
    texts = events(spark, sf).select("event_id", duration_text().alias("text"))
    return texts.select("event_id", S.iso_duration_seconds("text").alias("seconds"))


@query("numeric_coerce", f"select event_id, cast({NUMBER_SQL} as bigint) as n from events")
def numeric_coerce(spark, sf):
    texts = events(spark, sf).select("event_id", number_text().alias("text"))
    return texts.select("event_id", S.coerce_bigint("text").alias("n"))


def _part_sql(part: str, pattern: str) -> str:
    return f"case when event_type in ('click', 'view') then strftime(ts, '{pattern}') end as {part}"


@query(
    "parse_stamp",
    "select event_id, "
    + ", ".join(
        _part_sql(part, pattern)
        for part, pattern in {
            "year": "%Y", "month": "%m", "day": "%d", "hour": "%H", "minute": "%M", "second": "%S"
        }.items()
    )
    + " from events",
)
def parse_stamp(spark, sf):
    named = events(spark, sf).select("event_id", file_name().alias("name"))
    return named.select("event_id", *[c.alias(part) for part, c in S.stamp_parts("name").items()])


@query(
    "quarantine_names",
    f"select event_id, {FILE_NAME_SQL} as name from events where event_type not in ('click', 'view')",
)
def quarantine_names(spark, sf):
    named = events(spark, sf).select("event_id", file_name().alias("name"))
    return named.where(S.stamp_ts("name").isNull())


@query(
    "lake_path",
    f"""with named as (select event_id, ts, event_type, {FILE_NAME_SQL} as name from events),
        keyed as (select event_id, case when event_type in ('click', 'view')
                  then strftime(ts, '{S.LAKE_PREFIX}/%Y/%m/%d/%H/') || name end as key from named)
        select event_id, key, 's3://lake/' || key as uri from keyed""",
)
def lake_path(spark, sf):
    keyed = events(spark, sf).select("event_id", file_name().alias("name")).select("event_id", S.lake_path("name").alias("key"))
    return keyed.withColumn("uri", S.object_uri("lake", "key"))


@query(
    "lake_path_run_ts",
    f"""select event_id, strftime(ts, '{S.LAKE_PREFIX}/%Y/%m/%d/%H/') || {FILE_NAME_SQL} as key from events""",
)
def lake_path_run_ts(spark, sf):
    return events(spark, sf).select("event_id", S.lake_key("ts", file_name()).alias("key"))


@query("basename", f"select event_id, {FILE_NAME_SQL} as name from events")
def basename(spark, sf):
    keyed = events(spark, sf).select("event_id", S.lake_key("ts", file_name()).alias("key"))
    return keyed.select("event_id", S.basename("key").alias("name"))


@query(
    "run_stamp",
    """select event_id, strftime(ts, '%Y%m%d_%H%M%S') as stamp,
              'channel_stats_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' as file_name from events""",
)
def run_stamp(spark, sf):
    return events(spark, sf).select(
        "event_id", S.run_stamp("ts").alias("stamp"), S.run_file_name("channel_stats", "ts").alias("file_name")
    )


@query(
    "parse_iso_lenient",
    "select event_id, case when event_type in ('click', 'view', 'signup') then ts end as parsed from events",
)
def parse_iso_lenient(spark, sf):
    text = by_type(
        click=F.concat(iso(), F.lit("+00:00Z")),
        view=F.concat(iso(), F.lit("Z")),
        signup=iso(),
        purchase=F.concat(F.lit("junk"), F.col("event_id").cast("string")),
    )
    return events(spark, sf).select("event_id", S.parse_iso_lenient(text).cast("timestamp_ntz").alias("parsed"))


@query("lookback_bound", "select event_id, ts - interval 10 minute as bound from events")
def lookback_bound(spark, sf):
    return events(spark, sf).select("event_id", S.lookback("ts").alias("bound"))


@query("hour_bucket", "select date_trunc('hour', ts) as hour, count(*) as n from events group by 1")
def hour_bucket(spark, sf):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    return events(spark, sf).groupBy(hour).agg(F.count(F.lit(1)).alias("n"))


@query(
    "calls_saved",
    """select user_id, count(*) filter (where ts < timestamp '2024-01-15') as cached,
              case when count(*) filter (where ts < timestamp '2024-01-15') > 0
                   then count(*) filter (where ts < timestamp '2024-01-15') // 50 + 1 else 0 end as saved
       from events group by 1""",
)
def calls_saved(spark, sf):
    cached = events(spark, sf).groupBy("user_id").agg(F.count_if(F.col("ts") < cutoff()).alias("cached"))
    return cached.withColumn("saved", S.calls_saved("cached"))
