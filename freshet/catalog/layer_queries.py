"""Cleaned, aggregated and change-over-time tables, quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.catalog.base import DURATION_SQL, K_SQL, duration_text, events, iso, number_text, prop, query, table
from freshet.functions import scalars as S
from freshet.plans.layers import gold_by, growth, name_history, silver_videos
from freshet.plans.quality import rule_report, unstable_names


@query(
    "silver_latest",
    f"""select cast(user_id as varchar) as video_id, event_type as title, ts as published_ts, view_count, duration, tags, language from (
        select user_id, event_type, ts, {K_SQL} as view_count,
               cast({DURATION_SQL} as bigint) as duration, case when event_type = 'view' then 0 else 2 end as tags,
               case when event_type = 'view' then '' else 'en' end as language,
               row_number() over (partition by user_id order by ts desc, event_id) as rn from events) where rn = 1""",
)
def silver_latest(spark, sf):
    """Videos are users here, each event one run's row for them; views lack tags and language."""
    has_text = F.col("event_type") != "view"
    raw = events(spark, sf).withColumn("text", duration_text()).select(
        F.col("user_id").cast("string").alias("video_id"),
        F.col("event_type").alias("title"),
        iso().alias("published_date"),
        prop("k").alias("view_count"),
        F.lit(None).cast("bigint").alias("like_count"),
        F.lit(None).cast("bigint").alias("comment_count"),
        S.iso_duration_seconds("text").alias("duration"),
        F.when(has_text, F.concat("event_type", F.lit(",y"))).alias("tags"),
        F.lit(None).cast("string").alias("category_id"),
        F.when(has_text, F.lit("en")).alias("language"),
        F.lit("").alias("channel_id"),
        F.lit("").alias("channel_name"),
        iso().alias("run"),
    )
    silver = silver_videos(raw)
    return silver.select(
        "video_id",
        "title",
        F.col("published_ts").cast("timestamp_ntz").alias("published_ts"),
        "view_count",
        "duration",
        F.size("tags").alias("tags"),
        "language",
    )


_VIDEOS = f"""select user_id, event_type, ts, {K_SQL} as views, cast(trunc(value) as bigint) as likes,
    hour(ts) as comments, {DURATION_SQL} as duration from events"""

_GOLD = """count(*) as videos, cast(sum(views) as bigint) as views, avg(duration) as avg_duration,
    case when sum(views) > 0 then (sum(likes) + sum(comments)) / sum(views) else 0.0 end as engagement"""


def _videos(spark, sf):
    return events(spark, sf).withColumn("text", duration_text()).select(
        "user_id",
        "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("published_day"),
        prop("k").alias("views"),
        F.col("value").cast("bigint").alias("likes"),
        F.hour("ts").alias("comments"),
        S.iso_duration_seconds("text").alias("duration"),
    )


def _gold(spark, sf, key):
    return gold_by(_videos(spark, sf), [key], "views", "likes", "comments", "duration")


@query("gold_by_channel", f"with v as ({_VIDEOS}) select user_id, {_GOLD} from v group by 1")
def gold_by_channel(spark, sf):
    return _gold(spark, sf, "user_id")


@query("gold_by_category", f"with v as ({_VIDEOS}) select event_type, {_GOLD} from v group by 1")
def gold_by_category(spark, sf):
    return _gold(spark, sf, "event_type")


@query("gold_by_day", f"with v as ({_VIDEOS}) select strftime(ts, '%Y-%m-%d') as published_day, {_GOLD} from v group by 1")
def gold_by_day(spark, sf):
    return _gold(spark, sf, "published_day")


@query(
    "gold_by_language",
    f"""with v as (select d.lang, d.n_chars as views, coalesce(l.quality, 0) as likes, coalesce(l.toxic, 0) as comments,
                   length(d.text) as duration from documents d left join labels l using (doc_id))
        select lang, {_GOLD} from v group by 1""",
)
def gold_by_language(spark, sf):
    labels = table(spark, sf, "labels")
    rated = table(spark, sf, "documents").join(labels, "doc_id", "left").select(
        "lang",
        F.col("n_chars").alias("views"),
        S.zero_if_missing("quality").alias("likes"),
        S.zero_if_missing("toxic").alias("comments"),
        F.length("text").alias("duration"),
    )
    return gold_by(rated, ["lang"], "views", "likes", "comments", "duration")


def _in_order():
    return [F.col("ts").asc(), F.col("event_id").asc()]


@query(
    "channel_growth",
    f"""with s as (select user_id, event_id, ts, value, {K_SQL} as k from events)
        select user_id, event_id, value, k,
               value - lag(value) over (partition by user_id order by ts, event_id) as value_delta,
               k - lag(k) over (partition by user_id order by ts, event_id) as k_delta from s""",
)
def channel_growth(spark, sf):
    snapshots = events(spark, sf).select("user_id", "event_id", "ts", "value", prop("k").alias("k"))
    return growth(snapshots, "user_id", _in_order(), ["value", "k"]).drop("ts")


@query(
    "channel_name_history",
    """with marked as (select user_id, event_id, ts, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as prev from events),
            starts as (select * from marked where prev is null or prev != event_type)
       select user_id, row_number() over (partition by user_id order by ts, event_id) as version, event_type, ts as valid_from,
              lead(ts) over (partition by user_id order by ts, event_id) as valid_to from starts""",
)
def channel_name_history(spark, sf):
    snapshots = events(spark, sf).select("user_id", "event_id", "ts", "event_type")
    return name_history(snapshots, "user_id", "event_type", "ts", tie=["event_id"])


@query(
    "dq_report",
    """select 'key present' as rule, count(*) filter (where event_id is null) as violations from events
       union all select 'value above one', count(*) filter (where value <= 1) from events
       union all select 'duration parses', count(*) filter (where event_type = 'error') from events
       union all select 'number parses', count(*) filter (where event_type = 'error') from events
       union all select 'unique key', count(user_id) - count(distinct user_id) from events
       union all select 'name stable', count(*) from (select user_id from events group by 1 having min(event_type) != max(event_type))""",
)
def dq_report(spark, sf):
    df = events(spark, sf).withColumn("duration", duration_text()).withColumn("number", number_text())
    rules = {
        "key present": F.col("event_id").isNotNull(),
        "value above one": F.col("value") > 1,
        "duration parses": S.is_iso_duration("duration"),
        "number parses": S.is_bigint_text("number"),
    }
    renamed = unstable_names(df, "user_id", "event_type")
    stable = renamed.agg(F.lit("name stable").alias("rule"), F.count(F.lit(1)).alias("violations"))
    return rule_report(df, rules, unique="user_id").unionByName(stable)
