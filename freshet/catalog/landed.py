"""Landing folders derived from the given tables: customers as channels, events as videos."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.catalog.base import duration_text, iso, newest, prop
from freshet.operators.selection import page_numbers


def channel_envelopes(customers: DataFrame) -> DataFrame:
    """One response per customer: an outdated item first, then the valid one. Building-segment
    customers lack a view count."""
    key = F.col("c_custkey").cast("string")

    def item(title, subscribers, views, videos):
        return F.struct(
            key.alias("id"),
            F.struct(title.alias("title")).alias("snippet"),
            F.struct(subscribers.alias("subscriberCount"), views.alias("viewCount"), videos.alias("videoCount")).alias("statistics"),
        )

    views = F.when(F.col("c_mktsegment") != "BUILDING", F.format_string("%.2f", "c_acctbal"))
    stale = item(F.lit("outdated"), F.lit("1"), F.lit("1"), F.lit("1"))
    valid = item(F.col("c_name"), F.col("c_custkey").cast("string"), views, F.col("c_nationkey").cast("string"))
    return customers.select(key.alias("channel_id"), F.lit(0).alias("page_no"), F.array(stale, valid).alias("items"))


def search_envelopes(events: DataFrame) -> DataFrame:
    """Result pages per user, newest first, at most 50 items each."""
    paged = page_numbers(events.select("user_id", "event_id", "ts"), "user_id", newest())
    item = F.struct(
        F.struct(F.lit("feed#video").alias("kind"), F.col("event_id").cast("string").alias("videoId")).alias("id"),
        iso().alias("publishedAt"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("rn", item.alias("item"))))
    return paged.groupBy("user_id", "batch_no").agg(F.transform(ordered, lambda s: s["item"]).alias("items")).select(
        F.col("user_id").cast("string").alias("channel_id"), F.col("batch_no").alias("page_no"), "items"
    )


def empty_answers(customers: DataFrame, events: DataFrame) -> DataFrame:
    """The one empty result page of every customer without events."""
    ids = customers.select(F.col("c_custkey").alias("user_id")).join(events.select("user_id").distinct(), "user_id", "left_anti")
    item = "array<struct<id:struct<kind:string,videoId:string>,publishedAt:string>>"
    return ids.select(F.col("user_id").cast("string").alias("channel_id"), F.lit(0).cast("bigint").alias("page_no"), F.array().cast(item).alias("items"))


def video_envelopes(events: DataFrame) -> DataFrame:
    """One response per event with two items: all fields present, and all optional fields absent."""
    text = F.lit(None).cast("string")

    def item(suffix, views, tags, category, audio, default, duration):
        return F.struct(
            F.concat(F.col("event_id").cast("string"), F.lit(suffix)).alias("id"),
            F.struct(
                F.concat(F.lit('a, "q" '), "event_type").alias("title"),
                iso().alias("publishedAt"),
                tags.alias("tags"),
                category.alias("categoryId"),
                audio.alias("defaultAudioLanguage"),
                default.alias("defaultLanguage"),
            ).alias("snippet"),
            F.struct(views.alias("viewCount"), text.alias("likeCount")).alias("statistics"),
            F.struct(duration.alias("duration")).alias("contentDetails"),
        )

    no_tags = F.lit(None).cast("array<string>")
    full = item("", prop("k").cast("string"), F.array("event_type", F.lit("y")), F.col("event_type"), F.lit("en"), F.lit("fr"), duration_text())
    bare = item("b", text, no_tags, text, text, F.lit("fr"), text)
    return events.select(F.col("user_id").cast("string").alias("channel_id"), F.lit(0).alias("page_no"), F.array(full, bare).alias("items"))


def land(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
