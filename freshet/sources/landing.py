"""Landed JSON responses: envelope scan, quarantine and flattening to the flat tables.

Each response is parsed once: the flattened frames carry rejected rows next to accepted ones
(``reason`` is NULL for those), so one materialised frame feeds both the tables and the quarantine.

Landing layout: ``<root>/{channels,search,videos}/``. A file is one response (``multi_line``) or one
response per line. The channel a response was fetched for is its ``channel_id`` field or, so that an
unreadable file can still be blamed on its channel, the file name ``<anything>__<channel>__p<page>.json``,
which may go on with the ending of a compression.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.scalars import (
    coerce_bigint,
    empty_if_missing,
    first_present,
    iso_duration_seconds,
    tags_joined,
)
from freshet.operators.selection import is_kind, one_per_key
from freshet.schemas import CHANNEL_ITEM, CHANNEL_STATS, CORRUPT, SEARCH_ITEM, VIDEO_ITEM, envelope
from freshet.sources.files import empty, is_missing_path
from freshet.sources.isolation import not_among

FILE_PATTERN = r"^.*__(.+)__p(\d+)\.json(?:\.\w+)?$"

# The channel a response was asked for, as opposed to the one an item names.
REQUESTED = "requested"
INCOMPLETE_ITEM = "incomplete item"
UNREADABLE_FILE = "unreadable file"

ITEMS = {"channels": CHANNEL_ITEM, "search": SEARCH_ITEM, "videos": VIDEO_ITEM}


def read_envelopes(
    spark: SparkSession, path: str, item: T.StructType, multi_line: bool = False, unreadable: Sequence[str] = ()
) -> DataFrame:
    """All responses below ``path``, at any depth, with the channel, page and file they belong to.

    Files listed as ``unreadable`` are not opened; each stands as one response without content, so that
    it is rejected and, if its name says so, blamed on its channel.
    """
    schema = envelope(item)
    try:
        raw = (
            spark.read.schema(schema)
            .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, multiLine=str(multi_line).lower())
            .option("recursiveFileLookup", "true")
            .json(path)
            .where(not_among(list(unreadable)))
        ).withColumn("source_file", F.col("_metadata.file_name"))
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        raw = empty(spark, schema).withColumn("source_file", F.lit(""))
    raw = raw.withColumn("unreadable", F.lit(False))
    if unreadable:
        names = [(unquote(name.rsplit("/", 1)[-1]), True) for name in unreadable]
        raw = raw.unionByName(spark.createDataFrame(names, "source_file string, unreadable boolean"), allowMissingColumns=True)
    from_name = F.nullif(F.regexp_extract("source_file", FILE_PATTERN, 1), F.lit(""))
    page_from_name = F.regexp_extract("source_file", FILE_PATTERN, 2).try_cast("bigint")
    return raw.withColumn("channel_id", F.coalesce("channel_id", from_name)).withColumn(
        "page_no", F.coalesce("page_no", page_from_name, F.lit(0))
    )


def _judged(pages: DataFrame) -> DataFrame:
    """Pages with ``reason``/``detail`` set, and their items removed, when the page is unusable."""
    reason = (
        F.when(F.col("unreadable"), UNREADABLE_FILE)
        .when(F.col(CORRUPT).isNotNull(), "corrupt response")
        .when(F.col("error").isNotNull(), "error response")
    )
    detail = F.when(F.col("unreadable"), F.col("source_file")).otherwise(
        F.concat_ws(" ", F.col("error.code").cast("string"), F.col("error.message"))
    )
    return pages.select(
        "channel_id",
        "page_no",
        "source_file",
        reason.alias("reason"),
        detail.alias("detail"),
        F.when(reason.isNull(), F.col("items")).alias("items"),
        (F.coalesce("nextPageToken", F.lit("")) != "").alias("more"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNull()).drop("reason", "detail")


def rejected(rows: DataFrame, source: str) -> DataFrame:
    """Quarantine rows of a flattened landing table."""
    return rows.where(F.col("reason").isNotNull()).select(
        F.col(REQUESTED).alias("channel_id"), F.lit(source).alias("source"), "reason", "detail"
    )


def blocking(rejects: DataFrame) -> DataFrame:
    """Channels whose run must not advance: any rejected response, not a single rejected item."""
    whole = rejects.where((F.col("reason") != INCOMPLETE_ITEM) & F.col("channel_id").isNotNull())
    return whole.groupBy("channel_id").agg(F.max("reason").alias("error"))


def _all_present(*paths: str) -> Column:
    present = F.lit(True)
    for path in paths:
        present = present & F.col(path).isNotNull()
    return present


def _stat(path: str) -> Column:
    return coerce_bigint(path)


def channel_rows(pages: DataFrame) -> DataFrame:
    """One row per response: its last item wins. A response without a usable item is rejected."""
    last = _judged(pages).withColumn("item", F.try_element_at("items", F.lit(-1)))
    usable = _all_present("item.id", "item.snippet.title", "item.statistics")
    return last.select(
        F.col("channel_id").alias(REQUESTED),
        "page_no",
        "source_file",
        F.coalesce(F.col("reason"), F.when(~usable, "no usable item")).alias("reason"),
        "detail",
        F.col("item.id").alias("channel_id"),
        F.col("item.snippet.title").alias("channel_name"),
        _stat("item.statistics.subscriberCount").alias("subscribers"),
        _stat("item.statistics.viewCount").alias("total_views"),
        _stat("item.statistics.videoCount").alias("video_count"),
    )


def channel_stats(rows: DataFrame) -> DataFrame:
    """One row per channel even when several responses were landed for it: the latest page wins."""
    return one_per_key(accepted(rows), ["channel_id"], [F.col("page_no").desc()]).select(*CHANNEL_STATS.names)


def search_rows(pages: DataFrame) -> DataFrame:
    """Search results of all pages with their position. Items that are no videos, and empty pages,
    leave a row without an id, so that every accepted page can be seen."""
    items = _judged(pages).select(
        "channel_id", "page_no", "reason", "detail", "more", F.posexplode_outer("items").alias("pos", "item")
    )
    kind = F.coalesce(F.col("item.id.kind"), F.lit("video"))
    is_video = F.col("item").isNotNull() & is_kind(kind)
    lost = F.when(is_video & F.col("item.id.videoId").isNull(), INCOMPLETE_ITEM)
    return items.select(
        F.col("channel_id").alias(REQUESTED),
        "channel_id",
        "page_no",
        F.col("pos").cast("bigint").alias("pos"),
        F.coalesce(F.col("reason"), lost).alias("reason"),
        "detail",
        F.when(is_video, F.col("item.id.videoId")).alias("video_id"),
        F.try_to_timestamp(F.coalesce("item.publishedAt", "item.snippet.publishedAt")).alias("published_ts"),
        "more",
    )


def search_items(rows: DataFrame) -> DataFrame:
    found = accepted(rows).where(F.col("video_id").isNotNull())
    return found.select("channel_id", "video_id", "published_ts", "page_no", "pos")


def complete_answers(rows: DataFrame, first_page_only: bool = False) -> DataFrame:
    """Channels whose whole search answer is there: pages 0, 1, 2, ... without a gap, none rejected, and
    no further page announced by the last. ``first_page_only`` asks for an accepted page 0 alone.

    A response that cannot be attributed to a channel leaves a gap, or no page at all, in its own.
    """
    usable = F.col("reason").isNull() | (F.col("reason") == INCOMPLETE_ITEM)
    asked = rows.where(F.col(REQUESTED).isNotNull())
    pages = asked.groupBy(REQUESTED, "page_no").agg(F.bool_and(usable).alias("ok"), F.bool_or("more").alias("more"))
    if first_page_only:
        return pages.where("page_no = 0 and ok").select(F.col(REQUESTED).alias("channel_id"))
    answers = pages.groupBy(REQUESTED).agg(
        F.min("page_no").alias("first"),
        F.max("page_no").alias("last"),
        F.count(F.lit(1)).alias("pages"),
        F.bool_and("ok").alias("ok"),
        F.max_by("more", "page_no").alias("more"),
    )
    whole = answers.where("first = 0 and pages = last + 1 and ok and not more")
    return whole.select(F.col(REQUESTED).alias("channel_id"))


def video_rows(pages: DataFrame) -> DataFrame:
    """Flat video rows; an item lacking a required field is rejected alone."""
    items = _judged(pages).select(
        F.col("channel_id").alias(REQUESTED), "reason", "detail", F.explode_outer("items").alias("item")
    )
    usable = _all_present("item.id", "item.snippet.title", "item.snippet.publishedAt", "item.statistics")
    lost = F.when(~usable, INCOMPLETE_ITEM)
    return items.where(F.col("reason").isNotNull() | F.col("item").isNotNull()).select(
        REQUESTED,
        F.coalesce(F.col("reason"), lost).alias("reason"),
        F.when(F.col("reason").isNull(), empty_if_missing("item.id")).otherwise(F.col("detail")).alias("detail"),
        F.col("item.id").alias("video_id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.publishedAt").alias("published_date"),
        _stat("item.statistics.viewCount").alias("view_count"),
        _stat("item.statistics.likeCount").alias("like_count"),
        _stat("item.statistics.commentCount").alias("comment_count"),
        iso_duration_seconds("item.contentDetails.duration").alias("duration"),
        tags_joined("item.snippet.tags").alias("tags"),
        empty_if_missing("item.snippet.categoryId").alias("category_id"),
        first_present("item.snippet.defaultAudioLanguage", "item.snippet.defaultLanguage").alias("language"),
    )


def video_details(rows: DataFrame) -> DataFrame:
    return accepted(rows).drop(REQUESTED)
