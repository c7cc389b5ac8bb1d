"""Ledger and watermark algebra; every ledger stays one row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.scalars import parse_iso_lenient
from freshet.operators.selection import page_numbers
from freshet.operators.skew import HotKeys, hot_keys

PENDING, MISSING, FETCHED = "pending", "missing", "fetched"
_RANK = {PENDING: 0, MISSING: 1, FETCHED: 2}

# Ids per exported state document, so that no document grows with its channel.
DOCUMENT_IDS = 1000


def ledger_union(ledger: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set union of seen and new ids."""
    return ledger.select(*keys).unionByName(new.select(*keys)).distinct()


def status_rank(status: Column | str) -> Column:
    column = F.col(status) if isinstance(status, str) else status
    return F.create_map(*[F.lit(x) for pair in _RANK.items() for x in pair])[column]


def status_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in _RANK]), (rank + 1).cast("int"))


def upsert_ledger(ledger: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge changes into the ledger: status only moves forward, the first sighting is kept.

    All merged values are fixed width, so this is one hash aggregation with map-side combine.
    """
    merged = (
        ledger.unionByName(changes)
        .groupBy(*keys)
        .agg(
            F.max("published_ts").alias("published_ts"),
            F.min("first_seen_run").alias("first_seen_run"),
            F.max(status_rank("status")).alias("rank"),
            F.max("attempts").alias("attempts"),
        )
    )
    return merged.withColumn("status", status_name(F.col("rank"))).select(*ledger.columns)


def upsert_watermark(watermark: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Latest fetch time per key."""
    both = watermark.unionByName(changes)
    return both.groupBy(key).agg(
        F.max("last_fetch_ts").alias("last_fetch_ts"), F.max("updated_at").alias("updated_at")
    )


def without_channels(state: DataFrame, cleared: DataFrame | None, key: str) -> DataFrame:
    """State after a reset of the listed channels, or of all of them."""
    if cleared is None:
        return state.where(F.lit(False))
    return state.join(cleared.select(key), key, "left_anti")


def collect_ids(
    df: DataFrame, key: str, item: str, size: int = DOCUMENT_IDS, hot: HotKeys | None = None
) -> DataFrame:
    """Sorted ids per key in numbered documents of at most ``size`` ids."""
    hot = hot or hot_keys(df, [key])
    paged = page_numbers(df.select(key, item).distinct(), key, [F.col(item).asc()], size, hot)
    return paged.groupBy(key, F.col("batch_no").alias("chunk_no")).agg(
        F.array_sort(F.collect_list(item)).alias("video_ids")
    )


def state_documents(
    ledger: DataFrame, watermark: DataFrame, key: str, item: str, size: int = DOCUMENT_IDS
) -> DataFrame:
    """Export form of the state: JSON text per document."""
    documents = collect_ids(ledger, key, item, size).join(watermark, key, "left")
    body = F.struct(
        F.col(key).cast("string").alias("channel_id"),
        F.col("last_fetch_ts").cast("string").alias("last_fetch_time"),
        F.col("video_ids").cast("array<string>").alias("video_ids"),
        F.col("updated_at").cast("string").alias("updated_at"),
    )
    return documents.select(key, "chunk_no", F.to_json(body).alias("value"))


def ids_of_documents(documents: DataFrame) -> DataFrame:
    """(channel_id, video_id) of imported documents; corrupt ones contribute nothing."""
    return (
        documents.select("channel_id", F.explode("video_ids").alias("video_id"))
        .where(F.col("channel_id").isNotNull() & F.col("video_id").isNotNull())
        .distinct()
    )


def watermark_of_documents(documents: DataFrame) -> DataFrame:
    """Latest usable fetch time per channel; an unusable one leaves the channel on first run."""
    parsed = documents.select(
        "channel_id",
        parse_iso_lenient("last_fetch_time").alias("last_fetch_ts"),
        parse_iso_lenient("updated_at").alias("updated_at"),
    ).where(F.col("channel_id").isNotNull())
    return parsed.groupBy("channel_id").agg(
        F.max("last_fetch_ts").alias("last_fetch_ts"), F.max("updated_at").alias("updated_at")
    )
