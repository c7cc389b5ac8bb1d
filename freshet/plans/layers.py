"""Cleaned, aggregated and change-over-time tables on top of the run tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators.selection import one_per_key
from freshet.operators.skew import HotKeys, hot_keys, sequence_number, with_previous


def silver_videos(videos: DataFrame, run: str = "run") -> DataFrame:
    """Typed videos, NULLs normalised, the row of the latest run per id."""
    latest = one_per_key(videos, ["video_id"], [F.col(run).desc()])
    tags = F.coalesce("tags", F.lit(""))
    return latest.select(
        "video_id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.try_to_timestamp("published_date").alias("published_ts"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("view_count", "like_count", "comment_count", "duration")],
        F.when(tags == "", F.array().cast("array<string>")).otherwise(F.split(tags, ",")).alias("tags"),
        F.coalesce("category_id", F.lit("")).alias("category_id"),
        F.coalesce("language", F.lit("")).alias("language"),
        "channel_id",
        "channel_name",
        run,
    )


def engagement(likes: Column, comments: Column, views: Column) -> Column:
    """(likes + comments) / views, 0 without views."""
    return F.when(views > 0, (likes + comments) / views).otherwise(F.lit(0.0))


#: What a gold table sums; sums of disjoint parts can be added and taken off.
GOLD_SUMS = ("videos", "views", "likes", "comments", "duration")


def gold_sums(silver: DataFrame, key: str) -> DataFrame:
    """The sums that a gold row is made of, per value of the key."""
    columns = {"views": "view_count", "likes": "like_count", "comments": "comment_count", "duration": "duration"}
    return silver.groupBy(key).agg(F.count(F.lit(1)).alias("videos"), *[F.sum(c).alias(name) for name, c in columns.items()])


def gold_of(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gold rows from their sums."""
    return sums.select(
        *keys,
        "videos",
        "views",
        (F.col("duration") / F.col("videos")).alias("avg_duration"),
        engagement(F.col("likes"), F.col("comments"), F.col("views")).alias("engagement"),
    )


def gold_by(df: DataFrame, keys: Sequence[str | Column], views: str, likes: str, comments: str, duration: str) -> DataFrame:
    """Per group: videos, views, mean duration and engagement; partial sums before the shuffle."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("videos"),
        F.sum(views).alias("views"),
        F.avg(duration).alias("avg_duration"),
        engagement(F.sum(likes), F.sum(comments), F.sum(views)).alias("engagement"),
    )


def growth(
    snapshots: DataFrame, key: str, order: Sequence[Column], measures: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    """Change of each measure since the key's previous snapshot, NULL on its first."""
    before = with_previous(snapshots, [key], order, {f"previous_{m}": m for m in measures}, hot)
    deltas = {f"{m}_delta": F.col(m) - F.col(f"previous_{m}") for m in measures}
    return before.withColumns(deltas).drop(*[f"previous_{m}" for m in measures])


def name_history(
    snapshots: DataFrame, key: str, name: str, ts: str, tie: Sequence[str] = (), hot: HotKeys | None = None
) -> DataFrame:
    """One row per spell of an unchanged name: version, valid_from, valid_to (NULL while current)."""
    hot = hot or hot_keys(snapshots, [key])
    ascending = [F.col(c).asc() for c in (ts, *tie)]
    descending = [F.col(c).desc() for c in (ts, *tie)]
    shown = snapshots.withColumn("__one", F.lit(True))
    marked = with_previous(shown, [key], ascending, {"__name": name, "__before": "__one"}, hot)
    # A change to or from NULL is a change; only the first row has nothing before it.
    changed = F.col("__before").isNull() | ~F.col("__name").eqNullSafe(F.col(name))
    starts = marked.where(changed).drop("__name", "__before", "__one")
    ended = with_previous(hot.settled(starts), [key], descending, {"valid_to": ts}, hot)
    numbered = sequence_number(hot.settled(ended), [key], ascending, "version", hot)
    return numbered.select(key, "version", name, F.col(ts).alias("valid_from"), "valid_to")


def since_month(df: DataFrame, cutoff: datetime, year: str = "year", month: str = "month") -> DataFrame:
    """Retention on the partition columns: whole folders before the cutoff month are never listed."""
    y, m = f"{cutoff:%Y}", f"{cutoff:%m}"
    return df.where((F.col(year) > y) | ((F.col(year) == y) & (F.col(month) >= m)))


def in_hours(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Hours in ``[start, end)`` by zero-padded partition columns; prunes folders, reads no file."""
    names = ("year", "month", "day", "hour")
    stamp = F.concat(*[F.col(n) for n in names])
    return df.where((stamp >= f"{start:%Y%m%d%H}") & (stamp < f"{end:%Y%m%d%H}"))
