"""Run counters, totals, audit rows and alerts: partial aggregation only, nothing on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.scalars import calls_saved, quota_units


def flagged(df: DataFrame, marks: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``df`` with a boolean telling whether its (unique) key occurs in ``marks``."""
    return df.join(marks.select(*keys).distinct().withColumn(flag, F.lit(True)), list(keys), "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def run_counters(items: DataFrame, key: str, cap: int) -> DataFrame:
    """Found, cached, new and selected per key; ``items`` has one row per id and a ``cached`` flag."""
    counted = items.groupBy(key).agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("cached")).alias("cached"),
    )
    new = F.col("found") - F.col("cached")
    return counted.withColumn("new", new).withColumn("selected", F.least(new, F.lit(cap)))


def run_totals(counters: DataFrame, videos: str) -> DataFrame:
    return counters.agg(
        F.count(F.lit(1)).alias("channels_processed"),
        F.coalesce(F.sum(videos), F.lit(0)).cast("bigint").alias("videos_collected"),
    )


def all_success(outcomes: DataFrame, success: Column | str) -> DataFrame:
    column = F.col(success) if isinstance(success, str) else success
    return outcomes.agg(F.coalesce(F.bool_and(column), F.lit(True)).alias("all_success"))


def upload_status(requested: bool, target: str | None, succeeded: bool = True) -> str:
    """Outcome text of an export that may not have been asked for."""
    if not requested or not target:
        return "skipped"
    return "ok" if succeeded else "failed"


def quota_estimate(counters: DataFrame, videos: str) -> DataFrame:
    return counters.agg(
        quota_units(F.count(F.lit(1)), F.coalesce(F.sum(videos), F.lit(0))).alias("units")
    )


def alert_reason(min_videos: int = 1) -> Column:
    """Why somebody should look at an audit row, or NULL."""
    return F.when(F.col("status") == "failed", "failed channel").when(F.col("retrieved") < min_videos, "too few videos")


def audit_alerts(audit: DataFrame, key: str, min_videos: int = 1) -> DataFrame:
    """Audit rows somebody should look at, with the reason."""
    return audit.withColumn("alert", alert_reason(min_videos)).where(F.col("alert").isNotNull()).select(key, "status", "retrieved", "alert")


def summary_metrics(min_videos: int = 1) -> dict[str, Column]:
    """Totals of an audit table, to be observed while it is written or aggregated afterwards."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    ok = F.count_if(F.col("status") == "ok")
    return {
        "channels": ok,
        "failed_channels": F.count_if(F.col("status") != "ok"),
        **{name: total(name) for name in ("found", "cached", "selected")},
        "videos": total("retrieved"),
        "alerts": F.count(alert_reason(min_videos)),
        "calls_saved": F.coalesce(F.sum(calls_saved("cached")), F.lit(0)),
        "quota_units": quota_units(ok, total("retrieved")),
    }
