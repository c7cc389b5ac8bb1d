"""Choosing what a run works on: driving join, bound, dedup, cap, batches, lookup, enrichment.

Joins carry no broadcast hint unless the side's size was measured. Elsewhere Catalyst and AQE pick
the strategy from table and shuffle sizes and split skewed partitions; the right-hand sides
(channels, watermarks, distinct ids) have one row per key, so only the left side can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.scalars import BATCH_SIZE, LOOKBACK_MINUTES, lookback
from freshet.operators.skew import HotKeys, first_per_key, sequence_number


def is_kind(kind: Column, wanted: str = "video") -> Column:
    """A qualified kind such as ``service#video`` counts as ``video``."""
    return F.substring_index(kind, "#", -1) == wanted


def of_kind(df: DataFrame, kind: str, wanted: str = "video") -> DataFrame:
    return df.where(is_kind(F.col(kind), wanted))


def driven_by(df: DataFrame, driving: DataFrame, key: str) -> DataFrame:
    """Rows whose key is on the driving list."""
    return df.join(driving.select(key), key, "left_semi")


def distinct_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key with the smallest value of each ``order`` column; NULL keys are rejected.

    Aggregates on the map side, so a third of all rows being copies of one id is harmless.
    """
    usable = df.where(_all_present(keys))
    if not order:
        return usable.select(*keys).distinct()
    return usable.groupBy(*keys).agg(*[F.min(c).alias(c) for c in order])


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def with_bound(
    df: DataFrame, watermark: DataFrame, key: str, fetched: str, minutes: int = LOOKBACK_MINUTES
) -> DataFrame:
    """Attach each key's lower bound (watermark minus overlap); NULL on a first run."""
    bounds = watermark.select(key, lookback(fetched, minutes).alias("bound"))
    return df.join(bounds, key, "left")


def after_bound(ts: str) -> Column:
    return F.col("bound").isNull() | F.col(ts).isNull() | (F.col(ts) > F.col("bound"))


def incremental_filter(
    df: DataFrame, watermark: DataFrame, key: str, ts: str, fetched: str, minutes: int = LOOKBACK_MINUTES
) -> DataFrame:
    """Rows published after their key's bound; no bound or no publish time keeps the row."""
    return with_bound(df, watermark, key, fetched, minutes).where(after_bound(ts)).drop("bound")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, the first in ``order``; ties end with the remaining columns, largest
    first, so the choice is the same on every attempt. Copies are dropped on the map side."""
    rest = [F.col(c).desc() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def seen_among(
    df: DataFrame, ledger: DataFrame, keys: Sequence[str], small: bool, keep: Sequence[str] = ()
) -> DataFrame:
    """The ledger keys (and ``keep`` columns) that can matter for ``df``.

    A small increment is broadcast against the large ledger, which is then only scanned and never
    shuffled. Callers pass ``small = fits_broadcast(df)`` once ``df`` is a written table, so that
    measuring it costs a scan of the key columns and not its whole lineage. Otherwise this is the
    whole ledger, left to a shuffled join.
    """
    names = list(keys)
    known = ledger.select(*names, *keep)
    if not small:
        return known
    return known.join(F.broadcast(df.select(*names).distinct()), names, "left_semi")


def anti_seen(df: DataFrame, ledger: DataFrame, keys: Sequence[str], small: bool = False) -> DataFrame:
    """Rows whose key is not in the ledger. Duplicates stay; NULL keys are rejected.

    ``small`` is for an increment that was measured, see ``seen_among``.
    """
    usable = df.where(_all_present(keys))
    return usable.join(seen_among(usable, ledger, keys, small), list(keys), "left_anti")


def late_items(
    df: DataFrame,
    watermark: DataFrame,
    ledger: DataFrame,
    key: str,
    item: str,
    ts: str,
    fetched: str,
    minutes: int = LOOKBACK_MINUTES,
) -> DataFrame:
    """Items at or below the bound that no run has ever taken."""
    below = with_bound(df, watermark, key, fetched, minutes).where(F.col(ts) <= F.col("bound"))
    return anti_seen(below, ledger, [key, item])


def state_of(df: DataFrame, watermark: DataFrame, key: str, fetched: str) -> DataFrame:
    """Every row with its key's state; keys without one get the first-run default."""
    state = watermark.select(key, fetched)
    return df.join(state, key, "left").withColumn("has_state", F.col(fetched).isNotNull())


def lookup(details: DataFrame, ids: DataFrame, item: str) -> tuple[DataFrame, DataFrame]:
    """(details of the wanted ids, wanted ids without details)"""
    found = details.join(ids.select(item), item, "left_semi")
    missing = ids.join(details.select(item), item, "left_anti")
    return found, missing


def enrich(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Many-to-one inner join; the dimension must hold one row per key.

    No hint: Catalyst broadcasts a dimension its statistics show to be small, AQE one that turns out
    small, and beyond that the sort-merge join splits the partitions of hot keys.
    """
    return df.join(dimension.select(key, *columns), key)


def cap_per_key(
    df: DataFrame,
    key: str,
    item: str,
    order: Sequence[Column],
    n: int,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The first ``n`` rows per key, with their rank in ``rn``."""
    return first_per_key(df, [key], order, n, spread=[item], hot=hot)


def beyond_cap(df: DataFrame, selected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What the cap left for later runs: joins on the unique id, so no key is hot."""
    return df.join(selected.select(*keys), list(keys), "left_anti")


def page_numbers(
    df: DataFrame, key: str, order: Sequence[Column], size: int = BATCH_SIZE, hot: HotKeys | None = None
) -> DataFrame:
    """Rank every row within its key and cut the ranking into pages of ``size`` rows."""
    ranked = sequence_number(df, [key], order, hot=hot)
    return ranked.withColumn("batch_no", F.floor((F.col("rn") - 1) / size))


def request_batches(
    df: DataFrame,
    key: str,
    item: str,
    order: Sequence[Column],
    size: int = BATCH_SIZE,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Comma-joined ids in order, at most ``size`` per batch; no group exceeds ``size`` rows."""
    paged = page_numbers(df, key, order, size, hot)
    ordered = F.sort_array(F.collect_list(F.struct("rn", F.col(item).cast("string").alias("item"))))
    return paged.groupBy(key, "batch_no").agg(
        F.array_join(F.transform(ordered, lambda s: s["item"]), ",").alias("ids"),
        F.count(F.lit(1)).alias("n"),
    )
