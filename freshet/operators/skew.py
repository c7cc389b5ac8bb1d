"""Ordered per-key operators that survive a key holding a large share of all rows.

A plain ``Window.partitionBy(key)`` puts a whole key into one task. Here only the keys whose group
is too large for one task (found by a pre-aggregated count) leave that path: their rows are
range-partitioned and sorted by (key, order) into segments, which gives every row its place in its
segment, and a small table with one row per (key, segment) carries the totals or the last row over
to the next segment.

Both limits are rows a task can hold, whatever the size of the table. The segment table has at most
``segments + hot keys`` rows, because range partitions hold contiguous keys. It and the hot keys are
broadcast up to ``BROADCAST_ROWS`` rows and joined by shuffle beyond.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.session import frozen

# A group below this many rows is always fine for one task.
HOT_ROWS = 1_000_000
# Spark limits groups before the shuffle only up to this rank (its default setting).
GROUP_LIMIT = 1_000
# Broadcast checks: a side may be broadcast below both.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_SEGMENT, _PLACE = "__segment", "__place"


@dataclass(frozen=True)
class HotKeys:
    """Keys too large for one task; ``frame`` is None when there are none.

    Found on a plain table and reused for whatever is derived from it by filters and joins that add
    no rows: a key that is ordinary in the table stays ordinary.
    """

    keys: tuple[str, ...]
    frame: DataFrame | None
    rows: int
    many: int = 0

    def settled(self, df: DataFrame) -> DataFrame:
        """``df`` written out if it is about to be split again, so that its lineage runs once."""
        return df if self.frame is None else frozen(df)

    def split(self, df: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """(rows of hot keys or None, all other rows)"""
        if self.frame is None:
            return None, df
        hot = F.broadcast(self.frame) if self.many <= BROADCAST_ROWS else self.frame
        return df.join(hot, list(self.keys), "left_semi"), df.join(hot, list(self.keys), "left_anti")


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> HotKeys:
    """Find the keys whose group does not fit one task; key columns must not be NULL."""
    floor = HOT_ROWS if hot_rows is None else hot_rows
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    if not largest or largest < floor:
        return HotKeys(tuple(keys), None, 0)
    large = frozen(sizes.where(F.col("n") >= floor))
    found = large.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("many")).first()
    return HotKeys(tuple(keys), large.select(*keys), found["rows"], found["many"])


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` before anyone broadcasts it: partial sums only, no rows move. Flat rows only."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for f in df.schema.fields):
        return False
    width = F.lit(16 * len(df.columns))
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def _segment_count(hot: HotKeys, segment_rows: int) -> int:
    return max(2, math.ceil(hot.rows / segment_rows))


def _beside(df: DataFrame, hot: HotKeys, segment_rows: int) -> DataFrame:
    """A table of one row per key and segment, with a broadcast hint if it is small enough."""
    return F.broadcast(df) if _segment_count(hot, segment_rows) + hot.many <= BROADCAST_ROWS else df


def _segments(df: DataFrame, hot: HotKeys, order: Sequence[Column], segment_rows: int) -> DataFrame:
    count = _segment_count(hot, segment_rows)
    by = [*[F.col(k).asc() for k in hot.keys], *order]
    ranged = df.repartitionByRange(count, *by).sortWithinPartitions(*by)
    # The row id counts up within a partition, so it holds the segment and the place in it. Both are
    # only stable once written: they depend on sampled range bounds.
    row = F.monotonically_increasing_id()
    return frozen(
        ranged.withColumn("__row", row)
        .withColumn(_SEGMENT, F.shiftright("__row", 33))
        .withColumn(_PLACE, F.col("__row").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__row"),
        "segments",
    )


def _by_key(hot: HotKeys, order: Sequence[Column]):
    return Window.partitionBy(*hot.keys).orderBy(*order)


def _by_segment(hot: HotKeys):
    return Window.partitionBy(*hot.keys, _SEGMENT).orderBy(_PLACE)


def sequence_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "rn",
    hot: HotKeys | None = None,
    segment_rows: int = HOT_ROWS,
) -> DataFrame:
    """1, 2, 3 … per key in ``order`` (must be total within a key)."""
    hot = hot or hot_keys(df, keys)
    large, rest = hot.split(df)
    numbered = rest.withColumn(name, F.row_number().over(_by_key(hot, order)).cast("bigint"))
    if large is None:
        return numbered
    cut = _segments(large, hot, order, segment_rows)
    sizes = cut.groupBy(*keys, _SEGMENT).agg(F.count(F.lit(1)).alias("__n"), F.min(_PLACE).alias("__low"))
    before = Window.partitionBy(*keys).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("__n").over(before), F.lit(0))
    starts = sizes.select(*keys, _SEGMENT, (earlier - F.col("__low") + 1).alias("__start"))
    placed = cut.join(_beside(starts, hot, segment_rows), [*keys, _SEGMENT]).withColumn(name, F.col(_PLACE) + F.col("__start"))
    return numbered.unionByName(placed.select(*numbered.columns))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    previous: dict[str, str],
    hot: HotKeys | None = None,
    segment_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add, per key in ``order``, the preceding row's value: ``{new column: source column}``."""
    hot = hot or hot_keys(df, keys)
    large, rest = hot.split(df)
    out = rest
    for name, source in previous.items():
        out = out.withColumn(name, F.lag(source).over(_by_key(hot, order)))
    if large is None:
        return out
    cut = _segments(large, hot, order, segment_rows)
    window = _by_segment(hot)
    local = cut.withColumn("__first", F.row_number().over(window) == 1).withColumn(
        "__last", F.lead(F.lit(1)).over(window).isNull()
    )
    for name, source in previous.items():
        local = local.withColumn(name, F.lag(source).over(window))
    carried = F.struct(*[F.col(source).alias(name) for name, source in previous.items()])
    tails = local.where("__last").select(*keys, _SEGMENT, carried.alias("__tail"))
    heads = tails.select(
        *keys, _SEGMENT, F.lag("__tail").over(Window.partitionBy(*keys).orderBy(_SEGMENT)).alias("__carry")
    )
    joined = local.join(_beside(heads, hot, segment_rows), [*keys, _SEGMENT])
    for name in previous:
        joined = joined.withColumn(name, F.when(F.col("__first"), F.col("__carry")[name]).otherwise(F.col(name)))
    return out.unionByName(joined.select(*out.columns))


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread: Sequence[str],
    hot: HotKeys | None = None,
    salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows per key, ranked in ``rn``. Each map task keeps only its own first ``n``
    (group limit); a hot key is narrowed per salt of the ``spread`` columns before its rows meet in
    one task. Beyond the group limit hot keys are numbered in segments instead."""
    hot = hot or hot_keys(df, keys)
    if hot.frame is not None and n > GROUP_LIMIT:
        return sequence_number(df, keys, order, "rn", hot).where(F.col("rn") <= n)
    large, rest = hot.split(df)
    if large is not None:
        salted = large.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
        narrow = Window.partitionBy(*keys, "__salt").orderBy(*order)
        kept = salted.withColumn("__rn", F.row_number().over(narrow)).where(F.col("__rn") <= n)
        rest = rest.unionByName(kept.drop("__salt", "__rn"))
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = rest.withColumn("rn", F.row_number().over(window)).where(F.col("rn") <= n)
    return ranked.withColumn("rn", F.col("rn").cast("bigint"))
