"""Weighted rendezvous hashing of record keys onto shards.

Every (key, shard) pair draws its own uniform number from a stable hash; the shard with the
smallest ``-ln(u) / weight`` owns the key. A new shard only ever wins keys for itself, a removed one
only gives its own away, and a shard's share follows its weight. No state, no shuffle.

Defined results: a NULL key is hashed like any other value, all its rows share a shard; a NULL text
has size 1 and the checksum of the empty text; repeated rows share a shard and get slots of their
own; an empty table gives an empty result. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.session import frozen

#: Slots are counted in so many blocks of a shard, so that no shard is numbered by one task.
BLOCKS = 1024


def _cost(keys: Sequence[Column], shard: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def rendezvous(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """The number of the shard that owns the key; shards of weight 0 own nothing."""
    bids = [F.struct(_cost(keys, i, w).alias("cost"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    if not bids:
        raise ValueError("no shard has a weight above 0")
    return F.array_min(F.array(*bids))["shard"]


def numbered(df: DataFrame, shard: str, key: Sequence[str], blocks: int = BLOCKS) -> DataFrame:
    """``slot``: 0, 1, 2, ... within each shard, without a gap, in an order that only the rows decide.

    The blocks are counted first (shards x blocks rows, a fixed bound, broadcast); a row's slot is its
    block's offset plus its place there.
    """
    placed = df.withColumn("__block", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int"))
    counts = placed.groupBy(shard, "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy(shard, "__block").orderBy(*key)) - 1
    numbers = placed.withColumn("__within", within).join(F.broadcast(offsets), [shard, "__block"])
    return numbers.withColumn("slot", F.col("__offset") + F.col("__within")).drop("__block", "__offset", "__within", "__n")


def shard_documents(documents: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", new_weight: float = 1.0) -> DataFrame:
    """Shard, slot and checksum of each record, and its shard once one more of ``new_weight`` joins."""
    body = F.coalesce(F.col(text), F.lit(""))
    keys = [F.col(key)]
    sized = documents.select(
        F.col(key),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(keys, weights).alias("shard"),
        rendezvous(keys, [*weights, new_weight]).alias("grown_shard"),
    )
    table = frozen(sized, "shards")
    return numbered(table, "shard", [key, "text_crc32", "size"]).select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
