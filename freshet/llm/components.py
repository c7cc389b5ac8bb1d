"""Connected components of links too many for one machine.

Large-star and small-star steps in turn: every node hands its larger neighbours, then itself and its
smaller ones, to the smallest node it knows, until nothing changes. Links become stars around the
smallest node of each component in a number of rounds that grows with the logarithm of its size. Each
step aggregates before it shuffles, and each round is written to the shared folder, in as many files as
the number of links asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import frozen


#: Links of a task and file, about; fewer are not dealt out to more.
LINKS = 50_000


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of the links ``u, v`` (integers): the smallest node it reaches.

    Loops, repeated and reversed links and NULL ends change nothing; no links give no rows.
    """
    pairs = links.where("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    stars = frozen(pairs, "links")
    before = _state(stars)
    if not before[0]:
        return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(rounds):
        files = -(-before[0] // LINKS)
        both = stars.union(stars.select("v", "u").toDF("u", "v"))
        # Written, so that the join reads both sides by plain exchanges and can split a hot node.
        least = frozen(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(files), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # All links now go from a node to a smaller one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        stars = frozen(small.where("u != v").distinct().coalesce(files), "stars")
        after = _state(stars)
        if after == before:
            leaders = stars.select("v").distinct()
            return stars.toDF("node", "component").union(leaders.select("v", F.col("v").alias("c")))
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")
