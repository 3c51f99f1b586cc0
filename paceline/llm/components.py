"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.spread import discard, stored

MAX_ROUNDS = 60


def _star(pairs: DataFrame, keep_self: bool) -> DataFrame:
    """Link each neighbour v of u to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = pairs.join(least, "u")
    if keep_self:
        own = least.select(F.col("u").alias("v"), "m")
        out = linked.select("v", "m").unionByName(own)
    else:
        out = linked.where("v > u").select("v", "m")
    return out.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node with an edge to another.

    ``edges`` has two columns of longs. Each round is written to the shared
    folder, and the round before deleted; nothing is gathered on the driver
    but a count and a hash.
    """
    a, b = edges.columns[:2]
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "cc")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    before = mark(now)
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, False)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        last, now = now, stored(_star(down, True), "cc")
        discard(last)
        after = mark(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = after
    raise RuntimeError("components did not converge")
