"""Ancestors of animals from a table of parents: paths, lines, common ancestors and inbreeding.

Parents stand in columns of one table, so an animal's ancestors are a closure
over joins. Both closures double what they know in each round: paths of up to
k generations meet those of their last ancestor and reach 2k. Ancestors with a
large share of all descendants are joined by a broadcast of bounded length.
A path never visits an animal twice, which ends cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.operators.skew import joined_by_hot_key
from paceline.sources.shared import kept


def ancestor_paths(parents: DataFrame, animal: str, sire: str, dam: str, generations: int) -> DataFrame:
    """Every path of up to ``generations`` from an animal to an ancestor: ``animal``, ``side`` (of the first step), ``ancestor``, ``steps`` and the ``path`` with the ancestor at its end.

    ``parents`` has one row an animal; a null parent is unknown, an animal
    that is its own parent has none. An animal has at most 2 ** (generations +
    1) - 2 paths.
    """
    sides = F.explode(F.array(F.struct(F.lit("sire").alias("side"), F.col(sire).alias("parent")), F.struct(F.lit("dam").alias("side"), F.col(dam).alias("parent")))).alias("step")
    steps = parents.where(F.col(animal).isNotNull()).select(F.col(animal).alias("animal"), sides).select("animal", "step.*").where("parent is not null and parent <> animal")
    known = kept(steps.select("animal", "side", F.array("parent").alias("path")), "paths")
    reach = 1
    while reach < generations:
        more = min(reach, generations - reach)
        ends = known.where(F.size("path") == reach).withColumn("end", F.element_at("path", -1))
        onward = known.where(F.size("path") <= more).groupBy(F.col("animal").alias("end")).agg(F.collect_list("path").alias("onward"))
        met = joined_by_hot_key(ends, onward, "end").select("animal", "side", "path", F.explode("onward").alias("next"))
        fresh = met.where(~F.arrays_overlap("path", "next") & ~F.array_contains("next", F.col("animal"))).select("animal", "side", F.concat("path", "next").alias("path"))
        known = kept(known.unionByName(fresh), "paths")
        reach += more
    return known.select("animal", "side", F.element_at("path", -1).alias("ancestor"), F.size("path").alias("steps"), "path")


def inbreeding(paths: DataFrame, rounds: int = 3) -> DataFrame:
    """Wright's coefficient of each animal with a common ancestor of its parents: ``animal``, ``n_common``, ``nearest`` (steps there and back) and ``inbreeding``.

    Sums (1/2) ** (steps of both sides - 1) * (1 + F of the ancestor) over all
    pairs of paths that meet in the ancestor only. The ancestors' own
    coefficients are worked out in ``rounds`` rounds over the same paths.
    """
    side = lambda s: paths.where(F.col("side") == s).select("animal", "ancestor", F.col("steps").alias(f"{s}_steps"), F.slice("path", F.lit(1), F.size("path") - 1).alias(f"{s}_way"))
    pairs = side("sire").join(side("dam"), ["animal", "ancestor"]).where(~F.arrays_overlap("sire_way", "dam_way"))
    pairs = kept(pairs.select("animal", "ancestor", (F.col("sire_steps") + F.col("dam_steps")).alias("steps")), "pairs")
    share = F.pow(F.lit(0.5), F.col("steps") - 1)
    total = lambda df, value: df.groupBy("animal").agg(F.countDistinct("ancestor").alias("n_common"), F.min("steps").alias("nearest"), F.sum(value).alias("inbreeding"))
    out = total(pairs, share)
    for _ in range(rounds - 1):
        of = kept(out, "inbreeding").select(F.col("animal").alias("ancestor"), F.col("inbreeding").alias("own"))
        inbred = joined_by_hot_key(pairs, of, "ancestor")
        plain = pairs.join(inbred.select("ancestor").distinct(), "ancestor", "left_anti").withColumn("own", F.lit(0.0))
        out = total(inbred.unionByName(plain), share * (1 + F.col("own")))
    return out


def lines(parents: DataFrame, animal: str, parent: str) -> DataFrame:
    """The line of one parent, such as sires of sires: ``animal``, ``founder`` (the first known of the line) and ``depth`` (steps to it).

    A founder is its own founder at depth 0. Animals whose line runs into a
    cycle have neither. Each round doubles the steps, so the number of rounds
    is the logarithm of the longest line.
    """
    own = parents.where(F.col(animal).isNotNull()).select(F.col(animal).alias("animal"), F.col(parent).alias("up"))
    missing = own.where("up is not null").select(F.col("up").alias("animal")).distinct().join(own.select("animal"), "animal", "left_anti").withColumn("up", F.lit(None).cast(own.schema["up"].dataType))
    every = own.unionByName(missing)
    now = kept(every.select("animal", F.coalesce("up", "animal").alias("at"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("up").isNull().alias("done")), "lines")
    n, reach = now.count(), 1
    while reach < n:
        open_now = now.where("not done")
        if open_now.isEmpty():
            break
        ahead = now.select(F.col("animal").alias("at"), F.col("at").alias("next"), F.col("depth").alias("more"), F.col("done").alias("ends"))
        moved = joined_by_hot_key(open_now, ahead, "at").select("animal", F.col("next").alias("at"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        now = kept(now.where("done").unionByName(moved), "lines")
        reach *= 2
    # What is still open after more steps than there are animals goes round in a cycle.
    return now.select("animal", F.when(F.col("done"), F.col("at")).alias("founder"), F.when(F.col("done"), F.col("depth")).alias("depth"))
