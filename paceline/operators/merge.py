"""Deduplication and merging of sources with explicit priority and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filled(c: str, kind: str = "string") -> Column:
    """A value that counts: not null, and not zero, false or empty."""
    x = F.col(c)
    if kind == "boolean":
        return x.isNotNull() & x
    if kind == "string":
        return x.isNotNull() & (x != "")
    if kind == "time":
        return x.isNotNull()
    return x.isNotNull() & (x != 0)


def completeness(columns: list[str]) -> Column:
    """How many of the columns are neither null nor empty."""
    return sum((F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 1).otherwise(0) for c in columns), F.lit(0))


def keep_most_complete(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """The most complete row of each key, the first in ``order`` on ties."""
    w = Window.partitionBy(*keys).orderBy(F.desc("_filled"), *order)
    return df.withColumn("_filled", completeness(columns)).withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k", "_filled")


def newest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def last_filled_wins(sources: list[DataFrame], keys: list[str], columns: list[str]) -> DataFrame:
    """Union of the sources' keys; for each column the last source that fills it wins. Adds the number of sources.

    One shuffle on the key for any number of sources, where chained outer joins take one each.
    """
    tagged = [s.select(*keys, *(c if c in s.columns else F.lit(None).alias(c) for c in columns), F.lit(i).alias("_src")) for i, s in enumerate(sources)]
    both = reduce(lambda a, b: a.unionByName(b), tagged)
    types = dict(both.dtypes)
    ok = lambda c: filled(c, types[c] if types[c] in ("boolean", "string") else "time" if types[c].startswith(("date", "timestamp")) else "number")
    # a null order value never wins, so the greatest source number among filled values decides
    picked = [F.max_by(c, F.when(ok(c), F.col("_src"))).alias(c) for c in columns]
    return both.groupBy(*keys).agg(*picked, F.count_distinct("_src").cast("int").alias("n_sources"))


def prefixed(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, *(F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys))


def prefixed_left_join(base: DataFrame, side: DataFrame, keys: list[str], prefix: str, once: list[Column]) -> DataFrame:
    """Base rows with one side row's columns under a prefix; columns that the base has already keep its filled values."""
    right = prefixed(newest(side, keys, once), prefix, keys)
    clash = [c for c in right.columns if c in base.columns and c not in keys]
    right = right.withColumnsRenamed({c: f"_new_{c}" for c in clash})
    out = base.join(right, keys, "left")
    return out.withColumns({c: F.coalesce(c, f"_new_{c}") for c in clash}).drop(*(f"_new_{c}" for c in clash))


def outer_with_provenance(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], names: tuple[str, str]) -> DataFrame:
    """Full outer merge: the left value if there is one, and where the row comes from."""
    a = left.select(*keys, *(F.col(c).alias(f"_a_{c}") for c in columns if c in left.columns), F.lit(True).alias("_a"))
    b = right.select(*keys, *(F.col(c).alias(f"_b_{c}") for c in columns if c in right.columns), F.lit(True).alias("_b"))
    both = a.join(b, keys, "full")
    value = lambda c: F.coalesce(*(x for x in (f"_a_{c}", f"_b_{c}") if x in both.columns))
    source = F.concat_ws("+", F.when(F.col("_a"), names[0]), F.when(F.col("_b"), names[1]))
    return both.select(*keys, *(value(c).alias(c) for c in columns), source.alias("source"))


def with_orphans(base: DataFrame, side: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Base rows with the side's columns, and the side's rows that have no base row."""
    joined = base.join(side.select(*keys, *columns), keys, "left").withColumn("orphan", F.lit(False))
    orphans = side.join(base, keys, "left_anti").select(*keys, *columns).withColumn("orphan", F.lit(True))
    return joined.unionByName(orphans, allowMissingColumns=True)


def fallback_join(base: DataFrame, side: DataFrame, first: list[str], second: list[str], columns: list[str], once: list[Column]) -> DataFrame:
    """Match on the first keys, else on the second: two equi-joins, never a join on either."""
    a = newest(side, first, once).select(*first, *(F.col(c).alias(f"_1_{c}") for c in columns), F.lit(1).alias("_m1"))
    b = newest(side, second, once).select(*second, *(F.col(c).alias(f"_2_{c}") for c in columns), F.lit(2).alias("_m2"))
    out = base.join(a, first, "left").join(b, second, "left")
    out = out.withColumns({c: F.when(F.col("_m1").isNotNull(), F.col(f"_1_{c}")).otherwise(F.col(f"_2_{c}")) for c in columns}).withColumn("matched_by", F.coalesce("_m1", "_m2", F.lit(0)))
    return out.drop("_m1", "_m2", *(f"_{k}_{c}" for k in (1, 2) for c in columns))


def majority(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Golden record in long form: the commonest filled value of each field with its confidence and number of rivals.

    Rows go to their key before the votes are counted: counted first, nearly
    each row's fields would stand in the memory of its task as groups of their own.
    """
    dealt = df.select(*keys, *fields).repartition(*keys)
    long = dealt.select(*keys, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("x")).select(*keys, "x.*").where("value is not null and value <> ''")
    votes = long.groupBy(*keys, "field", "value").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy(*keys, "field")
    ranked = votes.withColumns({"total": F.sum("votes").over(w), "n_values": F.count(F.lit(1)).over(w), "_k": F.row_number().over(w.orderBy(F.desc("votes"), "value"))})
    return ranked.where("_k = 1").select(*keys, "field", "value", "votes", (F.col("votes") / F.col("total")).alias("confidence"), (F.col("n_values") - 1).alias("conflicts"))


def pivot_ordinals(df: DataFrame, keys: list[str], kind: str, kinds: list[str], value: str, order: list[str], most: int) -> DataFrame:
    """Long to wide with an ordinal for repeated kinds: kind_1, kind_2, ... up to ``most``, and all after them in order in kind_rest."""
    w = Window.partitionBy(*keys, kind).orderBy(*order)
    numbered = df.withColumn("_n", F.row_number().over(w))
    cells = [F.max(F.when((F.col(kind) == k) & (F.col("_n") == i), F.col(value))).alias(f"{k.lower()}_{i}") for k in kinds for i in range(1, most + 1)]
    later = lambda k: F.sort_array(F.collect_list(F.when((F.col(kind) == k) & (F.col("_n") > most), F.struct("_n", F.col(value).cast("string").alias("v")))))
    return numbered.groupBy(*keys).agg(*cells, *(F.array_join(later(k)["v"], "-").alias(f"{k.lower()}_rest") for k in kinds))


def fill_holes(first: DataFrame, second: DataFrame, keys: list[str], columns: list[str], identity: list[str], names: tuple[str, str]) -> DataFrame:
    """Full outer merge where the first's nulls are filled from the second.

    Identity columns of a row that the first has are never taken from the second.
    """
    own = lambda df, p: df.select(*keys, *(F.col(c).alias(f"_{p}_{c}") for c in [*columns, *identity]), F.lit(True).alias(f"_{p}"))
    both = own(first, "a").join(own(second, "b"), keys, "full")
    taken = [F.when(F.col("_a"), F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in identity]
    return both.select(*keys, *taken, *(F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns), F.concat_ws("+", F.when(F.col("_a"), names[0]), F.when(F.col("_b"), names[1])).alias("source"))


def two_key_merge(first: DataFrame, second: DataFrame, key1: list[str], key2: list[str], columns: list[str], once: list[Column]) -> DataFrame:
    """Rows of the first with the second's columns by key 1, else by key 2; then the second's rows that neither key matches."""
    by1 = second.select(*key1, *(F.col(c).alias(f"_1_{c}") for c in columns), F.lit(True).alias("_m1"))
    by2 = newest(second, key2, once).select(*key2, *(F.col(c).alias(f"_2_{c}") for c in columns), F.lit(True).alias("_m2"))
    out = first.join(by1, key1, "left").join(by2, key2, "left")
    matched = F.when(F.col("_m1"), "first").when(F.col("_m2"), "second").otherwise("none")
    out = out.select(*first.columns, *(F.when(F.col("_m1"), F.col(f"_1_{c}")).otherwise(F.col(f"_2_{c}")).alias(c) for c in columns), matched.alias("matched"))
    rest = second.join(first, key1, "left_anti").join(first, key2, "left_anti")
    return out.unionByName(rest.withColumn("matched", F.lit("only second")), allowMissingColumns=True)


def key_overlap(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """Shared and own keys of each pair of sources: one shuffle of all keys, then a few sums; no source meets another in a join."""
    tagged = reduce(lambda a, b: a.unionByName(b), [df.select(F.col(key).alias("_key"), F.lit(n).alias("_s")).distinct() for n, df in sources.items()])
    held = tagged.groupBy("_key").agg(*(F.max((F.col("_s") == n).cast("int")).alias(n) for n in sources))
    names = list(sources)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    one = lambda a, b: F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.sum(F.col(a) * F.col(b)).alias("shared"), F.sum(F.col(a) * (1 - F.col(b))).alias("only_a"), F.sum(F.col(b) * (1 - F.col(a))).alias("only_b"))
    out = held.agg(F.array(*(one(a, b) for a, b in pairs)).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return out.withColumn("percent", F.round(F.try_divide(100.0 * F.col("shared"), F.col("shared") + F.col("only_a") + F.col("only_b")), 6))
