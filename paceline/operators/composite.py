"""Wide tables put together from many sources, with the owner of every column stated."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Side:
    """A source of columns: one row a key, by ``once`` if it has more; ``columns`` maps its names to those in the result."""

    name: str
    df: DataFrame
    columns: dict[str, str]
    once: list[str] = field(default_factory=list)


def _one_row(side: Side, keys: list[str]) -> DataFrame:
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    rows = side.df.where(known)
    if side.once:
        rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*side.once))).where("_r = 1")
    return rows.select(*keys, *(F.col(c).alias(n) for c, n in side.columns.items()))


def owners(base: list[str], sides: list[Side], rule: str) -> dict[str, list[str]]:
    """Sources of each new column, those that count most first: the later ones by the rule "last", the earlier ones by "first"; with "new" none that the base has."""
    out: dict[str, list[str]] = {}
    for s in sides:
        for n in s.columns.values():
            if rule != "new" or n not in base:
                out.setdefault(n, []).append(s.name)
    return {n: v[::-1] if rule == "last" else v for n, v in out.items()}


def joined(base: DataFrame, sides: list[Side], keys: list[str], rule: str = "last", filled_only: bool = False) -> DataFrame:
    """``base`` with the columns of all ``sides`` by one key, in one grouping and one join however many sides there are.

    Of the sources of a column the one that ``rule`` puts first decides, among
    those that have the key, with its null too unless ``filled_only``. By
    "last" and "first" a column of the base is replaced where a side has the
    key; by "new" the base keeps its own and the first side gives what is new.
    """
    owned = owners(base.columns, sides, rule)
    slim = [_one_row(s, keys).withColumn("_side", F.lit(s.name)) for s in sides]
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slim)

    def pick(column: str) -> Column:
        rank = F.coalesce(*(F.when(F.col("_side") == name, F.lit(len(owned[column]) - i)) for i, name in enumerate(owned[column])))
        counts = rank.isNotNull() & F.col(column).isNotNull() if filled_only else rank.isNotNull()
        return F.max(F.when(counts, F.struct(rank.alias("rank"), F.col(column).alias("value")))).alias(column)

    found = long.groupBy(*keys).agg(*map(pick, owned))
    new = found.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in owned))
    out = base.join(new, keys, "left")
    value = lambda c: F.when(F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}")["value"])
    cols = {c: F.when(F.col(f"_new_{c}").isNotNull(), value(c)).otherwise(F.col(c)) if c in base.columns else value(c) for c in owned}
    return out.select(*(cols.pop(c).alias(c) if c in cols else F.col(c) for c in base.columns), *(v.alias(c) for c, v in cols.items()))


def by_priority(sources: dict[str, DataFrame], key: str, fields: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """One row for every key of any source; each field from the first (source, column) of its list that fills it, and ``sources``, the names that have the key.

    One shuffle. Null and empty values don't fill a field. A source has one
    row a key; of more the greatest value counts.
    """
    used = {n: {c for uses in fields.values() for s, c in uses if s == n} for n in sources}
    parts = [df.where(F.col(key).isNotNull()).select(F.col(key), F.lit(n).alias("_source"), *(F.col(c).alias(f"{n}.{c}") for c in sorted(used[n]))) for n, df in sources.items()]
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    wide = long.groupBy(key).agg(F.array_sort(F.collect_set("_source")).alias("sources"), *(F.max(f"`{n}.{c}`").alias(f"{n}.{c}") for n in sources for c in sorted(used[n])))
    one = lambda uses: F.coalesce(*(F.when(F.col(f"`{s}.{c}`").cast("string") != "", F.col(f"`{s}.{c}`")) for s, c in uses))
    return wide.select(key, *(one(uses).alias(f) for f, uses in fields.items()), "sources")


def enriched_or_orphan(base: DataFrame, side: DataFrame, keys: list[str], prefix: str, order: list[str], names: tuple[str, str]) -> DataFrame:
    """The first row of each key in ``base`` with the columns of ``side`` under a prefix, and rows of ``side`` alone where ``base`` has no such key; ``sources`` names who has it."""
    first = base.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r").withColumn("_in_base", F.lit(True))
    other = side.select(*keys, *(F.col(c).alias(f"{prefix}{c}") for c in side.columns if c not in keys)).dropDuplicates(keys).withColumn("_in_side", F.lit(True))
    both = first.join(other, keys, "full")
    named = F.concat_ws("+", F.when(F.col("_in_base"), names[0]), F.when(F.col("_in_side"), names[1]))
    return both.withColumn("sources", named).drop("_in_base", "_in_side")


def careers(df: DataFrame, entity: str, part: str, order: list[str], fields: list[str]) -> DataFrame:
    """An entity's rows as arrays of structs in order, one array for each ``part`` (such as a year), which bounds it; with the number of rows."""
    rows = F.array_sort(F.collect_list(F.struct(*order, *(f for f in fields if f not in order))))
    return df.where(F.col(entity).isNotNull()).groupBy(entity, part).agg(rows.alias("rows"), F.count(F.lit(1)).alias("n"))


def daily(hours: DataFrame, keys: list[str], time: str, measures: dict[str, tuple[str, str]]) -> DataFrame:
    """Days from hours: ``measures`` maps a result to (column, min, max, sum or avg); missing hours are left out, a day without any has null."""
    how = {"min": F.min, "max": F.max, "sum": F.sum, "avg": F.avg}
    return hours.groupBy(*keys, F.col(time).cast("date").alias("date")).agg(*(F.round(how[f](c), 2).alias(n) for n, (c, f) in measures.items()))
