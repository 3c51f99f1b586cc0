"""Joins whose keys must be found first: names by their longest known prefix, columns by what they hold or how they are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.operators.skew import joined_by_hot_key


def plain(name: Column) -> Column:
    """A name in lower case, with single spaces, without what isn't a letter or a digit."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


def longest_prefix(df: DataFrame, name: str, known: DataFrame, known_name: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the ``value`` of the longest known name that the row's name begins with, word by word, and ``<out>_rest`` (the words after it).

    A name that is known itself is its own longest prefix. Each different name
    is cut into its word prefixes once, and these meet the known names by an
    equi-join. Of known names that are equal once plain, the smallest value
    counts. Names without a match, and null names, have nulls.
    """
    words = F.split(plain(F.col(name)), " ")
    names = df.where(F.col(name).isNotNull()).select(F.col(name).alias("_name")).distinct().withColumn("_words", F.split(plain(F.col("_name")), " "))
    prefixes = names.select("_name", F.size("_words").alias("_n"), F.explode(F.sequence(F.lit(1), F.size("_words"))).alias("_k"), "_words").select("_name", "_n", "_k", F.array_join(F.slice("_words", F.lit(1), F.col("_k")), " ").alias("_prefix"))
    table = known.where(F.col(known_name).isNotNull()).groupBy(plain(F.col(known_name)).alias("_prefix")).agg(F.min(value).alias("_value")).where("_prefix <> ''")
    met = joined_by_hot_key(prefixes, table, "_prefix")
    best = met.withColumn("_r", F.row_number().over(Window.partitionBy("_name").orderBy(F.desc("_k")))).where("_r = 1").select("_name", "_value", "_k")
    found = joined_by_hot_key(df.where(F.col(name).isNotNull()).withColumn("_name", F.col(name)), best, "_name")
    rest = F.array_join(F.slice(words, F.col("_k") + 1, F.greatest(F.size(words) - F.col("_k"), F.lit(0))), " ")
    hit = found.select(*df.columns, F.col("_value").alias(out), rest.alias(f"{out}_rest"))
    missed = df.join(best.select(F.col("_name").alias(name)), name, "left_anti").select(*df.columns)
    kind = dict(known.dtypes)[value]
    return hit.unionByName(missed.withColumns({out: F.lit(None).cast(kind), f"{out}_rest": F.lit(None).cast("string")}))


def column_matches(left: DataFrame, right: DataFrame, least: float = 0.5, least_values: int = 20) -> DataFrame:
    """Pairs of columns that hold the same values: ``left_column``, ``right_column``, ``contained`` (share of the smaller side's values that the other has).

    Each table is scanned once and no name is looked at. Each different value
    is shuffled once, with one bit for every column that holds it, so the
    figures are exact. Columns with fewer than ``least_values`` values match
    anything and are left out.
    """
    flat = lambda df: [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct", "variant"))]
    sides = {"left": flat(left), "right": flat(right)}
    columns = [(side, c) for side, names in sides.items() for c in names]
    words = [f"_w{i}" for i in range(-(-len(columns) // 62))]

    def cells(df: DataFrame, side: str) -> DataFrame:
        bit = lambda at, i: F.lit(1 << (at % 62) if at // 62 == i else 0).cast("long")
        places = [(columns.index((side, c)), c) for c in sides[side]]
        each = (F.struct(F.col(c).cast("string").alias("value"), *(bit(at, i).alias(w) for i, w in enumerate(words))) for at, c in places)
        return df.select(F.explode(F.array(*each)).alias("x")).select("x.*").where("value is not null")

    held = cells(left, "left").unionByName(cells(right, "right")).groupBy("value").agg(*(F.bit_or(w).alias(w) for w in words))
    masks = held.groupBy(*words).agg(F.count(F.lit(1)).alias("_n"))
    has = lambda i: F.col(words[i // 62]).bitwiseAND(F.lit(1 << (i % 62)).cast("long")) != 0
    in_side = lambda side: F.array_compact(F.array(*(F.when(has(i), F.lit(c)) for i, (s, c) in enumerate(columns) if s == side)))
    masks = masks.select("_n", in_side("left").alias("_left"), in_side("right").alias("_right"))
    size = lambda side: masks.select("_n", F.explode(f"_{side}").alias(f"{side}_column")).groupBy(f"{side}_column").agg(F.sum("_n").alias(f"{side}_n")).where(F.col(f"{side}_n") >= least_values)
    both = masks.select("_n", F.explode("_left").alias("left_column"), "_right").select("_n", "left_column", F.explode("_right").alias("right_column")).groupBy("left_column", "right_column").agg(F.sum("_n").alias("both"))
    share = F.col("both") / F.least("left_n", "right_n")
    return both.join(F.broadcast(size("left")), "left_column").join(F.broadcast(size("right")), "right_column").select("left_column", "right_column", share.alias("contained")).where(F.col("contained") >= least)


def named_column(df: DataFrame, candidates: list[str], share: float = 0.5) -> str | None:
    """The first candidate that is a column with a value in more than ``share`` of the rows; one scan for all."""
    here = [c for c in candidates if c in df.columns]
    if not here:
        return None
    row = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count(c).alias(c) for c in here)).first()
    return next((c for c in here if row[c] > share * row["_n"]), None)
