"""Cleaning by kind of field, fill rules, imputation, outliers and scaling; statistics of whole tables are one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.functions import scalars

STRATEGIES = ("mean", "median", "mode", "zero", "constant", "forward", "backward", "group_median")


def cleaner(kind: str, x: Column) -> Column:
    """The cleaned value of a field: a name's matching key, a text without null tokens, or the first whole number in it."""
    text = scalars.clean_null(F.trim(x))
    if kind == "name":
        return scalars.name_key(text)
    if kind == "number":
        return F.nullif(F.regexp_extract(text, "([0-9]+)", 1), F.lit("")).try_cast("long")
    return text


def clean(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Fields cleaned by their kinds, and in ``changes`` how many of them that changed."""
    made = {f"_{c}": cleaner(kind, F.col(c)) for c, kind in kinds.items()}
    out = df.withColumns(made)
    changes = sum((F.when(F.col(f"_{c}").cast("string").eqNullSafe(F.col(c)), 0).otherwise(1) for c in kinds), F.lit(0))
    out = out.withColumn("changes", changes)
    return out.select(*(F.col(f"_{c}").alias(c) if c in kinds else c for c in df.columns), "changes")


def fill_cascade(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Rules (column, value) applied in order to nulls, each seeing earlier fills; ``fills`` counts those of the row."""
    out = df.withColumn("fills", F.lit(0))
    for column, value in rules:
        out = out.withColumn("_new", F.coalesce(column, value)).withColumn("fills", F.col("fills") + F.when(F.col(column).isNull() & F.col("_new").isNotNull(), 1).otherwise(0)).drop(column).withColumnRenamed("_new", column)
    return out


def imputed(df: DataFrame, x: str, group: str, entity: str, order: list[str], constant: float = 0.0) -> DataFrame:
    """``x`` filled by each strategy in a column of its own; forward and backward fills stay within the entity.

    The mode is the smallest of the commonest values, counted before it is
    picked. Medians are exact, by value counts within a few groups.
    """
    stats = df.agg(F.avg(x).alias("_mean"), F.percentile(x, F.lit(0.5)).alias("_median"))
    mode = df.where(F.col(x).isNotNull()).groupBy(F.col(x).alias("_mode")).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "_mode").limit(1).select("_mode")
    by_group = df.groupBy(group).agg(F.percentile(x, F.lit(0.5)).alias("_group_median"))
    w = Window.partitionBy(entity).orderBy(*order)
    before = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(x, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    one = stats.join(mode, F.lit(True), "left")  # a row with a row
    out = df.withColumns({"_forward": before, "_backward": after}).join(by_group, group, "left").crossJoin(F.broadcast(one))
    fills = {"mean": F.col("_mean"), "median": F.col("_median"), "mode": F.col("_mode"), "zero": F.lit(0.0), "constant": F.lit(constant), "forward": F.col("_forward"), "backward": F.col("_backward"), "group_median": F.col("_group_median")}
    return out.withColumns({f"{x}_{s}": F.coalesce(x, v) for s, v in fills.items()}).drop("_mean", "_median", "_mode", "_group_median", "_forward", "_backward")


def fenced(df: DataFrame, x: str, times: float = 1.5) -> DataFrame:
    """``x`` clipped to, nulled beyond and flagged by the fences ``times`` quartile ranges out, and its z-score."""
    q = df.agg(F.percentile(x, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"), F.avg(x).alias("_m"), F.stddev_samp(x).alias("_s"))
    step = times * (F.col("_q")[1] - F.col("_q")[0])
    fences = q.select((F.col("_q")[0] - step).alias("_lo"), (F.col("_q")[1] + step).alias("_hi"), "_m", "_s")
    out, v = df.crossJoin(F.broadcast(fences)), F.col(x)
    inside = v.between(F.col("_lo"), F.col("_hi"))
    return out.withColumns({f"{x}_clipped": F.when(v.isNotNull(), F.greatest("_lo", F.least("_hi", v))), f"{x}_nulled": F.when(inside, v), f"{x}_outlier": ~inside, f"{x}_z": F.try_divide(v - F.col("_m"), F.col("_s"))}).drop("_lo", "_hi", "_m", "_s")


def scaled(df: DataFrame, x: str) -> DataFrame:
    """``x`` by standard, min-max and robust scaling, and the standard one taken back."""
    s = df.agg(F.avg(x).alias("_m"), F.stddev_pop(x).alias("_s"), F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"))
    out, v = df.crossJoin(F.broadcast(s)), F.col(x)
    out = out.withColumns({f"{x}_standard": F.try_divide(v - F.col("_m"), F.col("_s")), f"{x}_minmax": F.try_divide(v - F.col("_lo"), F.col("_hi") - F.col("_lo")), f"{x}_robust": F.try_divide(v - F.col("_q")[1], F.col("_q")[2] - F.col("_q")[0])})
    return out.withColumn(f"{x}_back", F.col(f"{x}_standard") * F.col("_s") + F.col("_m")).drop("_m", "_s", "_lo", "_hi", "_q")
