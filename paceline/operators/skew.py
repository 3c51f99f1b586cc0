"""Joins against a table of unique keys some of which may own a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_limit(df: DataFrame, total: int) -> int:
    """Rows beyond which a key is heavy: a quarter of a shuffle partition's share, so at most four keys a partition are."""
    return max(1, total // (4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))))


def looked_up(left: DataFrame, right: DataFrame, keys: list[str], rows_col: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right``, whose ``keys`` are unique and whose ``rows_col`` counts each key's rows in ``left``.

    ``total`` is the sum of these counts. Heavy keys number at most four a
    shuffle partition, which bounds the side that is broadcast for them; all
    others are shuffled, at most ``heavy_limit`` rows a key.
    """
    most = heavy_limit(left, total)
    hot, rest = right.where(F.col(rows_col) > most).drop(rows_col), right.where(F.col(rows_col) <= most).drop(rows_col)
    return left.join(F.broadcast(hot), keys).unionByName(left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest.hint("shuffle_merge"), keys))


def joined_by_hot_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on one column that is unique in ``right`` and may be hot in ``left``; counts the rows of each key first."""
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("n")).first()["n"] or 0
    return looked_up(left, right.join(counts, key), [key], "_rows", total)
