"""Nested payloads: the key paths of JSON texts, and payouts flattened to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.sources.shared import kept

#: The fields of a payout payload.
PAYOUT = "rapportsDefinitifs array<struct<typePari: string, rapports: array<struct<combinaison: string, dividende: long, nombreGagnants: double, nbGagnants: double>>>>"


def key_paths(df: DataFrame, text: str, depth: int = 5, every_element: bool = False) -> DataFrame:
    """``path`` of every key in JSON texts, dotted, with ``[]`` after a list whose objects go on, and the rows ``n`` that have it.

    Objects nest up to ``depth`` below the first; of a list the first element
    is looked into, or ``every_element``. Texts that aren't JSON have none.
    """
    spark = df.sparkSession
    kind = lambda v: F.schema_of_variant(v)
    opened = lambda rows: rows.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    parsed = df.select(F.monotonically_increasing_id().alias("row"), F.try_parse_json(F.col(text)).alias("v"), F.lit("").alias("prefix")).where("v is not null")
    listed = F.startswith(kind(F.col("v")), F.lit("ARRAY"))
    items = opened(parsed.where(listed)).select("row", F.col("value").alias("v"), "prefix")
    level, found = kept(parsed.where(~listed).unionByName(items), "key-level"), None
    for _ in range(depth + 1):
        keys = opened(level.where(F.startswith(kind(F.col("v")), F.lit("OBJECT")))).select("row", F.concat(F.when(F.col("prefix") == "", "").otherwise(F.concat("prefix", F.lit("."))), "key").alias("path"), F.col("value").alias("v"))
        # A level is stored, as the next one reads it several times: for its keys, its objects and its lists.
        level = kept(keys, "key-level")
        one = level.select("row", "path")
        found = one if found is None else found.unionByName(one)
        nested = level.where("v is not null").withColumnRenamed("path", "prefix")
        inside = nested.where(F.startswith(kind(F.col("v")), F.lit("OBJECT")))
        elements = opened(nested.where(F.startswith(kind(F.col("v")), F.lit("ARRAY")))).where(F.lit(True) if every_element else F.col("pos") == 0)
        level = inside.unionByName(elements.select("row", F.concat("prefix", F.lit("[]")).alias("prefix"), F.col("value").alias("v")).select(*inside.columns))
    return found.distinct().groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def payout_rows(df: DataFrame, text: str, keys: list[str], kinds: dict[str, str]) -> DataFrame:
    """One row a combination of a payout payload: ``keys``, ``kind`` (by ``kinds``, else as it is), ``combination``, ``payout`` in units, ``winners`` and ``payout_uid``, a digest of keys, kind and combination.

    A payload without blocks, and a block without combinations, has no rows.
    """
    known = F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv)) if kinds else F.create_map().cast("map<string,string>")
    blocks = df.select(*keys, F.explode(F.from_json(text, PAYOUT)["rapportsDefinitifs"]).alias("b"))
    raw = F.upper(F.trim(F.coalesce("b.typePari", F.lit(""))))
    rows = blocks.select(*keys, F.coalesce(F.try_element_at(known, raw), F.lower(raw)).alias("kind"), F.explode("b.rapports").alias("r"))
    return rows.select(*keys, "kind", F.coalesce("r.combinaison", F.lit("")).alias("combination"), (F.col("r.dividende") / 100).alias("payout"), winners("r").alias("winners")).withColumn("payout_uid", F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys), "kind", "combination")))


def winners(r: str) -> Column:
    """Winners under either name; 0 under the first counts as missing."""
    return F.coalesce(F.when(F.col(f"{r}.nombreGagnants") != 0, F.col(f"{r}.nombreGagnants")), F.col(f"{r}.nbGagnants"))
