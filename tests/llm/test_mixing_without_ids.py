"""Rows without an id draw each on their own, wherever they stand, and land in many partitions."""

import collections

from pyspark.sql import functions as F

from paceline.llm import source_mixing
from paceline.llm.source_mixing import mix_sources

SCHEMA = "doc_id long, text string, source string, row int, mix_id string, number int, copy int"


def test_equal_rows_without_ids(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "PIECE", 300)
    rows = [(None, None, "a", 1, "m", 2, 3)] * 2000 + [(None, "same text", "a", 1, "m", 2, 3)] * 1000 + [(i, f"t{i}", "b", 1, "m", 2, 3) for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix_sources(df.repartition(7), {"a": 3.0, "b": 1.0}, total=4000)
    assert out.columns == [*(c for c in df.columns if c != "copy"), "copy"]
    n = collections.Counter((r.text is None, r.source) for r in out.collect())
    assert abs(n[True, "a"] - 2000) < 5 * 2000**0.5 and abs(n[False, "a"] - 1000) < 5 * 1000**0.5
    again = mix_sources(df.repartition(3), {"a": 3.0, "b": 1.0}, total=4000)
    assert out.exceptAll(again).count() == 0 == again.exceptAll(out).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spread = mix_sources(df, {"a": 3.0, "b": 1.0}, total=4000).where("text is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in spread) < 0.6 * n[True, "a"]


def test_texts_without_ids_are_told_apart(spark):
    df = spark.createDataFrame([(None, f"t{i}", "a", 1, "m", 2, 3) for i in range(500)], SCHEMA)
    out = collections.Counter(r.text for r in mix_sources(df, total=1500).collect())
    assert 1200 < sum(out.values()) < 1800 and len(set(out.values())) > 3
