"""Atomic tables, memoised results, key paths, payouts, prefixes and matching columns."""

import json
import time

import pytest
from pyspark.sql import functions as F

from paceline.functions import payloads
from paceline.operators import matching
from paceline.sources import publish as pub


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_job_that_fails_leaves_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        pub.published(spark, path)
    assert pub.publish(spark.range(3), path) == 1
    reader = pub.published(spark, path)
    bad = spark.range(10).withColumn("x", F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("died half-way"))))
    with pytest.raises(Exception, match="died half-way"):
        pub.publish(bad, path)
    assert ids(pub.published(spark, path)) == [0, 1, 2]
    assert pub.publish(spark.range(5), path, source="b") == 2
    assert ids(pub.published(spark, path)) == [0, 1, 2, 3, 4] and ids(reader) == [0, 1, 2]  # a reader keeps its version
    assert ids(pub.published(spark, path, 1)) == [0, 1, 2] and pub.manifests(spark, path)[-1]["source"] == "b"


def test_two_jobs_and_expiry(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    pub.publish(spark.range(1), path)
    pub.publish(spark.range(2), path, after=1)
    with pytest.raises(pub.Conflict):
        pub.publish(spark.range(9), path, after=1)
    assert ids(pub.published(spark, path)) == [0, 1] and len(list((tmp_path / "t/versions").glob("[0-9a-f]*"))) == 2
    pub.publish(spark.range(3), path)
    assert pub.expire(spark, path, keep=1) == 2
    assert ids(pub.published(spark, path)) == [0, 1, 2] and [m["number"] for m in pub.manifests(spark, path)] == [3]
    assert pub.publish(spark.range(4), path) == 4


def test_memo(spark, tmp_path):
    source, folder, calls = f"file://{tmp_path}/in", f"file://{tmp_path}/memo", []
    spark.range(10).write.parquet(source)

    def build(least=3):
        calls.append(1)
        return spark.read.parquet(source).where(F.col("id") >= least).select((F.col("id") * 2).alias("id"))

    run = lambda **k: pub.memoised(spark, "doubled", [source], lambda: build(**k), folder, hours=1)
    first = run()
    second = run()
    assert ids(first) == ids(second) == list(range(6, 20, 2)) and first.inputFiles() == second.inputFiles()
    assert str(tmp_path / "memo") in second.inputFiles()[0]  # the second call reads the table
    assert ids(run(least=8)) == [16, 18]  # another plan
    time.sleep(0.01)
    spark.range(20, 22).write.mode("append").parquet(source)  # a new file
    assert ids(run()) == [*range(6, 20, 2), 40, 42]
    assert len(pub.memo_status(spark, folder)) == 3
    old = pub.memoised(spark, "doubled", [source], build, folder, hours=-1)
    assert ids(old) == ids(run()) and old.inputFiles() != first.inputFiles()
    pub.forget(spark, folder, "doubled")
    assert pub.memo_status(spark, folder) == []


def test_key_paths(spark):
    texts = [json.dumps(x) for x in ({"a": 1, "b": {"c": None, "d": {"e": [1, 2]}}}, {"a": 2, "l": [{"x": 1, "y": {"z": 0}}, {"w": 3}]}, {"l": [], "b": {"c": 1}}, [{"t": {"u": 1}}, {"v": 1}], "text", 5, {})] + [None, "not json", ""]
    out = {r.path: r.n for r in payloads.key_paths(spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()}
    assert out == {"a": 2, "b": 2, "b.c": 2, "b.d": 1, "b.d.e": 1, "l": 2, "l[].x": 1, "l[].y": 1, "l[].y.z": 1, "t": 1, "t.u": 1, "v": 1}
    every = {r.path for r in payloads.key_paths(spark.createDataFrame([(t,) for t in texts], "t string"), "t", every_element=True).collect()}
    assert every == {*out, "l[].w"}
    deep = {r.path for r in payloads.key_paths(spark.createDataFrame([(texts[0],)], "t string"), "t", depth=1).collect()}
    assert deep == {"a", "b", "b.c", "b.d"}


def test_payouts(spark):
    payload = {"rapportsDefinitifs": [{"typePari": " simple_gagnant", "rapports": [{"combinaison": "5", "dividende": 430, "nombreGagnants": 12.5}, {"combinaison": "7", "dividende": None, "nombreGagnants": 0, "nbGagnants": 3}]}, {"typePari": None, "rapports": [{"dividende": 100}]}, {"typePari": "X", "rapports": []}]}
    df = spark.createDataFrame([(1, "R1", json.dumps(payload)), (2, None, "{}"), (3, "R3", None), (4, "R4", "broken")], "id long, race string, t string")
    out = payloads.payout_rows(df, "t", ["id", "race"], {"SIMPLE_GAGNANT": "win"})
    assert sorted((r.id, r.kind, r.combination, r.payout, r.winners) for r in out.collect()) == [(1, "", "", 1.0, None), (1, "win", "5", 4.3, 12.5), (1, "win", "7", None, 3.0)]
    assert out.select("payout_uid").distinct().count() == 3


def test_longest_prefix(spark):
    known = spark.createDataFrame([("Saint Cloud", "SC"), ("Saint", "S"), ("Deauville", "D"), ("deauville!", "C"), (None, "x"), ("", "y")], "name string, code string")
    df = spark.createDataFrame([(1, "SAINT-CLOUD France"), (2, "Saint Malo"), (3, "Deauville"), (4, "Deauvilleois"), (5, None), (6, ""), (7, "the Saint")] + [(100 + i, "Saint-Cloud (Royaume Uni)") for i in range(300)], "id long, name string")
    out = {r.id: (r.track, r.track_rest) for r in matching.longest_prefix(df, "name", known, "name", "code", "track").collect()}
    assert len(out) == df.count()
    assert [out[i] for i in range(1, 8)] == [("SC", "france"), ("S", "malo"), ("C", ""), (None, None), (None, None), (None, None), (None, None)]
    assert out[150] == ("SC", "royaume uni")


def test_columns_are_matched_by_what_they_hold(spark):
    left = spark.range(2000).select((F.col("id") % 500).alias("who"), F.col("id").alias("row"), (F.col("id") % 7).alias("few"), F.array("id").alias("nested"))
    right = spark.range(500).select(F.col("id").cast("string").alias("key"), (F.col("id") + 10_000).alias("other"), (F.col("id") % 7).alias("few"))
    found = {(r.left_column, r.right_column): r.contained for r in matching.column_matches(left, right).collect()}
    assert set(found) == {("who", "key"), ("row", "key")} and min(found.values()) > 0.9
    assert matching.column_matches(left.limit(0), right).count() == 0


def test_named_column(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("x", None)], "cheval string, nom string")
    assert matching.named_column(df, ["horse", "cheval", "nom"]) == "nom" and matching.named_column(df, ["horse"]) is None
