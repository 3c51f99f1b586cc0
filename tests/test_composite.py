"""Merges of many sources: who owns a column, what a null does, priorities, orphans, careers; and the scalar parsers beside them."""

import pytest
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.operators import composite
from paceline.operators.composite import Side


@pytest.fixture(scope="module")
def sides(spark):
    a = spark.createDataFrame([(1, "a1", 10), (2, None, 20), (None, "x", 1), (2, "second", 21)], "k int, v string, n int")
    b = spark.createDataFrame([(1, None, "b1"), (3, "b3", "b3")], "k int, v string, own string")
    base = spark.createDataFrame([(1, "base1", 100), (2, "base2", 200), (3, "base3", None), (4, "base4", 400), (None, "none", 5)], "k int, own string, n int")
    return base, [Side("a", a, {"v": "v", "n": "n"}, ["n"]), Side("b", b, {"v": "v", "own": "own"})]


def table(df, *columns):
    return {r.k: tuple(r[c] for c in columns) for r in df.collect()}


def test_rules(sides):
    base, parts = sides
    last = composite.joined(base, parts, ["k"])
    assert last.columns == ["k", "own", "n", "v"] and last.count() == 5
    assert table(last, "own", "n", "v") == {1: ("b1", 10, None), 2: ("base2", 20, None), 3: ("b3", None, "b3"), 4: ("base4", 400, None), None: ("none", 5, None)}
    assert table(composite.joined(base, parts, ["k"], "first"), "own", "n", "v")[1] == ("b1", 10, "a1")
    new = table(composite.joined(base, parts, ["k"], "new"), "own", "n", "v")
    assert new[1] == ("base1", 100, "a1") and new[3] == ("base3", None, "b3")
    filled = table(composite.joined(base, parts, ["k"], filled_only=True), "own", "n", "v")
    assert filled[1] == ("b1", 10, "a1")
    assert composite.owners(base.columns, parts, "last") == {"v": ["b", "a"], "n": ["a"], "own": ["b"]} and composite.owners(base.columns, parts, "new") == {"v": ["a", "b"]}


def test_priorities_and_orphans(spark):
    a = spark.createDataFrame([("x", "1", ""), ("y", None, "p")], "key string, s string, t string")
    b = spark.createDataFrame([("x", "2", "q"), ("z", "3", None), (None, "4", "r")], "key string, s string, u string")
    out = {r.key: (r.s, r.t, list(r.sources)) for r in composite.by_priority({"a": a, "b": b}, "key", {"s": [("a", "s"), ("b", "s")], "t": [("a", "t"), ("b", "u")]}).collect()}
    assert out == {"x": ("1", "q", ["a", "b"]), "y": (None, "p", ["a"]), "z": ("3", None, ["b"])}
    base = spark.createDataFrame([(1, 5, "later"), (1, 2, "first"), (2, 1, "only")], "k int, o int, v string")
    side = spark.createDataFrame([(1, 7), (3, 9)], "k int, v int")
    out = {r.k: (r.v, r.s_v, r.sources) for r in composite.enriched_or_orphan(base, side, ["k"], "s_", ["o"], ("base", "side")).collect()}
    assert out == {1: ("first", 7, "base+side"), 2: ("only", None, "base"), 3: (None, 9, "side")}


def test_careers(spark):
    df = spark.createDataFrame([(1, 2020, 5, "b"), (1, 2020, 2, "a"), (1, 2021, 1, "c"), (None, 2020, 1, "d")], "who int, year int, at int, what string")
    out = {(r.who, r.year): [(x["at"], x["what"]) for x in r.rows] for r in composite.careers(df, "who", "year", ["at"], ["what"]).collect()}
    assert out == {(1, 2020): [(2, "a"), (5, "b")], (1, 2021): [(1, "c")]}


def test_parsers_and_bins(spark):
    texts = ["<b>DP = 6-2-10-2-0 (20) DI = 1.86 CD = 0.60</b>", "DP=1-1 - 2(4)DI=2.CD=-0.5", "DP = none", None, ""]
    d = [r.d for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(scalars.dosage(F.col("t")).alias("d")).collect()]
    assert tuple(d[0]) == ("6-2-10-2-0", 20, 1.86, 0.6) and tuple(d[1]) == ("1-1 - 2", 4, 2.0, -0.5) and d[2:] == [None, None, None]
    hours = [r.h for r in spark.createDataFrame([(0, "14h05"), (1, "à 9:30 précises"), (2, "midi"), (3, None)], "i int, t string").orderBy("i").select(scalars.hour_of(F.col("t")).alias("h")).collect()]
    assert hours == [14, 9, None, None]
    r = spark.range(1).select(scalars.band(F.lit(8), "field A").alias("a"), scalars.band(F.lit(8), "field C").alias("c"), scalars.band(F.lit(3.0), "odds A").alias("o"), scalars.band(F.lit(None).cast("int"), "rest").alias("r"), scalars.started(F.lit(None).cast("string")).alias("s"), scalars.started(F.lit("non_partant")).alias("n")).first()
    assert tuple(r) == ("small", "moyen", "favori", None, True, False)
