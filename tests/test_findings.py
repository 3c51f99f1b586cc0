"""Significance, monthly figures, rules by name, anomalies, and readers of odd files, against plain Python."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from paceline.operators import findings
from paceline.sources import readers, sinks


def test_significance(spark):
    data = {"a": [1.0, 2.0, 4.0, -1.0, 0.5], "one": [3.0], "flat": [2.0, 2.0, 2.0], "far": [10.0, 10.1, 9.9, 10.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("a", None)], "k string, v double")
    out = {r.k: r for r in findings.significance(df, ["k"], "v").collect()}
    e = statistics.stdev(data["a"]) / math.sqrt(5)
    z = statistics.mean(data["a"]) / e
    assert out["a"].n == 5 and out["a"].z == pytest.approx(z) and out["a"].p_value == pytest.approx(math.erfc(z / math.sqrt(2)), abs=2e-7)
    assert (out["a"].low, out["a"].high) == (pytest.approx(1.3 - 1.96 * e), pytest.approx(1.3 + 1.96 * e))
    assert out["one"].p_value is None and out["flat"].z is None and out["far"].p_value == pytest.approx(0, abs=1e-9)


def test_monthly(spark):
    df = spark.createDataFrame([("2024-01-01", 1, None), ("2024-01-31", 3, None), ("2024-02-01", 5, 2.0)], "d string, a int, b double").withColumn("d", F.to_date("d"))
    out = {(r.period, r.field): (r.n, r.missing_pct, r["mean"], r.sd) for r in findings.monthly(df, "d", ["a", "b"]).collect()}
    assert out == {("2024-01", "a"): (2, 0.0, 2.0, pytest.approx(math.sqrt(2))), ("2024-01", "b"): (2, 100.0, None, None), ("2024-02", "a"): (1, 0.0, 5.0, 0.0), ("2024-02", "b"): (1, 0.0, 2.0, 0.0)}


def test_rules_by_name(spark):
    df = spark.createDataFrame([("0", -1, -3, -5, 1), ("x", 0, 0, 2, -1), (None, 5, None, None, None)], "cote string, nb_places int, gains int, temperature int, other int")
    assert {(r.field, r.rule, r.n, r.least) for r in findings.range_issues(df).collect()} == {("cote", "above zero", 1, 0.0), ("nb_places", "not below zero", 1, -1.0), ("gains", "not below zero", 1, -3.0)}
    assert findings.range_issues(df.select("other")).count() == 0


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "", [], None), (2, None, "None", [1], None)], "a int, b string, c string, d array<int>, e struct<x: int>")
    assert findings.without_empty_columns(df).columns == ["a", "d"]


def test_odd_files(spark, tmp_path):
    (tmp_path / "u.txt").write_bytes("été\nnaïve\n\n".encode())
    (tmp_path / "l.txt").write_bytes("été\nnaïve\n".encode("latin-1"))
    assert sorted(r.value for r in readers.texts_in_any_encoding(spark, str(tmp_path / "*.txt")).collect()) == ["", "naïve", "naïve", "été", "été"]
    assert {r.file.rpartition("/")[2]: r.n for r in readers.line_counts(spark, str(tmp_path / "*.txt")).collect()} == {"u.txt": 2, "l.txt": 2}
    sinks.save_scaler(spark.createDataFrame([("a", 1.0, 2.0), ("b", 0.5, 4.0)], "field string, mean double, sd double"), str(tmp_path / "scaler"))
    assert sinks.load_scaler(spark, str(tmp_path / "scaler")) == {"a": {"mean": 1.0, "sd": 2.0}, "b": {"mean": 0.5, "sd": 4.0}}
