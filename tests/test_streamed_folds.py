"""Folds and running sums that hold no segment or table in one place."""

import random

import pytest

from paceline.operators import quality, sequences
from paceline.plans import outcome_queries
from pyspark.sql import functions as F


def arrays(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_alarms_follow_a_plain_fold_and_collect_no_arrays(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), t, rng.choice([None, 3.0]) if t % 900 == 899 else rng.gauss(50 + 30 * (t % 400 > 300), 20)) for t in range(6000)]
    df = spark.createDataFrame([*rows, ("empty", 1, None)], "kind string, ts long, k double").repartition(7)
    for detector in (sequences.cusum(50.0, 10.0, 100.0), sequences.page_hinkley(0.5, 400.0)):
        out = sequences.alarms(df, "kind", "ts", "k", detector)
        assert "collect_list" not in arrays(out)
        expected = {"empty": (0, 0)}
        for kind in ("a", "b", None):
            step = detector()
            hits = [i for i, v in enumerate((v for k, _, v in rows if k == kind), 1) if step(v)]
            expected[kind] = (len(hits), max(hits, default=0))
        assert {r.kind: (r.alarms, r.last_alarm) for r in out.collect()} == expected and expected["a"][0] > 0
    monkeypatch.setattr(outcome_queries, "events", lambda spark, sf: df)
    assert all("collect_list" not in arrays(q(spark, "")) for q in (outcome_queries.cusum, outcome_queries.page_hinkley))


def test_auc_and_ks_sum_over_ranges(spark):
    rng = random.Random(4)
    rows = [(round(rng.random() ** 3, 3), int(rng.random() < 0.3)) for _ in range(4000)] + [(0.001, 1)] * 500
    df = spark.createDataFrame(rows, "p double, y int")
    ones, zeros = [p for p, y in rows if y], [p for p, y in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / len(ones) / len(zeros)
    assert quality.log_loss_and_auc(df, "p", "y").first()["auc"] == pytest.approx(auc)
    ks = max(abs(sum(a <= v for a in ones) / len(ones) - sum(b <= v for b in zeros) / len(zeros)) for v in {p for p, _ in rows})
    assert quality.ks(df, "p", F.col("y") == 1).first()["ks"] == pytest.approx(ks)
    sums = {r.p: r.sum_n for r in quality.running_sums(df.groupBy("p").agg(F.count("*").alias("n")), "p", ["n"]).collect()}
    assert all(n == sum(p <= v for p, _ in rows) for v, n in sums.items())
    nothing = df.where("p > 9")
    assert quality.ks(nothing, "p", F.col("y") == 1).first()["ks"] is None and quality.log_loss_and_auc(nothing, "p", "y").first()["auc"] is None
