"""Feature searches against refitted models, mutual information against counts, the vote, calibration and stacking."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.operators import models, quality, selection

FEATURES = ["a", "b", "c", "d", "twice_a", "fixed", "noise"]
SCHEMA = "uid long, fold int, day int, " + ", ".join(f"{f} double" for f in FEATURES) + ", y int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(900):
        a, b, c, d = (rng.gauss(0, 1) for _ in range(4))
        p = 1 / (1 + math.exp(-(1.5 * a - b + 0.4 * c)))
        out.append((i, i % 5, i // 10, a, b if i % 50 else None, c, d, 2 * a, 1.0, rng.random(), int(rng.random() < p)))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def test_scores_equal_refitting(df, rows):
    score = selection.Scorer(selection.products(df, FEATURES, "y", "fold"), FEATURES)
    full = np.array([r for r in rows if r[4] is not None], float)
    y = full[:, -1]
    for subset in (["a"], ["a", "b", "c"], ["d", "noise"], ["b", "fixed"], FEATURES[:4]):
        x = np.column_stack([np.ones(len(full)), *(full[:, 3 + FEATURES.index(f)] for f in subset)])
        losses = []
        for k in range(5):
            train, test = full[:, 1] != k, full[:, 1] == k
            w = np.linalg.lstsq(x[train], y[train], rcond=None)[0]
            var = np.mean((y[train] - x[train] @ w) ** 2)
            losses.append(np.mean(0.5 * np.log(2 * np.pi * var) + (y[test] - x[test] @ w) ** 2 / (2 * var)))
        assert score(subset) == pytest.approx(-np.mean(losses), abs=1e-5)
    assert score(["a", "twice_a"]) == pytest.approx(score(["a"]), abs=1e-5)


def test_searches(df):
    score = selection.Scorer(selection.products(df, FEATURES, "y", "fold"), FEATURES)
    chosen, best = selection.forward(score)
    assert set(chosen[:2]) <= {"a", "twice_a", "b"} and best == score(chosen) and len(chosen) >= 6  # the first six steps never stop
    kept, left = selection.backward(score, least=2)
    assert {"b"} <= set(kept) and {"a", "twice_a"} & set(kept) and left >= score(FEATURES) - 1e-12
    genes, top = selection.genetic(score, population=12, generations=6)
    assert len(genes) >= 5 and top == score(genes) and genes == selection.genetic(score, population=12, generations=6)[0]
    assert top <= max(score(list(s)) for s in ([*FEATURES], chosen, kept, genes)) + 1e-12


def test_search_as_a_table(df):
    out = selection.searched(df, FEATURES, "y", "fold", least=2).collect()
    assert {r.method for r in out} == {"forward", "backward", "genetic"}
    assert all([r.place for r in out if r.method == m] == list(range(1, 1 + sum(r.method == m for r in out))) for m in ("forward", "backward", "genetic"))


def test_mutual_information(df, rows):
    found = {r.feature: r.mutual_information for r in selection.mutual_information(df, FEATURES, "y", 6).collect()}
    for i, f in enumerate(FEATURES):
        values = [r[3 + i] for r in rows if r[3 + i] is not None]
        lo, hi = min(values), max(values)
        cells = {}
        for r in rows:
            v = r[3 + i]
            b = None if v is None else min(int((v - lo) / ((hi - lo) or 1.0) * 6), 5)
            cells[b, r[-1]] = cells.get((b, r[-1]), 0) + 1
        n = len(rows)
        of = lambda k, j: sum(c for key, c in cells.items() if key[j] == k)
        exact = sum(c / n * math.log(c * n / (of(b, 0) * of(y, 1))) for (b, y), c in cells.items())
        assert found[f] == pytest.approx(max(exact, 0), abs=1e-9)


def test_vote(df):
    out = {r.feature: r for r in selection.majority(df, FEATURES, "y", top=3, least_kept=3).collect()}
    assert out["a"].votes == 5 and not out["twice_a"].is_new and not out["fixed"].varies and out["a"].kept and out["b"].kept and not out["fixed"].kept
    strict = {r.feature: r for r in selection.majority(df, FEATURES, "y", top=3).collect()}  # fewer than ten get three votes
    assert strict["twice_a"].kept == (strict["twice_a"].votes >= 2)


def test_moments_of_pairs(spark):
    rng = random.Random(3)
    some = [(rng.gauss(1e6, 1), None if i % 7 == 0 else rng.random(), 4.9 if i % 7 else 8.0, 49.1, None) for i in range(700)]
    names = ["a", "b", "c", "fixed", "none"]
    rows = spark.createDataFrame([(*r, r[0] + r[2]) for r in some], ", ".join(f"{f} double" for f in [*names, "d"])).repartition(5)
    variances, pairs = selection.moments(rows, [*names, "d"])
    exact = rows.agg(*(F.var_samp(f).alias(f) for f in variances), *(quality.correlation(a, b).alias(f"{a}_{b}") for a, b in pairs)).first()
    for f, v in variances.items():
        assert (v is None and exact[f] is None) or v == pytest.approx(exact[f], rel=1e-6, abs=1e-12), f
    # Where b is known, c is constant.
    assert pairs["b", "c"] is None and pairs["a", "fixed"] is None and pairs["a", "none"] is None and len(pairs) == 15
    for (a, b), c in pairs.items():
        assert (c is None and exact[f"{a}_{b}"] is None) or c == pytest.approx(exact[f"{a}_{b}"], abs=1e-6), (a, b)
    assert selection.moments(rows.limit(0), names) == (dict.fromkeys(names), {(a, b): None for i, b in enumerate(names) for a in names[:i]})


def test_the_vote_reads_stored_rows(df, monkeypatch):
    seen = []
    own = selection.moments
    monkeypatch.setattr(selection, "moments", lambda rows, features: seen.append(rows) or own(rows, features))
    selection.majority(df.join(df.select("uid"), "uid"), FEATURES, "y", top=3)
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_temperature_by_descent(spark):
    rng = random.Random(1)
    data = []
    for _ in range(4000):
        z = rng.gauss(0, 1)
        data.append((1 / (1 + math.exp(-3 * z)), int(rng.random() < 1 / (1 + math.exp(-z)))))
    df = spark.createDataFrame(data, "s double, y int")
    loss = lambda d: quality.log_loss_and_auc(d, "calibrated", "y").first()["log_loss"]
    own = loss(models.temperature_by_descent(df, df, "s", "y"))
    assert own <= loss(models.temperature(df, df, "s", "y")) + 1e-9 and own < loss(df.withColumn("calibrated", F.col("s")))
    found = models.temperature_by_descent(df, df.limit(1), "s", "y").first()
    ratio = math.log(found.s / (1 - found.s)) / math.log(found.calibrated / (1 - found.calibrated))
    assert ratio == pytest.approx(3, rel=0.15)
    flat = df.withColumn("s", F.lit(0.5))
    assert models.temperature_by_descent(flat, flat, "s", "y").first().calibrated == 0.5


def test_stacking(df):
    folds = df.withColumn("part", F.floor(F.col("day") / 30)).where("day < 75")
    test = df.where("day >= 75")
    out = models.stacked(folds, test, ["a", "b", "c", "noise"], "y", "part")
    assert out.count() == test.count() and set(out.columns) == {*test.columns, "logistic_score", "forest_score", "boosted_score", "stack_score"}
    loss = {k: out.agg(F.avg(-F.when(F.col("y") == 1, F.ln(f"{k}_score")).otherwise(F.ln(1 - F.col(f"{k}_score"))))).first()[0] for k in ("logistic", "forest", "boosted", "stack")}
    assert loss["stack"] < max(loss["forest"], loss["boosted"]) and loss["stack"] < min(loss.values()) + 0.05
