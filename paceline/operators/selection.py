"""Choice of features: searches over sufficient statistics, mutual information from counts, and a vote of five methods.

A wrapper search tries hundreds of subsets. What a least-squares model of any
subset needs is in one matrix of products a fold, which Spark adds up in one
scan; after that no candidate costs a scan. The matrix has as many rows as
there are features, however many rows the table has.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.sources.shared import kept

#: Small multiple of the identity that keeps a subset with repeated features solvable.
RIDGE = 1e-6


def products(df: DataFrame, features: list[str], label: str, fold: str) -> dict[int, np.ndarray]:
    """Per fold the matrix of products of (1, features, label), over rows in which none is null, in one scan.

    A task returns one row a fold and cell; their sums are all that reaches the driver.
    """
    width = len(features) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = np.asarray(batch.column(0))
            x = np.column_stack([np.ones(batch.num_rows), *(np.asarray(batch.column(i + 1)) for i in range(width - 1))])
            for k in np.unique(folds):
                own = x[folds == k]
                sums[int(k)] = sums.get(int(k), 0) + own.T @ own
        rows = [(k, i, float(v)) for k, m in sums.items() for i, v in enumerate(m.ravel())]
        yield pa.record_batch([pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int32(), pa.int32(), pa.float64()))], ["fold", "cell", "value"])

    slim = df.select(F.col(fold).cast("int").alias("_fold"), *(F.col(c).cast("double").alias(c) for c in (*features, label))).dropna()
    cells = slim.mapInArrow(run, "fold int, cell int, value double").groupBy("fold", "cell").agg(F.sum("value").alias("value")).collect()
    out: dict[int, np.ndarray] = {}
    for r in cells:
        out.setdefault(r["fold"], np.zeros(width * width))[r["cell"]] = r["value"]
    return {k: v.reshape(width, width) for k, v in out.items()}


def moments(df: DataFrame, features: list[str]) -> tuple[dict[str, float | None], dict[tuple[str, str], float | None]]:
    """Sample variances and Pearson's correlations of all pairs, each over the rows that have both, null where a side is constant there.

    One scan finds the means, one adds up the products of what lies around
    them; a task returns one row a pair.
    """
    k = len(features)
    slim = df.select(*(F.col(f).cast("double").alias(f) for f in features))
    means = [m or 0.0 for m in slim.agg(*(F.avg(f) for f in features)).first()]
    plain = [("n", F.sum), ("s", F.sum), ("q", F.sum), ("p", F.sum), ("lo", F.min), ("hi", F.max)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, p = np.zeros((4, k, k))
        lo, hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            own = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            m, x = known.astype(float), np.where(known, own - means, 0.0)
            n, s, q, p = n + m.T @ m, s + x.T @ m, q + (x * x).T @ m, p + x.T @ x
            for j in range(1 if known.all() else k):
                both = known & known[:, j : j + 1]
                to = slice(None) if known.all() else slice(j, j + 1)
                lo[:, to] = np.minimum(lo[:, to], np.where(both, own, np.inf).min(axis=0)[:, None])
                hi[:, to] = np.maximum(hi[:, to], np.where(both, own, -np.inf).max(axis=0)[:, None])
        at = np.indices((k, k)).reshape(2, -1)
        yield pa.record_batch([*(pa.array(a, pa.int32()) for a in at), *(pa.array(v.ravel()) for v in (n, s, q, p, lo, hi))], ["i", "j", *(c for c, _ in plain)])

    cells = slim.mapInArrow(run, "i int, j int, n double, s double, q double, p double, lo double, hi double").groupBy("i", "j").agg(*(g(c).alias(c) for c, g in plain)).collect()
    of = {(r["i"], r["j"]): r for r in cells}
    spread = lambda r: r["q"] - r["s"] * r["s"] / r["n"]
    variances = {f: spread(r) / (r["n"] - 1) if (r := of.get((i, i))) and r["n"] > 1 else None for i, f in enumerate(features)}
    pairs = {}
    for i, b in enumerate(features):
        for j, a in enumerate(features[:i]):
            x, y = of.get((j, i)), of.get((i, j))
            varies = x is not None and x["lo"] < x["hi"] and y["lo"] < y["hi"] and spread(x) * spread(y) > 0
            pairs[a, b] = (x["p"] - x["s"] * y["s"] / x["n"]) / float(np.sqrt(spread(x) * spread(y))) if varies else None
    return variances, pairs


@dataclass
class Scorer:
    """Cross-validated score of subsets: minus the Gaussian log loss of least squares fitted on the other folds, the higher the better."""

    folds: dict[int, np.ndarray]
    features: list[str]
    seen: dict[frozenset[str], float] = field(default_factory=dict)

    def __call__(self, subset: list[str]) -> float:
        key = frozenset(subset)
        if not key:
            return -np.inf
        if key not in self.seen:
            self.seen[key] = float(np.mean([self._fold(k, sorted(key, key=self.features.index)) for k in sorted(self.folds)]))
        return self.seen[key]

    def _fold(self, k: int, subset: list[str]) -> float:
        use = [0, *(1 + self.features.index(f) for f in subset)]
        train, test = sum(m for j, m in self.folds.items() if j != k), self.folds[k]
        n, m = train[0, 0], test[0, 0]
        size = np.sqrt(np.maximum(np.diag(train)[use], 1e-300))
        a, b = train[np.ix_(use, use)] / np.outer(size, size), train[use, -1] / size
        w = np.linalg.solve(a + RIDGE * np.eye(len(use)), b) / size
        loss = lambda p: max(float(p[-1, -1] - 2 * w @ p[use, -1] + w @ p[np.ix_(use, use)] @ w), 0.0)
        var = max(loss(train) / n, 1e-12)
        return -(0.5 * np.log(2 * np.pi * var) + loss(test) / m / (2 * var))


def forward(score: Scorer, most: int = 30, patience: int = 5) -> tuple[list[str], float]:
    """Add the best feature at a time; after ``patience`` steps, stop at the first that gains nothing."""
    chosen, best, left = [], -np.inf, list(score.features)
    for step in range(min(most, len(left))):
        top = max(left, key=lambda f: score([*chosen, f]))
        now = score([*chosen, top])
        if now <= best and step > patience:
            break
        chosen.append(top)
        left.remove(top)
        best = now
    return chosen, best


def backward(score: Scorer, least: int = 10, free_above: int = 20) -> tuple[list[str], float]:
    """Drop the least missed feature at a time; once at most ``free_above`` are left, stop at the first that is missed."""
    chosen = list(score.features)
    best = score(chosen)
    while len(chosen) > least:
        worst = max(chosen, key=lambda f: score([x for x in chosen if x != f]))
        now = score([x for x in chosen if x != worst])
        if now < best and len(chosen) <= free_above:
            break
        chosen.remove(worst)
        best = max(now, best)
    return chosen, best


def genetic(score: Scorer, population: int = 50, generations: int = 20, mutation: float = 0.05, elite: float = 0.1, least: int = 5, seed: int = 42) -> tuple[list[str], float]:
    """Subsets bred over generations: the elite stays, parents come from the better half, genes are mixed one by one and flipped by chance."""
    rng, n = random.Random(seed), len(score.features)
    least = min(least, n)
    named = lambda genes: [f for f, on in zip(score.features, genes, strict=True) if on]

    def filled(genes: list[bool]) -> tuple[bool, ...]:
        if sum(genes) < least:
            for i in rng.sample(range(n), least):
                genes[i] = True
        return tuple(genes)

    people = [filled([rng.random() < 0.5 for _ in range(n)]) for _ in range(population)]
    best: tuple[float, tuple[bool, ...]] = (-np.inf, people[0])
    for _ in range(generations):
        ranked = sorted(people, key=lambda g: -score(named(g)))
        best = max(best, (score(named(ranked[0])), ranked[0]), key=lambda b: b[0])
        half = ranked[: len(ranked) // 2 + 1]
        people = ranked[: max(2, int(population * elite))]
        while len(people) < population:
            a, b = rng.choice(half), rng.choice(half)
            people.append(filled([(x if rng.random() < 0.5 else y) ^ (rng.random() < mutation) for x, y in zip(a, b, strict=True)]))
    return named(best[1]), best[0]


def searched(df: DataFrame, features: list[str], label: str, fold: str, most: int = 30, least: int = 10) -> DataFrame:
    """What the three searches choose: ``method``, ``feature``, ``place`` (order of choice) and the ``score`` of the whole set."""
    score = Scorer(products(df, features, label, fold), features)
    found = {"forward": forward(score, most), "backward": backward(score, least), "genetic": genetic(score)}
    rows = [(m, f, i + 1, s) for m, (chosen, s) in found.items() for i, f in enumerate(chosen)]
    return df.sparkSession.createDataFrame(rows, "method string, feature string, place int, score double")


def binned(c: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the equal bin between two ends, the upper end in the last; null stays null."""
    return F.when(c.isNotNull(), F.least(F.floor((c - low) / F.when(high > low, high - low).otherwise(1.0) * bins), F.lit(bins - 1))).cast("int")


def mutual_information(df: DataFrame, features: list[str], label: str, bins: int = 10) -> DataFrame:
    """``feature`` and its ``mutual_information`` with the label in nats, from the counts of (bin, label).

    One scan finds the ends, one counts the bins of all features at once. A
    missing value is a bin of its own, a missing label counts for none.
    """
    known = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("_y"), *(F.col(f).cast("double").alias(f) for f in features))
    ends = known.agg(*(g(F.col(f)).alias(f"{n}{i}") for i, f in enumerate(features) for n, g in (("lo", F.min), ("hi", F.max)))).first()
    cell = lambda i, f: F.struct(F.lit(f).alias("feature"), binned(F.col(f), F.lit(ends[f"lo{i}"]).cast("double"), F.lit(ends[f"hi{i}"]).cast("double"), bins).alias("bin"))
    counts = known.select("_y", F.explode(F.array(*(cell(i, f) for i, f in enumerate(features)))).alias("c")).groupBy("c.feature", "c.bin", "_y").agg(F.count(F.lit(1)).alias("n"))
    within = lambda *keys: F.sum("n").over(Window.partitionBy("feature", *keys))
    parts = counts.select("feature", "n", within().alias("all"), within("bin").alias("of_bin"), within("_y").alias("of_y"))
    share = F.col("n") / F.col("all") * F.ln(F.col("n") * F.col("all") / (F.col("of_bin") * F.col("of_y")))
    return parts.groupBy("feature").agg(F.greatest(F.sum(share), F.lit(0.0)).alias("mutual_information"))


def majority(df: DataFrame, features: list[str], label: str, top: int, need: int = 3, least_kept: int = 10, most_corr: float = 0.95, least_var: float = 1e-4, l1: float = 0.001, seed: int = 1) -> DataFrame:
    """Vote of five methods on each feature; ``kept`` with ``need`` votes, or with 2 if fewer than ``least_kept`` get as many.

    The methods: it repeats no earlier feature (correlation), it varies, it is
    among the ``top`` by mutual information, an L1 logistic regression keeps
    it, and it is among the ``top`` by a forest's importances. Equal figures
    are ranked by name. The rows are stored once, as the methods read them
    many times.
    """
    spark = df.sparkSession
    rows = kept(df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), *(F.col(f).cast("double").alias(f) for f in features)), "votes")
    variances, pairs = moments(rows, features)
    repeats = {b for (_, b), c in pairs.items() if abs(c or 0.0) > most_corr}
    told = {r["feature"]: r["mutual_information"] for r in mutual_information(rows, features, "_y").collect()}
    filled = Imputer(strategy="median", inputCols=features, outputCols=[f"_{f}" for f in features]).fit(rows).transform(rows)
    vectors = VectorAssembler(inputCols=[f"_{f}" for f in features], outputCol="_raw").transform(filled).select("_y", "_raw")
    scaled = StandardScaler(inputCol="_raw", outputCol="_v", withMean=True).fit(vectors).transform(vectors)
    lasso = LogisticRegression(labelCol="_y", featuresCol="_v", elasticNetParam=1.0, regParam=l1, maxIter=100).fit(scaled).coefficients
    trees = RandomForestClassifier(labelCol="_y", featuresCol="_raw", numTrees=20, maxDepth=6, seed=seed).fit(vectors).featureImportances
    best = lambda value: set(sorted(features, key=lambda f: (-value(f), f))[:top])
    by_told, by_trees = best(lambda f: told.get(f, 0.0)), best(lambda f: float(trees[features.index(f)]))
    flags = {f: (f not in repeats, (variances[f] or 0.0) > least_var, f in by_told, bool(abs(lasso[i]) > 1e-5), f in by_trees) for i, f in enumerate(features)}
    enough = need if sum(sum(v) >= need for v in flags.values()) >= least_kept else 2
    schema = "feature string, is_new boolean, varies boolean, tells boolean, lasso boolean, trees boolean, votes int, kept boolean"
    return spark.createDataFrame([(f, *v, sum(v), sum(v) >= enough) for f, v in flags.items()], schema)
