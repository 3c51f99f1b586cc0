"""Models and calibrators on Spark ML, with temporal splits and feature selection by vote."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.operators.quality import correlation
from paceline.sources.shared import kept

MODELS = {
    "logistic": lambda: LogisticRegression(labelCol="y", regParam=0.01, maxIter=25),
    "forest": lambda: RandomForestClassifier(labelCol="y", numTrees=20, maxDepth=6, seed=1),
    "boosted": lambda: GBTClassifier(labelCol="y", maxIter=10, maxDepth=4, seed=1),
}


def by_time(df: DataFrame, day: str, shares: tuple[float, float] = (0.7, 0.85)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test by whole days, so that no day is in two parts; stored once, as each model reads them many times."""
    df = kept(df, "by-time")
    cuts = df.agg(F.percentile_approx(day, list(shares), 100_000).alias("c")).first()["c"]
    return df.where(F.col(day) < cuts[0]), df.where((F.col(day) >= cuts[0]) & (F.col(day) < cuts[1])), df.where(F.col(day) >= cuts[1])


def fitted(train: DataFrame, features: list[str], label: str, kind: str) -> Pipeline:
    """Median imputation from the training rows, assembly and one of MODELS."""
    filled = [f"_{f}" for f in features]
    stages = [Imputer(strategy="median", inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="features"), MODELS[kind]()]
    return Pipeline(stages=stages).fit(train.withColumn("y", F.col(label).cast("double")).withColumns({f: F.col(f).cast("double") for f in features}))


def scored(model, df: DataFrame, features: list[str], out: str = "score") -> DataFrame:
    keep = df.columns
    done = model.transform(df.withColumns({f"{f}_": F.col(f) for f in features}).withColumns({f: F.col(f).cast("double") for f in features}))
    return done.withColumn(out, vector_to_array("probability")[1]).select(*keep, out)


def out_of_fold(df: DataFrame, features: list[str], label: str, kinds: tuple[str, ...], fold: str) -> DataFrame:
    """Scores of each fold by models of the folds before it, one column a kind; the first fold has none."""
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    out = None
    for k in folds[1:]:
        part = df.where(F.col(fold) == k)
        for kind in kinds:
            part = scored(fitted(df.where(F.col(fold) < k), features, label, kind), part, features, f"{kind}_score")
        out = part if out is None else out.unionByName(part)
    return out


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), p))
    return F.ln(q / (1 - q))


def platt(train: DataFrame, df: DataFrame, score: str, label: str, out: str = "calibrated") -> DataFrame:
    """Logistic calibration: a two-parameter regression on the logit of the score."""
    rows = train.select(logit(F.col(score)).alias("x"), F.col(label).cast("double").alias("y"))
    m = LogisticRegression(labelCol="y", featuresCol="v", maxIter=50).fit(VectorAssembler(inputCols=["x"], outputCol="v").transform(rows))
    return df.withColumn(out, 1 / (1 + F.exp(-(F.lit(float(m.coefficients[0])) * logit(F.col(score)) + F.lit(float(m.intercept))))))


def temperature(train: DataFrame, df: DataFrame, score: str, label: str, grid: tuple[float, ...] = tuple(0.25 * k for k in range(1, 21)), out: str = "calibrated") -> DataFrame:
    """One temperature for all logits, the best of a grid by log loss; the whole grid is one aggregation."""
    p = lambda t: 1 / (1 + F.exp(-logit(F.col(score)) / t))
    loss = lambda t: F.avg(-F.when(F.col(label) == 1, F.ln(p(t))).otherwise(F.ln(1 - p(t))))
    losses = train.agg(*(loss(t).alias(f"t{i}") for i, t in enumerate(grid))).first()
    best = min(range(len(grid)), key=lambda i: losses[i])
    return df.withColumn(out, p(grid[best]))


def isotonic(train: DataFrame, df: DataFrame, score: str, label: str, out: str = "calibrated") -> DataFrame:
    m = IsotonicRegression(featuresCol=score, labelCol=label, predictionCol=out).fit(train.withColumn(label, F.col(label).cast("double")))
    return m.transform(df)


def votes(df: DataFrame, features: list[str], label: str, least_corr: float = 0.01, most_corr: float = 0.95) -> DataFrame:
    """Votes for each feature: it varies, it goes with the label, and it doesn't repeat an earlier feature. One scan."""
    pairs = [(a, b) for i, b in enumerate(features) for a in features[:i]]
    row = df.agg(*((F.min(f) < F.max(f)).alias(f"v_{f}") for f in features), *(correlation(f, label).alias(f"l_{f}") for f in features), *(correlation(a, b).alias(f"c_{a}_{b}") for a, b in pairs))

    def one(f: str) -> Column:
        same = F.greatest(F.lit(0.0), *(F.abs(F.coalesce(f"c_{a}_{b}", F.lit(0.0))) for a, b in pairs if b == f), F.lit(0.0))
        flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
        v, c, d = flag(F.col(f"v_{f}")), flag(F.abs(f"l_{f}") >= least_corr), flag(same <= most_corr)
        return F.struct(F.lit(f).alias("feature"), v.alias("varies"), c.alias("goes_with_label"), d.alias("is_new"), (v + c + d).alias("votes"))

    return row.select(F.explode(F.array(*map(one, features))).alias("x")).select("x.*")


def best_per_context(df: DataFrame, context: str, model: str, loss: str, least: int = 50) -> DataFrame:
    """Model with the least mean loss in each context; contexts with too few rows take the overall best."""
    overall = df.groupBy(F.col(model).alias("m")).agg(F.avg(loss).alias("l")).agg(F.min_by("m", F.struct("l", "m")).alias("fallback"))
    g = df.groupBy(context, F.col(model).alias("m")).agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("l"))
    best = g.where(F.col("n") >= least).groupBy(context).agg(F.min_by("m", F.struct("l", "m")).alias("own"))
    return df.select(context).distinct().join(best, context, "left").crossJoin(F.broadcast(overall)).select(context, F.coalesce("own", "fallback").alias("model"), F.col("own").isNull().alias("is_fallback"))


def nearest(left: DataFrame, right: DataFrame, keys: list[str], day: str, within: int, values: list[str], key: str) -> DataFrame:
    """The right row of the same keys nearest in days (the earlier on ties), at most ``within`` days away.

    Days are cut into buckets of that width, so the join is an equi-join over three buckets.
    """
    bucket = lambda d: F.floor(F.col(d) / within)
    probe = left.select(key, *keys, F.col(day).alias("_d"), F.explode(F.array(bucket(day) - 1, bucket(day), bucket(day) + 1)).alias("_b"))
    side = right.select(*keys, F.col(day).alias("_e"), bucket(day).alias("_b"), *values)
    met = probe.join(side, [*keys, "_b"]).withColumn("_gap", F.abs(F.col("_d") - F.col("_e"))).where(F.col("_gap") <= within)
    first = Window.partitionBy(key).orderBy("_gap", "_e", *values)
    return left.join(met.withColumn("_k", F.row_number().over(first)).where("_k = 1").select(key, *values, F.col("_gap").alias("days_apart")), key, "left")


def temperature_by_descent(train: DataFrame, df: DataFrame, score: str, label: str, steps: int = 50, within: float = 1e-9, out: str = "calibrated") -> DataFrame:
    """One temperature for all logits by descent on the log loss; each step is one aggregation.

    The loss is convex in the inverse temperature, so the step is the slope
    over the curvature, at most doubling or halving it.
    """
    rows = train.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(logit(F.col(score)).alias("x"), F.col(label).cast("double").alias("y"))
    inverse = 1.0
    for _ in range(steps):
        p = 1 / (1 + F.exp(-F.lit(inverse) * F.col("x")))
        row = rows.agg(F.sum((p - F.col("y")) * F.col("x")).alias("slope"), F.sum(p * (1 - p) * F.col("x") * F.col("x")).alias("curve")).first()
        if not row["curve"]:
            break
        after = min(max(inverse - row["slope"] / row["curve"], inverse / 2), inverse * 2, 100.0)
        done, inverse = abs(after - inverse) <= within * inverse, after
        if done:
            break
    return df.withColumn(out, 1 / (1 + F.exp(-F.lit(inverse) * logit(F.col(score)))))


def stacked(df: DataFrame, test: DataFrame, features: list[str], label: str, fold: str, kinds: tuple[str, ...] = ("logistic", "forest", "boosted")) -> DataFrame:
    """``test`` with the score of each kind of model and of a stack of them.

    The stack is a logistic regression over the logits of scores that each
    model gave to later folds than it had learned from; then the models are
    fitted again on all of ``df``, which is read many times and should be stored.
    """
    base = kept(out_of_fold(df, features, label, kinds, fold), "out-of-fold")
    names = [f"{k}_score" for k in kinds]
    logits = lambda d: d.withColumns({f"_{n}": logit(F.col(n)) for n in names})
    gather = VectorAssembler(inputCols=[f"_{n}" for n in names], outputCol="_stack")
    meta = LogisticRegression(labelCol="_y", featuresCol="_stack", regParam=0.001, maxIter=50).fit(gather.transform(logits(base)).withColumn("_y", F.col(label).cast("double")))
    out = test
    for kind in kinds:
        out = scored(fitted(df, features, label, kind), out, features, f"{kind}_score")
    parts = [F.lit(float(c)) * logit(F.col(n)) for c, n in zip(meta.coefficients, names, strict=True)]
    z = F.lit(float(meta.intercept))
    for part in parts:
        z = z + part
    return out.withColumn("stack_score", 1 / (1 + F.exp(-z)))
