"""Queries that choose features and combine models, with SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators import models, race, selection
from paceline.plans.form_queries import real, real_sql
from paceline.sources.tables import RUNNERS_SQL, runners

FEATURES = ["odds", "distance", "weight", "draw", "gains", "log_odds", "field", "share", "heavy", "twice", "noise", "fixed"]
BINS = 10


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs with some features that tell, some that repeat others and some that tell nothing."""
    r = runners(spark, sf).withColumn("field", F.count(F.lit(1)).over(race.field()))
    extra = {"log_odds": F.ln("odds"), "share": 1 / F.col("field"), "heavy": (F.col("weight") > 7).cast("int"), "twice": F.col("weight") * 2, "noise": F.col("uid") * 7919 % 1009, "fixed": F.lit(1), "fold": F.col("race") % 5}
    return r.withColumns(extra)


def wrapper_search(spark: SparkSession, sf: str) -> DataFrame:
    """Features that a forward, a backward and a genetic search choose for the winner, scored over five folds of races."""
    return selection.searched(_runs(spark, sf), FEATURES, "won", "fold", least=3)


def mutual_information(spark: SparkSession, sf: str) -> DataFrame:
    """Mutual information of each feature with the win, from ten bins."""
    out = selection.mutual_information(_runs(spark, sf), FEATURES, "won", BINS)
    return out.select("feature", real(F.col("mutual_information"), "mutual_information"))


_RUNS_SQL = f"WITH {RUNNERS_SQL}, f AS (SELECT *, count(*) OVER (PARTITION BY race) AS field FROM r), x AS (SELECT *, ln(odds) AS log_odds, 1 / field AS share, (weight > 7)::INTEGER AS heavy, weight * 2 AS twice, uid * 7919 % 1009 AS noise, 1 AS fixed FROM f)"
_CELLS_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, won AS y, least(floor(({c}::DOUBLE - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END * {BINS}), {BINS - 1})::INTEGER AS bin FROM x, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM x)" for c in FEATURES)
MUTUAL_INFORMATION = f"""{_RUNS_SQL}, c AS ({_CELLS_SQL}), n AS (SELECT feature, bin, y, count(*) AS n FROM c GROUP BY ALL),
p AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS a, sum(n) OVER (PARTITION BY feature, bin) AS b, sum(n) OVER (PARTITION BY feature, y) AS y FROM n)
SELECT feature, {real_sql("greatest(sum(n / a * ln(n * a / (b * y))), 0)", "mutual_information")} FROM p GROUP BY feature"""


def majority_vote(spark: SparkSession, sf: str) -> DataFrame:
    """Features by the vote of five methods."""
    return selection.majority(_runs(spark, sf), FEATURES, "won", top=6)


def stacking(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the last days by three models and by a stack that learned from their scores of later folds."""
    features = ["odds", "distance", "weight", "draw"]
    train, valid, test = models.by_time(runners(spark, sf).select("uid", "day", "won", *features), "day")
    learn = train.unionByName(valid)
    ends = learn.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    folds = learn.withColumn("fold", F.least(F.floor((F.col("day") - ends["a"]) * 3 / max(1, ends["b"] - ends["a"])), F.lit(2)))
    out = models.stacked(folds, test, features, "won", "fold")
    return out.select("uid", "won", *(F.round(c, 6).alias(c) for c in ("logistic_score", "forest_score", "boosted_score", "stack_score")))


QUERIES = {f.__name__: f for f in (wrapper_search, mutual_information, majority_vote, stacking)}
ORACLES = {"mutual_information": MUTUAL_INFORMATION}
