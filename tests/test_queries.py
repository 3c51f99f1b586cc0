"""Every registered query against its SQL twin on the smallest tables, value by value."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from paceline.plans.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


def cells(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
            return "null"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, float, np.integer, np.floating)):
            return f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(map(one, row)) for row in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    found, expected = QUERIES[name](spark, SMALL).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert cells(found) == cells(expected)


def test_simulation_is_near_the_exact_probabilities(spark):
    from pyspark.sql import functions as F

    from paceline.operators.race import implied_probability
    from paceline.sources.tables import runners

    sim = QUERIES["monte_carlo"](spark, SMALL).select("race", "no", "win")
    exact = runners(spark, SMALL).withColumns(implied_probability("odds")).select("race", "no", "probability")
    error = sim.join(exact, ["race", "no"]).agg(F.avg(F.col("win") - F.col("probability")).alias("bias"), F.avg(F.abs(F.col("win") - F.col("probability"))).alias("gap")).first()
    assert abs(error["bias"]) < 1e-9 and error["gap"] < 0.04


def test_entry(spark):
    assert entry_module.entry(spark).columns[0] == "uid"
    assert set(ORACLES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", ["model_logistic", "model_forest", "model_boosted"])
def test_models_score_the_last_days(spark, name):
    out = QUERIES[name](spark, SMALL).toPandas()
    assert len(out) > 300 and out.score.between(0, 1).all()
    assert out.score[out.won == 1].mean() > out.score[out.won == 0].mean()


def test_calibrators_lower_the_loss_or_keep_it(spark):
    out = {r.calibrator: r for r in QUERIES["model_report"](spark, SMALL).collect()}
    assert set(out) == {"raw", "platt", "temperature", "isotonic"} and all(r.auc > 0.5 for r in out.values())
    assert out["platt"].log_loss < out["raw"].log_loss + 0.02


def test_conditions_text(spark):
    from pyspark.sql import functions as F

    from paceline.functions.conditions import conditions

    texts = ["Pour chevaux de 4 à 6 ans, 2 850 mètres, autostart, 35.000 €", "Groupe II, pouliches de 3 ans, 57,5 kg, 1600 m", "Handicap, 4 ans et plus"]
    a, b, c = (r.c for r in spark.createDataFrame([(t,) for t in texts], "t string").select(conditions(F.col("t")).alias("c")).collect())
    assert (a.age_min, a.age_max, a.distance, a.start, a.prize) == (4, 6, 2850, "autostart", 35000.0)
    assert (b.category, b.females_only, b.weight, b.age_min, b.age_max) == ("group 2", True, 57, 3, 3)
    assert (c.category, c.age_min, c.age_max, c.distance) == ("handicap", 4, None, None)
