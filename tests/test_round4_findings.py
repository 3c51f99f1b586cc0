"""Small cases of the fourth round's findings."""

from pyspark.sql import functions as F

from paceline.plans.registry import QUERIES
from paceline.sources.tables import runners
from tests.conftest import SMALL


def test_a_trainers_partners_are_all_listed(spark):
    pairs = runners(spark, SMALL).groupBy("trainer", "jockey").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").collect()
    expected = {}
    for r in sorted(pairs, key=lambda r: (-r.n, r.jockey)):
        expected.setdefault(r.trainer, []).append(f"{r.jockey}:{r.n}")
    assert max(map(len, expected.values())) > 5
    found = {r.trainer: r.partners for r in QUERIES["trainer_table"](spark, SMALL).collect() if r.partners}
    assert found == {k: ",".join(v) for k, v in expected.items()}
