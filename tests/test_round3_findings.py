"""Small cases of the third round's findings."""

import random

import duckdb

from pyspark.sql import Window
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.operators import betting, matching, merge, models, neighbours, pit
from paceline.plans.form_queries import real, real_sql
from paceline.plans.registry import QUERIES
from tests.conftest import SMALL



def test_draws_are_neither_shuffled_nor_sorted(spark):
    rows = [(r, n, None if n == 4 else (n + 1) / 15.0) for r in range(6) for n in range(5)]
    df = spark.createDataFrame(rows, "r long, n int, p double")
    out = betting.simulate(df, "r", "n", "p", 50, 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any("run#" in line and ("Exchange" in line or "Sort" in line) for line in plan.splitlines())
    # The draws one by one, by window.
    one = df.select(F.col("r").alias("race"), F.col("n").alias("no"), "p", F.explode(F.sequence(F.lit(1), F.lit(50))).alias("run"))
    u = (F.pmod(F.xxhash64(F.lit(5), "race", "no", "run"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    scored = one.withColumn("score", F.ln("p") - F.ln(-F.ln(u))).toPandas()
    scored["place"] = scored.groupby(["race", "run"]).score.rank(ascending=False, method="min", na_option="bottom")
    expected = scored.groupby(["race", "no"]).place.agg(["mean", lambda x: (x == 1).mean()])
    found = {(r.race, r.no): (r.mean_place, r.win) for r in out.collect()}
    assert found == {k: tuple(v) for k, v in zip(expected.index, expected.to_numpy().tolist(), strict=True)}


def test_a_constant_has_no_variance_over_many_partitions(spark):
    # Merged from partitions of 49 rows, the mean of ones isn't quite 1.
    df = spark.range(0, 49 * 4, 1, 4).select(F.lit(1).alias("fixed"), (F.col("id") % 2).alias("won"), (F.col("id") % 7).alias("x"))
    out = {r.feature: r for r in models.votes(df, ["x", "fixed"], "won").collect()}
    assert (out["fixed"].varies, out["fixed"].goes_with_label, out["fixed"].is_new, out["x"].varies) == (0, 0, 1, 1)


def shuffles(df) -> int:
    """Exchanges of the plan before it runs; those inside what is read from a cache don't occur here."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def history(spark, n=400):
    rng = random.Random(9)
    rows = [(i, rng.choice([1, 2, 3, None]), rng.choice([None, *range(60)]), rng.randrange(3), rng.choice([None, 4, 5, 9])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "uid long, who long, day int, no int, v long")


def test_last_rows_of_earlier_days_take_one_shuffle(spark):
    rows, df = history(spark)
    out = pit.last_n_of_earlier_days(df, "who", 4, ["day", "no", "uid"], ["v"])
    assert shuffles(out) == 1
    low = lambda d: -1 if d is None else d
    for r in out.collect():
        before = sorted((low(d), n, u, v) for u, w, d, n, v in rows if r.who is not None and w == r.who and low(d) < low(r.day))
        assert [(x.uid, x.v) for x in r.last] == [(u, v) for _, _, u, v in before[::-1][:4]]


def test_last_known_values_take_no_join(spark):
    _, df = history(spark)
    order = ["day", "no", "uid"]
    out = pit.last_known_values(df, "who", {"a": ("v", 3), "b": ("v", 1)}, order, lambda w: w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    one = pit.last_known(df, "who", "v", 3, order, pit.sequential("who", *order), "a")
    assert sorted(map(str, out.select(one.columns).collect())) == sorted(map(str, one.collect()))
    assert shuffles(out) == 1 and "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_small_and_large_entities(spark):
    rows, df = history(spark)
    some = [(u, w, 0 if d is None else d, n, v) for u, w, d, n, v in rows]
    df = spark.createDataFrame(some, df.schema)
    one, other = ({r.uid: (r.n_before, r.n_below, r.n_equal) for r in pit.rank_before(df, "who", "v", "uid", few=k).collect()} for k in (0, 1000))
    assert one == other and len(one) == len(rows) and any(b for _, b, _ in one.values())
    mixed = pit.rank_before(df, "who", "v", "uid", few=sum(w == 1 for _, w, *_ in some))
    assert {r.uid: (r.n_before, r.n_below, r.n_equal) for r in mixed.collect()} == one


def test_a_small_column_in_a_large_one_is_matched(spark):
    large = spark.range(40_000).select(F.col("id").alias("key"), (F.col("id") % 3).cast("string").alias("few"))
    small = spark.range(300).select((F.col("id") * 100).alias("part"), (F.col("id") + 39_850).alias("half"))
    found = {(r.left_column, r.right_column): r.contained for r in matching.column_matches(large, small).collect()}
    assert found == {("key", "part"): 1.0, ("key", "half"): 0.5}


def test_tickets_are_weighed_within_a_contest(spark):
    df = spark.createDataFrame([(r, n, (n + 1 + r % 2) / 25.0) for r in range(4) for n in range(5)], "r long, n int, p double")
    best = betting.likeliest_finish(df, "r", "n", "p")
    assert shuffles(best) == 1 and "Join" not in best._jdf.queryExecution().executedPlan().toString()
    every = betting.ordered_finish(df, "r", "n", "p").collect()
    assert len(every) == 4 * 5 * 4 * 3
    first = {r: min(((-round(x.probability, 9), "-".join(map(str, x.order)), x.probability) for x in every if x.race == r)) for r in range(4)}
    assert {r.race: (r.ticket, r.probability) for r in best.collect()} == {r: x[1:] for r, x in first.items()}


def test_models_read_stored_rows(spark):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("int").alias("day"), (F.col("id") % 3).alias("race")).join(spark.range(3).withColumnRenamed("id", "race"), "race")
    parts = models.by_time(df, "day")
    assert all("Join" not in p._jdf.queryExecution().executedPlan().toString() for p in parts)
    assert sum(p.count() for p in parts) == 400


def test_rounding_is_that_of_the_sql(spark):
    # 803 / 3200 is 0.2509375, but less than half a millionth in binary.
    pairs = [(803, 3200), (-803, 3200), (1, 3), (5, 10_000_000), (1, 64), (2**40, 7)]
    found = spark.createDataFrame(pairs, "a long, b long").select("a", "b", real(F.col("a") / F.col("b"), "x")).collect()
    for a, b, x in found:
        assert x == duckdb.connect().execute(f"SELECT {real_sql(f'{a}::DOUBLE / {b}', 'x')}").fetchone()[0]


def test_daily_histories_of_several_entities(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.choice([1, 2, None]), rng.choice([5, 6]), rng.randrange(9), rng.randrange(2)) for i in range(200)], "uid long, a long, b long, day int, won int")
    out = pit.daily_histories_of(df, {"x": ["a"], "y": ["a", "b"], "z": ["b"]})
    one = pit.daily_history(pit.daily_history(pit.daily_history(df, ["a"], "x"), ["a", "b"], "y"), ["b"], "z")
    assert sorted(map(str, out.select(one.columns).collect())) == sorted(map(str, one.collect()))
    # Every entity reads the stored rows once more; nested, they were worked out twice as often for each.
    assert out._jdf.queryExecution().analyzed().toString().count("Relation [") == 4


def test_stations_at_almost_one_place_go_by_the_angles(spark):
    # Balances 180 apart are one place but for their last digits.
    stations = [(i * 61 + k, (b := 3.17 * (i + 1) + 180 * k) % 90, b * 7 % 180) for i in range(12) for k in range(61)]
    places = [(i, (b := 7.31 * i + 0.05) % 90, b * 7 % 180) for i in range(60)]
    near = lambda df: spark.createDataFrame(df, "key long, lat double, lon double")
    found = {r.key: (r.neighbour, r.km) for r in neighbours.nearest_places(near(places), near(stations), "key").collect()}
    db = duckdb.connect()
    for name, rows in (("c", places), ("s", stations)):
        db.execute(f"CREATE TABLE {name} (id BIGINT, lat DOUBLE, lon DOUBLE)")
        db.executemany(f"INSERT INTO {name} VALUES (?, radians(?), radians(?))", rows)
    sql = f"SELECT c.id, s.id, 2 * {neighbours.EARTH_KM} * asin(sqrt(pow(sin((s.lat - c.lat) / 2), 2) + cos(s.lat) * cos(c.lat) * pow(sin((s.lon - c.lon) / 2), 2))) AS km FROM c, s QUALIFY row_number() OVER (PARTITION BY c.id ORDER BY km, s.id) = 1"
    expected = {c: (s, km) for c, s, km in db.execute(sql).fetchall()}
    assert {k: s for k, (s, _) in found.items()} == {k: s for k, (s, _) in expected.items()}
    # By points of the sphere the distances were some 1e-12 km off, enough to round to another sixth digit.
    assert max(abs(km - expected[k][1]) for k, (_, km) in found.items()) < 1e-13


def exchanges(query, spark) -> int:
    from paceline.plans.registry import QUERIES

    return shuffles(QUERIES[query](spark, "/root/testdata/sf0.001"))


def test_pairs_share_the_shuffles_of_their_entities(spark):
    # Order lines, orders, then horses, jockeys and trainers; sides that are broadcast aside.
    plan = exchanges("pair_histories", spark)
    assert plan <= 8


def test_degrees_share_the_shuffles_of_their_entities(spark):
    assert exchanges("actor_degrees", spark) <= 5


def test_affinities_share_the_shuffles_of_their_entities(spark):
    assert exchanges("duo_affinity", spark) <= 7


def test_contexts_of_a_horse_share_its_shuffle(spark):
    assert exchanges("context_specialists", spark) <= 5


def test_best_context_beside_each_other_and_spread(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, rng.choice([1, 2, None]), rng.randrange(40), rng.choice([3, 4, 5, None]), rng.choice([0, 1, 1, None])) for i in range(300)], "uid long, who long, day int, at int, won int")
    one, other = (pit.best_context(df, "who", "at", ["day", "uid"], "uid", few=few) for few in (3, 2))
    assert shuffles(one) == 1 and "Join" not in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert one.where("best_context is not null").count() > 200
    none = pit.best_context(df.where("at is null"), "who", "at", ["day", "uid"], "uid")
    assert none.where("best_context is not null").count() == 0 < none.count()


def test_form_tokens_are_searched_once_and_letters_are_not_cast(spark):
    texts = ["1a(23)12p3hDh(19)Tp", "99999999999aDa", "(07)Ra(08)2s", "", "x", None]
    out = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", scalars.form_runs(F.col("t")).alias("runs"))
    found = {r.i: r.runs and [tuple(x) for x in r.runs] for r in out.collect()}
    assert found[0] == [(1, "1", "a", None), (12, "12", "p", 2023), (3, "3", "h", 2023), (None, "D", "h", 2023), (None, "T", "p", 2019)]
    assert found[1] == [(None, "99999999999", "a", None), (None, "D", "a", None)]
    assert found[2] == [(None, "R", "a", 2007), (2, "2", "s", 2008)] and found[3] == found[4] == [] and found[5] is None
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "regexp_extract(" not in plan


def test_a_golden_record_is_voted_in_one_shuffle_of_slim_rows(spark):
    rows = [(h, str(k % (h + 1)), None if k % 2 else "x", "wide" * 9) for h in range(4) for k in range(7)]
    out = merge.majority(spark.createDataFrame(rows, "h long, a string, b string, other string"), ["h"], ["a", "b"])
    assert shuffles(out) == 1
    found = {(r.h, r.field): (r.value, r.votes, r.conflicts) for r in out.collect()}
    assert found[1, "a"] == ("0", 4, 1) and found[3, "b"] == ("x", 4, 0) and len(found) == 8


def test_a_trainers_runs_are_not_expanded_for_distinct_counts(spark):
    plan = QUERIES["trainer_table"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_what_a_task_ranks_does_not_grow_with_the_table(spark, monkeypatch):
    from paceline.sources import tables

    one = sorted(QUERIES["field_ranks"](spark, SMALL).collect())
    monkeypatch.setattr(tables, "ROWS_A_PARTITION", 500)
    out = QUERIES["field_ranks"](spark, SMALL)
    assert shuffles(out) <= 2 and out.rdd.getNumPartitions() == -(-tables.table(spark, SMALL, "lineitem").count() // 500) and sorted(out.collect()) == one
    sizes = [r["count"] for r in tables.runners(spark, SMALL).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 500
