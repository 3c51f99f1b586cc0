"""Array statistics against the statistics module, and the last known values against plain loops."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from paceline.functions import arrays
from paceline.operators import pit


def test_array_statistics(spark):
    rng = random.Random(1)
    data = [[rng.choice([None, 1.0, 2.5, -3.0, 7.0, 7.0]) for _ in range(rng.randint(0, 12))] for _ in range(80)] + [None, [], [None], [4.0]]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(data)], "i int, a array<double>")
    c = F.col("a")
    out = df.select("i", arrays.total(c).alias("t"), arrays.mean(c).alias("m"), arrays.sd_sample(c).alias("s"), arrays.sd_population(c).alias("p"), arrays.median(c).alias("d"), arrays.slope(c).alias("b")).collect()
    for r in out:
        v = None if data[r.i] is None else [x for x in data[r.i] if x is not None]
        if not v:
            assert (r.m, r.s, r.d, r.b) == (None,) * 4
            continue
        assert r.t == pytest.approx(sum(v)) and r.m == pytest.approx(statistics.mean(v)) and r.d == statistics.median(v) and r.p == pytest.approx(statistics.pstdev(v))
        assert (r.s, r.b) == (None, None) if len(v) == 1 else r.s == pytest.approx(statistics.stdev(v)) and r.b == pytest.approx(statistics.linear_regression(range(len(v)), v).slope)


@pytest.mark.parametrize("strict", [True, False])
def test_last_known(spark, strict):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 2, 3, None]), rng.randrange(40), i % 3, rng.choice([None, None, 5, 6, 8, 11])) for i in range(300)]
    df = spark.createDataFrame(rows, "uid long, who long, day int, no int, v long")
    order = ["day", "no", "uid"]
    frame = pit.strict_day("who") if strict else pit.sequential("who", *order)
    out = pit.last_known(df, "who", "v", 4, order, frame, "last").collect()
    assert len(out) == len(rows)
    for r in out:
        before = sorted((d, n, u, v) for u, w, d, n, v in rows if w is not None and w == r.who and v is not None and (d < r.day if strict else (d, n, u) < (r.day, r.no, r.uid)))
        values = [x[3] for x in before]
        assert r.last_n == len(values) and (r.last or []) == values[::-1][:4]
        assert (r.last_sum, r.last_squares, r.last_max) == ((sum(values), sum(v * v for v in values), max(values)) if values else (None, None, None))


def test_rank_before(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([1, 2, None]), rng.randrange(30), rng.choice([None, 0, 1, 2, 3, 7, 8, 1000])) for i in range(250)]
    out = pit.rank_before(spark.createDataFrame(rows, "uid long, who long, day int, v long"), "who", "v", "uid").collect()
    for r in out:
        seen = [v for _, w, d, v in rows if r.who is not None and r.v is not None and w == r.who and d < r.day and v is not None]
        assert (r.n_before, r.n_below, r.n_equal) == (len(seen), sum(v < r.v for v in seen) if seen else 0, sum(v == r.v for v in seen))
