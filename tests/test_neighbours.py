"""Nearest neighbours against brute force: clusters, ties, copies, missing axes, poles and the date line."""

import math
import random

import pytest

from paceline.operators.neighbours import EARTH_KM, imputed_by_neighbours, nearest, nearest_places

POINTS = "id long, x double, y double, z double, v double, neighbour int, rank int"


def data(n, seed, dims=3):
    rng = random.Random(seed)
    spot = lambda i: [rng.uniform(-50, 900) for _ in range(3)] if i % 3 else [rng.gauss(100, 0.01) for _ in range(3)]
    rows = [(i, *spot(i)) for i in range(n)]
    rows += [(n + i, 5.0, 5.0, 5.0) for i in range(n // 3)]  # copies
    rows += [(2 * n + i, float(i % 4), float(i // 4 % 4), 0.0) for i in range(32)]  # a lattice full of ties
    rng.shuffle(rows)
    return rows


def frame(spark, rows, extra=(1, 2)):
    return spark.createDataFrame([(*r, 1.0, *extra) for r in rows], POINTS).repartition(3)


def brute(queries, points, axes, k, unit):
    out = []
    for q in queries:
        far = sorted((math.sqrt(sum(((q[1 + i] - lo[i]) / unit[i] - (p[1 + i] - lo[i]) / unit[i]) ** 2 for i in range(axes))), p[0]) for lo in [unit_low(queries, points, axes)] for p in points)
        out += [(q[0], p, round(d, 9), r + 1) for r, (d, p) in enumerate(far[:k])]
    return sorted(out)


def unit_low(queries, points, axes):
    return [min(r[1 + i] for r in [*queries, *points]) for i in range(axes)]


@pytest.mark.parametrize(("axes", "k", "full"), [(3, 5, None), (2, 3, 4), (1, 4, None), (2, 1, 2)])
def test_nearest_equals_brute_force(spark, axes, k, full):
    points, queries = data(150, 1), data(40, 2)
    if axes == 1:
        points = [(i, round(x), y, z) for i, x, y, z in points]  # many equal distances
        points = [(i, float(x), y, z) for i, x, y, z in points]
    both = [*points, *queries]
    unit = [(max(r[1 + i] for r in both) - min(r[1 + i] for r in both)) or 1.0 for i in range(axes)]
    out = nearest(frame(spark, queries).drop("neighbour", "rank"), frame(spark, points), ["x", "y", "z"][:axes], k, "id", full=full)
    assert sorted((r.id, r.neighbour, round(r.distance, 9), r.rank) for r in out.collect()) == brute(queries, points, axes, k, unit)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_few_points_and_missing_axes(spark):
    points = frame(spark, [(1, 1.0, 1.0, 1.0), (2, 2.0, None, 1.0), (3, float("nan"), 1.0, 1.0), (4, 3.0, 3.0, 3.0)])
    queries = frame(spark, [(10, 1.0, 1.0, 1.0), (11, None, 1.0, 1.0), (12, float("inf"), 0.0, 0.0)]).drop("neighbour", "rank")
    out = nearest(queries, points, ["x", "y"], 3, "id")
    assert sorted((r.id, r.neighbour, r.rank) for r in out.collect()) == [(10, 1, 1), (10, 4, 2)]
    assert nearest(queries, points.where("id > 99"), ["x", "y"], 3, "id").count() == 0


def test_imputation(spark):
    rng = random.Random(4)
    rows = [(i, rng.uniform(0, 10), rng.uniform(0, 10), 0.0, float(rng.randrange(100)) if i % 4 else None, 1, 2) for i in range(120)] + [(500, None, 1.0, 0.0, None, 1, 2), (501, 1.0, 1.0, 0.0, 7.0, 1, 2)]
    out = {r.id: r.v for r in imputed_by_neighbours(spark.createDataFrame(rows, POINTS), "v", ["x", "y"], 4, "id", {"x": 1.0, "y": 1.0}).collect()}
    known = [r for r in rows if r[4] is not None and r[1] is not None]
    assert len(out) == len(rows) and out[500] is None and out[501] == 7.0
    for r in rows:
        if r[4] is None and r[1] is not None:
            near = sorted((math.hypot(r[1] - p[1], r[2] - p[2]), p[0], p[4]) for p in known)[:4]
            assert out[r[0]] == pytest.approx(sum(p[2] for p in near) / 4)


def test_places_at_poles_and_the_date_line(spark):
    rng = random.Random(6)
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(80)] + [(100, 89.9, 10.0), (101, -89.9, 170.0), (102, 0.0, 179.9), (103, 0.0, -179.9), (104, 51.5, 0.0)]
    asked = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)] + [(900, 90.0, -170.0), (901, -90.0, 0.0), (902, 0.1, -179.95), (903, 0.1, 180.0), (904, None, 3.0)]
    schema = "id long, lat double, lon double"
    out = nearest_places(spark.createDataFrame(asked, schema), spark.createDataFrame(spots, schema), "id", 2)

    def km(a, b):
        p, q = math.radians(a[1]), math.radians(b[1])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * EARTH_KM * math.asin(math.sqrt(h))

    expected = {(a[0], r + 1): (s[0], km(a, s)) for a in asked if a[1] is not None for r, s in enumerate(sorted(spots, key=lambda s: km(a, s))[:2])}
    found = {(r.id, r.rank): (r.neighbour, r.km) for r in out.collect()}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    assert all(found[k][1] == pytest.approx(v[1], abs=1e-6) for k, v in expected.items())
