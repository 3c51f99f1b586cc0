"""Ancestor closures against plain recursion: cycles, hot sires, long lines, and known coefficients."""

import random

import pytest

from paceline.operators import lineage

SCHEMA = "horse long, sire long, dam long, animal int, path int"


def frame(spark, parents):
    return spark.createDataFrame([(h, s, d, 1, 2) for h, (s, d) in parents.items()], SCHEMA).repartition(3)


def walked(parents, generations):
    out = []

    def go(start, side, path):
        out.append((start, side, path[-1], len(path), tuple(path)))
        if len(path) < generations:
            for up in parents.get(path[-1], ()):
                if up is not None and up not in path and up != start:
                    go(start, side, [*path, up])

    for h, (s, d) in parents.items():
        for side, up in (("sire", s), ("dam", d)):
            if up is not None and up != h:
                go(h, side, [up])
    # An animal that is its own parent has no such step further up either.
    return sorted(out)


def coefficients(paths, rounds):
    of, own = {}, {}
    for a, side, anc, n, way in paths:
        of.setdefault(a, {"sire": [], "dam": []})[side].append((anc, n, set(way[:-1])))
    for _ in range(rounds):
        new = {}
        for a, sides in of.items():
            total = [0.5 ** (n + m - 1) * (1 + own.get(x, 0.0)) for x, n, w in sides["sire"] for y, m, v in sides["dam"] if x == y and not w & v]
            if total:
                new[a] = sum(total)
        own = new
    return own


@pytest.fixture(scope="module")
def herd():
    rng = random.Random(2)
    parents = {h: (rng.choice([None, *range(max(0, h - 30), h)]) if h else None, rng.choice([None, *range(max(0, h - 30), h)]) if h else None) for h in range(150)}
    for h in range(150, 350):  # a sire with most of all animals
        parents[h] = (7, rng.choice([None, *range(150)]))
    parents |= {900: (901, 5), 901: (902, None), 902: (900, 3), 903: (903, 900), 904: (900, 901)}  # a cycle, its own parent, and a descendant of the cycle
    return parents


@pytest.mark.parametrize("generations", [1, 2, 3, 5])
def test_paths_equal_recursion(spark, herd, generations):
    out = lineage.ancestor_paths(frame(spark, herd), "horse", "sire", "dam", generations)
    assert sorted((r.animal, r.side, r.ancestor, r.steps, tuple(r.path)) for r in out.collect()) == walked(herd, generations)


def test_coefficients_equal_recursion(spark, herd):
    paths = lineage.ancestor_paths(frame(spark, herd), "horse", "sire", "dam", 4)
    found = {r.animal: r.inbreeding for r in lineage.inbreeding(paths).collect()}
    assert found == pytest.approx(coefficients(walked(herd, 4), 3)) and len(found) > 10


def test_known_coefficients(spark):
    full_sibs = {1: (None, None), 2: (None, None), 3: (1, 2), 4: (1, 2), 5: (3, 4), 6: (1, 3), 7: (5, 8), 8: (None, 5)}
    found = {r.animal: (r.inbreeding, r.n_common, r.nearest) for r in lineage.inbreeding(lineage.ancestor_paths(frame(spark, full_sibs), "horse", "sire", "dam", 6)).collect()}
    assert found[5] == (0.25, 2, 4) and found[6] == (0.25, 1, 3)
    assert found[7] == (0.25 * 1.25, 1, 3)  # a parent and its child, the parent inbred itself


def test_lines(spark, herd):
    long = {h: (h - 1 if h > 1000 else None, None) for h in range(1000, 1301)}
    parents = herd | long | {2000: (5000, None)}  # 5000 has no row of its own
    out = {r.animal: (r.founder, r.depth) for r in lineage.lines(frame(spark, parents), "horse", "sire").collect()}

    def line(h):
        n, seen = 0, set()
        while parents.get(h, (None,))[0] is not None:
            if h in seen:
                return (None, None)
            seen.add(h)
            h, n = parents[h][0], n + 1
        return (h, n)

    assert out == {h: line(h) for h in [*parents, 5000]}
    assert out[1300] == (1000, 300) and out[900] == (None, None) and out[2000] == (5000, 1)


def test_no_parents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert lineage.ancestor_paths(none, "horse", "sire", "dam", 4).count() == 0 and lineage.lines(none, "horse", "sire").count() == 0
    alone = frame(spark, {1: (None, None)})
    assert lineage.inbreeding(lineage.ancestor_paths(alone, "horse", "sire", "dam", 4)).count() == 0
