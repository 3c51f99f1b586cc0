"""Weighted clustering and the conversation trie against brute force on small fixtures."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from paceline.llm import conversation_trie as trie
from paceline.llm.centroids import nearest, packed, unpacked, weighted_kmeans
from paceline.llm.conversation_trie import conversation_trie
from paceline.llm.lookup import looked_up

# ---------------------------------------------------------------- clustering


def clustered(rows, k, rounds, dims, scale, salt):
    """Lloyd's rounds over every row, in Python's integers."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"{salt}{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    if not seeds:
        return []
    centroids = [q for _, q in seeds]
    far = lambda q, c: sum((a - b) ** 2 for a, b in zip(q, c, strict=True))
    best = lambda q: min((far(q, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(best(q)[1], []).append(q)
        centroids = [tuple(sum(col) // len(groups[j]) for col in zip(*groups[j], strict=True)) if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *best(q)[::-1], q) for i, q in kept]
    inertia = {j: sum(d for _, c, d, _ in found if c == j) for j in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    copies = {q: sum(p == q for _, p in kept) for _, q in kept}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c], copies[q]) for i, c, d, q in found), key=repr)


def vectors():
    rng = random.Random(11)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(120)]
    rows += [(i, [0.25, -0.5, 1.0, -1.75]) for i in range(200, 320)]  # a third of all rows are one vector
    rows += [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(4)]) for i in range(400, 460)]
    rows += [(500, None), (501, [1.0] * 3), (502, [1.0] * 5), (503, [1.0, None, 1.0, 1.0]), (504, [1.0, float("nan"), 0.0, 0.0]), (505, [float("inf")] * 4), (506, [])]
    rows += [(None, [0.5] * 4), (None, None), (7, [9.0, 9.0, 9.0, 9.0]), (7, rows[7][1]), (-3, [-0.001, 0.001, -1e-9, 0.0])]
    rng.shuffle(rows)
    return rows


SCHEMA = "vec_id long, embedding array<double>, cluster int, key binary, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, b"k", 2) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("k", "rounds"), [(5, 4), (40, 5), (400, 2), (3, 0)])
def test_clusters_equal_brute_force(spark, k, rounds):
    rows = vectors()
    out = weighted_kmeans(frame(spark, rows), k, rounds, 4, 256.0, "2:")
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "weight"]
    assert sorted(map(tuple, out.collect()), key=repr) == clustered(rows, k, rounds, 4, 256.0, "2:")


def test_no_vectors(spark):
    assert weighted_kmeans(frame(spark, [(1, None), (2, [1.0])]), 3, 2, 4).count() == 0
    assert weighted_kmeans(spark.createDataFrame([], SCHEMA), 3, 2, 4).count() == 0
    assert weighted_kmeans(frame(spark, [(None, [1.0] * 4)]), 3, 2, 4).count() == 0


def test_ties_go_to_the_smaller_number():
    q = np.array([[0, 0], [2, 0]])
    assert nearest(np.array([[1, 0], [1, 5]]), q)[0].tolist() == [0, 0]


def test_large_components_are_exact():
    rng = np.random.default_rng(1)
    q, c = rng.integers(-(1 << 27), 1 << 27, (50, 64)), rng.integers(-(1 << 27), 1 << 27, (7, 64))
    cluster, distance = nearest(q, c)
    exact = [min((sum((a - b) ** 2 for a, b in zip(row, other, strict=True)), j) for j, other in enumerate(c.tolist())) for row in q.tolist()]
    assert [(int(d), int(j)) for d, j in zip(distance, cluster, strict=True)] == exact
    keys = packed(q)
    assert (unpacked(pa.array(keys), 64) == q).all() and sorted(keys) == packed(np.array(sorted(q.tolist())))


def test_a_component_beyond_the_range_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        weighted_kmeans(frame(spark, [(1, [1e9] * 4)]), 2, 1, 4).collect()


def test_hot_keys_are_looked_up_without_a_shuffle(spark):
    left = spark.createDataFrame([(1, i) for i in range(500)] + [(k, 0) for k in range(2, 100)], "k long, v long")
    right = left.groupBy("k").count().withColumn("name", left.k * 0 + 5)
    out = looked_up(left, right, ["k"], "count", left.count())
    assert out.count() == 598 and out.where("name = 5").count() == 598
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- trie


def nodes(rows):
    """The trie by the words of its definition."""
    own = {}
    for c, n, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((n is not None, n or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    below = lambda k: [x for x in members if x[: len(k)] == k]
    kids = {k: [x for x in members if len(x) == len(k) + 1 and x[: len(k)] == k] for k in members}
    out = []
    for k, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(own_members) if len(paths[c]) == len(k))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below(k) if x)
        out.append((min(own_members), len(k), min(members[k[:-1]]) if k else None, len(own_members), len(kids[k]), sum(not kids[x] for x in below(k)), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n=90):
    rng = random.Random(seed)
    turn = lambda: rng.choice(["hello", "what", "é", "", None, "a longer turn of the talk"])
    rows = []
    for c in range(-12, n):
        if rng.random() < 0.1:
            continue
        rows += [(c, rng.choice([i, i, i, None]), rng.choice(["user", "assistant", None]), turn()) for i in range(rng.choice([1, 2, 3, 8, 12]))]
    rows += [(c, i, "user", f"the same {i}") for c in range(500, 560, 5) for i in range(4)]  # copies
    rows += [(600, i, "user", str(rng.randrange(3))) for i in range(300)]  # one long conversation
    rows += [(605, i, "user", rows[-300 + i][3]) for i in range(300)]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(700, 1, "user", "twice"), (700, 1, "user", "twice"), (700, 1, "user", "once")]
    rng.shuffle(rows)
    return rows


TURNS = "conv_id long, turn long, role string, text string, depth int, a int, pid int"


@pytest.fixture
def many_partitions(spark):
    """Small inputs keep all their partitions, so that long conversations and hot nodes cross boundaries."""
    for k, v in (("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.shuffle.partitions", "13")):
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_trie_equals_brute_force(spark):
    check_trie(spark, 1)


def test_trie_equals_brute_force_over_many_partitions(spark, many_partitions):
    check_trie(spark, 2)


def check_trie(spark, seed):
    rows = conversations(seed)
    out = conversation_trie(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS).repartition(5))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == nodes(rows)


def test_conversations_span_partitions(spark, many_partitions):
    rows = conversations(3, n=5)
    prefixes = trie.occurrences(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS).repartition(2))
    assert prefixes.where("conv = 600").select("pid").distinct().count() > 1
    assert prefixes.where("conv = 600").selectExpr("max(depth)", "max(length)", "count(*)").first()[:] == (300, 300, 301)


def test_turnless_and_no_conversations(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    (only,) = conversation_trie(spark.createDataFrame([(c, 0, "user", "x", 1, 1, 1)], TURNS)).collect()
    assert tuple(only) == (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
    assert conversation_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_many_ends_are_hashed_in_order(spark, many_partitions):
    rows = [(c, 0, "user", "same") for c in range(0, 10000, 5)]
    out = {r.depth: r for r in conversation_trie(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS).repartition(4)).collect()}
    assert out[1].ends_sha256 == hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest()
    assert (out[1].n_convs, out[1].saved_tokens, out[0].saved_tokens) == (2000, 1999 * 4, 1999 * 4)
