"""Benchmark items longer than the shortest passages."""

import random

from paceline.llm.decontamination import SCALES, find_leaks, scales_for


def test_scales_fit_the_longest_item():
    assert scales_for(0) == scales_for(59) == SCALES
    for n in (257, 640, 641, 1000, 100_000):
        found = scales_for(n)
        assert found[-2] < 1.5 * n <= found[-1] and all(x % 3 == 0 for x in found)


def test_long_items_are_found_at_any_offset(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = {1: text(1000), 2: text(600), 3: text(500), 4: text(20)}
    docs = []
    for k, item in items.items():
        for offset in (0, 130, 257, 391, 700):
            docs.append((len(docs), k, text(offset) + item + text(300)))
        fuzzy = [w if rng.random() < 0.72 else rng.choice(words) for w in item]
        if k in (1, 3):
            docs.append((len(docs), k, text(210) + fuzzy + text(300)))
    docs += [(len(docs) + i, None, text(2500)) for i in range(5)]
    docs.append((len(docs), None, text(100) + items[1][:500] + text(100)))
    d = spark.createDataFrame([(i, " ".join(t)) for i, _, t in docs], "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()], "item_id long, text string")
    found = {r.doc_id: [h.item_id for h in r.hits] for r in find_leaks(d, b).collect()}
    assert found == {i: [] if k is None else [k] for i, k, _ in docs}
