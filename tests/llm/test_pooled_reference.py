"""The pooled reference comes from all languages, however many there are."""

import random

import pytest

from paceline.llm import quality_rules


def test_pooled_reference_counts_every_language(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for k in range(12):
        letters = "abcdefgh"[: 2 + k % 6] + "ABCDEFGH"[: k % 5] + "0123"[: k % 4]
        for _ in range(25 if k == 0 else 3):
            text = " ".join(rng.choice(["the", "of", "and"]) if rng.random() < k / 24 else "".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(120))
            rows.append((len(rows), text, f"lang{k}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def found():
        return {r.doc_id: (r.class_distance, r.word_distance) for r in quality_rules.quality_rules(docs).collect()}

    few = found()
    monkeypatch.setattr(quality_rules, "MAX_BROADCAST_LANGS", 2)
    many = found()
    assert few.keys() == many.keys() == set(range(len(rows)))
    for i in few:
        assert many[i] == pytest.approx(few[i], abs=1e-9)
