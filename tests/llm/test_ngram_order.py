"""The global order of n-grams where the sketch of their counts is full."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from paceline.llm import ngram_join
from paceline.llm import textnum as tn


def longest_column(texts: list[str], rule: ngram_join.Rule, order: ngram_join.Order) -> int:
    """Sets in the longest column of the deciding n-grams."""
    shared, grams = SimpleNamespace(value=order), []
    for b in ngram_join._prefixes(rule, shared, 4)(iter([pa.record_batch({"text": texts})])):
        grams += [np.frombuffer(x.as_buffer(), np.uint64) for x in b["grams"]]
    return int(np.unique(np.concatenate(grams), return_counts=True)[1].max())


def test_frequent_words_stand_last_under_a_full_sketch(monkeypatch):
    monkeypatch.setattr(ngram_join, "COUNTERS", 64)
    rng, rule = random.Random(3), ngram_join.Rule(2, 85)
    # A third of the words are of three kinds, so a ninth of the pairs are of these; the sketch holds hundreds of n-grams a counter.
    texts = [" ".join(rng.choice("abc") if rng.random() < 0.35 else f"w{rng.randrange(20_000)}" for _ in range(100)) for _ in range(400)]
    data, offsets = tn.text_buffers(pa.array(texts))
    w = tn.words(data, offsets)
    _, grams, _ = ngram_join.sets(w, rule)
    counts = lambda x, n: np.bincount(ngram_join._spots(x, n), minlength=n)
    sketch, words = counts(grams, ngram_join.COUNTERS), counts(w.hashes, ngram_join.WORD_COUNTERS)
    by_sketch = ngram_join.Order(sketch.astype(np.int64), np.zeros(ngram_join.WORD_COUNTERS, np.int64), 0)
    assert longest_column(texts, rule, by_sketch) > 40  # as it was: the sketch alone
    assert longest_column(texts, rule, ngram_join.Order.of(sketch, words)) < 10


def test_an_n_gram_has_one_level_wherever_it_stands():
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(1))}" for _ in range(3000)]
    texts = [" ".join(words[k : k + 40]) for k in range(0, 2900, 7)]
    data, offsets = tn.text_buffers(pa.array(texts))
    w, rule = tn.words(data, offsets), ngram_join.Rule(4, 85)
    counts = np.bincount(ngram_join._spots(w.hashes, ngram_join.WORD_COUNTERS), minlength=ngram_join.WORD_COUNTERS)
    order = ngram_join.Order.of(np.zeros(ngram_join.COUNTERS), counts)
    _, grams, rare = ngram_join.sets(w, rule, order.rarity)
    level, _ = order.levels(grams, rare)
    assert len({*zip(grams.tolist(), level.tolist(), strict=True)}) == len({*grams.tolist()}) and len({*level.tolist()}) > 5
