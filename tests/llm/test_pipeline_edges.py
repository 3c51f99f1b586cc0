"""The pipeline's stages over clashing column names, nulls, repeated rows and empty tables."""

import random

import pytest

import corpus_pipeline

NAMES = ["_lang", "_ref_classes", "_ref_words", "first_id", "row", "stats", "kept", "component_id", "of", "mix_id", "mix_source", "pieces", "entities", "key", "id", "u", "v"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in NAMES)


def rows():
    rng = random.Random(9)
    words = ["the", "of", "and", "river", "stone", "was", "near", "walking", "to", "a", "house", "green", "bird"]
    text = lambda: " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(80))
    out = [(i, text(), ["en", None][i % 2], ["s", "t", None][i % 3]) for i in range(40)]
    out += [(50, out[3][1], "en", "s"), (51, out[3][1] + " end", "en", "s"), (None, text(), "en", "t"), (None, None, None, None), (52, None, "en", "s"), (53, "", "en", "s"), out[5], out[5]]
    return [(d, t, lang, s, len(t or ""), *range(len(NAMES))) for d, t, lang, s in out]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(1, "a passage that no document holds at all, by any measure of it")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return f"file://{at}"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns_and_odd_rows(spark, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    out = stage(spark, docs, folder)
    assert [c for c in out.columns if c != "copy"] == docs.columns
    found = out.collect()
    assert all(tuple(r[n] for n in NAMES) == tuple(range(len(NAMES))) for r in found)
    if name == "near_duplicates":
        ids = [r.doc_id for r in found if r.doc_id is not None]
        assert 3 in ids and not {50, 51} & set(ids) and ids.count(5) == 1 and sum(r.doc_id is None for r in found) == 2
    if name == "quality":
        assert not {52, 53} & {r.doc_id for r in found} and sum(r.doc_id == 5 for r in found) in (0, 3)
    if name in ("decontamination", "pii"):
        assert len(found) == len(rows())
    empty = stage(spark, docs.limit(0), folder)
    assert empty.count() == 0
