"""Training of the neural model takes every training document once, and the model grows with the corpus."""

from pyspark.sql import functions as F

from paceline.llm import lm_scoring
from paceline.llm.lm_scoring import ROUNDS, class_count, held_out, lm_scores, round_share


def test_rounds_split_the_training_tokens(spark):
    rows = [(i if i % 5 else None, f"text {i} " + "of some words " * (i % 7)) for i in range(2000)] + [(None, None), (None, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    train = [r for r, held in zip(rows, held_out([r[0] for r in rows]), strict=True) if not held]
    kept = spark.createDataFrame(train, docs.schema)
    tokens = F.coalesce(F.size(F.filter(F.split("text", " "), lambda w: w != "")), F.lit(0)) + 1
    shares = [round_share(kept, k).agg(F.sum(tokens)).first()[0] or 0 for k in range(ROUNDS)]
    assert sum(shares) == lm_scores(docs, "id").first()["train_tokens"]
    assert all(0.8 < s * ROUNDS / sum(shares) < 1.2 for s in shares)
    nulls = [round_share(kept.where("id is null"), k).count() for k in range(ROUNDS)]
    assert sum(nulls) == sum(i is None for i, _ in train) and all(nulls)


def test_model_grows_with_the_corpus():
    sizes = [class_count(10**k) for k in range(16)]
    assert sizes == sorted(sizes) and class_count(5 * 10**8) == 256 and class_count(10**14) == 1024


def test_more_classes_than_a_byte_holds(spark, monkeypatch):
    rows = [(i, f"word{i % 11} ends{chr(97 + i % 26)}{chr(97 + i % 25)}z here " * 6) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = {r.doc_id: r for r in lm_scores(docs).collect()}
    monkeypatch.setattr(lm_scoring, "class_count", lambda n_bytes: 512)
    after = {r.doc_id: r for r in lm_scores(docs).collect()}
    assert before.keys() == after.keys()
    assert all(before[i].base_score == after[i].base_score and after[i].score < 0 for i in after)
