"""The pipeline's stages and queries on the smallest tables."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from paceline.llm.queries import QUERIES
from paceline.llm.quality_rules import quality_rules
from paceline.llm.sql import ORACLES
from tests.llm.test_operators import brute_components
from tests.llm.test_pii_coreference import luhn
from tests.test_queries import TABLES, cells

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
PRIVATE = re.compile(r"[\w.]+@[\w.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b[0-9a-fA-F]{40}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    found, expected = QUERIES[name](spark, SMALL).toPandas(), c.execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns) and cells(found) == cells(expected)


def test_stages(spark, tmp_path):
    """Each stage against its own rule by brute force, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, benchmark = docs.columns, [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SMALL).write.parquet(f"file://{tmp_path}/{k}")
        verdicts = {r.doc_id: r.kept for r in quality_rules(docs).collect()} if name == "quality" else {}
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        after = docs.collect()
        assert name == "mixing" or docs.columns == columns
        ids = sorted(r.doc_id for r in after)
        if name == "quality":
            assert ids == sorted(i for i, kept in verdicts.items() if kept) and len(ids) < len(before)
        elif name == "near_duplicates":
            assert ids == sorted(d for d, _, c in brute_components([(r.doc_id, r.text) for r in before], 5, 80) if c == d)
        elif name == "decontamination":
            assert ids == sorted(r.doc_id for r in before if not any(" ".join(b.split()) in " ".join(r.text.split()) for b in benchmark))
        elif name == "pii":
            assert ids == sorted(r.doc_id for r in before)
            found = {x for r in before for x in PRIVATE.findall(r.text)}
            decoys = {x for x in found if re.fullmatch(r"\d{16}", x) and luhn(x)}  # by their check digit these are no cards, and stay
            secrets = found - decoys
            assert all(sum(x in r.text for r in before) == sum(x in r.text for r in after) for x in decoys)
            assert secrets and not any(x in r.text for r in after for x in secrets) and all(r.n_chars == len(r.text) for r in after)
        else:
            assert set(ids) <= {r.doc_id for r in before} and docs.columns == [*columns, "copy"]


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns[-1] == "copy" and out.count() > 0
