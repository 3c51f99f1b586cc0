"""Registered queries over the corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm.centroids import weighted_kmeans
from paceline.llm.conversation_trie import conversation_trie
from paceline.llm.decontamination import find_leaks
from paceline.llm.html_extraction import extract_text
from paceline.llm.license_scan import license_scan
from paceline.llm.lm_scoring import lm_scores
from paceline.llm.ngram_join import ngram_components
from paceline.llm.order_minhash import document_fingerprints
from paceline.llm.pii import replace_pii
from paceline.llm.quality_rules import quality_rules
from paceline.llm.source_mixing import mix_sources
from paceline.llm.substring_dedup import substring_dedup
from paceline.llm.warc import warc_round_trip


#: The registered query's key; a job passes a secret of its own.
PII_KEY = "registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(_table(spark, sf_dir, "documents"), PII_KEY)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op6_warc_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(_table(spark, sf_dir, "pages")).drop("payload")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(_table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_kmeans(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256.0, salt="2:")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_source_mixing, op3_pii_surrogates, op4_quality_rules, op5_license_scan, op6_warc_assembly, op7_ngram_join, op8_html_extraction, op9_lm_scoring, op10_decontamination, op11_order_minhash, op12_centroid_clustering, op13_conversation_trie)}
