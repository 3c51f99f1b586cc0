"""A training corpus in five stages: quality rules, near-duplicate removal, decontamination, PII, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm.decontamination import without_leaks
from paceline.llm.ngram_join import ngram_components
from paceline.llm.pii import without_pii
from paceline.llm.quality_rules import quality_filter
from paceline.llm.source_mixing import mix_sources
from paceline.llm.spread import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, repeated rows and null ids are judged like any other."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies (five-word n-grams, similarity of 0.8 or more).

    Rows without an id stay; of rows with one id and one text one stays.
    """
    name = "first_id" + "_" * max(map(len, docs.columns))  # no column of the documents is as long
    first = ngram_components(docs, size=5, percent=80).where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    named = docs.where("doc_id is not null").join(first, F.col("doc_id") == F.col(name), "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; with an empty benchmark all stay."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for their personal data, drawn with the key in ``spark.paceline.pii.key``; null texts stay null."""
    return without_pii(docs, key=spark.conf.get("spark.paceline.pii.key", "pipeline"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights, globally shuffled; a null source is a source of its own."""
    return mix_sources(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminated), ("pii", private), ("mixing", mixed)]

#: Near-duplicate groups, latent retrieval and keyed surrogates have no SQL of reasonable cost; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as a table before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
