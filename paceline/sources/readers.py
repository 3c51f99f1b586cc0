"""Scans of the formats in use, each as a Spark reader; nothing is read on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.sources.json_records import split_json_array, split_json_map


def json_lines(spark: SparkSession, path: str, schema: T.StructType, keep_bad: bool = False) -> DataFrame:
    """JSON lines; broken lines are dropped, or kept as text in ``_corrupt_record``."""
    if keep_bad:
        return spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])).option("mode", "PERMISSIVE").json(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each, whole or cut off, read in splits."""
    return split_json_array(spark, path, schema)


def json_map(spark: SparkSession, path: str, schema: T.StructType, key: str = "key") -> DataFrame:
    """Files that hold one JSON object each, whose values are the records, read in splits."""
    return split_json_map(spark, path, schema, key)


def csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header; without a schema the types are inferred by a pass over the data."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def by_suffix(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A scan chosen by the path's suffix."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "csv":
        return csv(spark, path, schema)
    if kind in ("jsonl", "json"):
        if schema is None:
            return spark.read.option("multiLine", kind == "json").json(path)
        return json_lines(spark, path, schema) if kind == "jsonl" else json_array(spark, path, schema)
    raise ValueError(f"no reader for {path}")


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first path that its file system has, whatever store it is in."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(conf).exists(at):
            return path
    raise FileNotFoundError(", ".join(paths))


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and its number of lines that aren't blank, ``n``; files are counted in splits."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("v"))
    return lines.groupBy("file").agg(F.count_if(F.col("v") != "").alias("n"))


def texts_in_any_encoding(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``value``, the lines of files in UTF-8 or, line by line, in Latin-1."""
    # The text reader leaves a line's bytes as they are.
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), latin_or_utf8(F.col("value").cast("binary")).alias("value"))


def latin_or_utf8(raw: Column) -> Column:
    """Text of bytes in UTF-8, or in Latin-1 where they aren't valid UTF-8."""
    utf = F.try_validate_utf8(raw.cast("string"))
    return F.coalesce(utf, F.decode(raw, "ISO-8859-1"))
