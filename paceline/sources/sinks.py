"""Writers: JSON lines, CSV, Parquet, daily archives and lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def parquet(df: DataFrame, path: str, rows_per_file: int = 0, partitions: list[str] | None = None) -> None:
    """Parquet with zstd; ``rows_per_file`` bounds each file."""
    writer = df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without them."""
    nested = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).csv(path)


def three_formats(df: DataFrame, path: str) -> None:
    """JSON lines, CSV and Parquet side by side from one computation: the Parquet copy is read back for the others."""
    parquet(df, f"{path}/parquet")
    again = df.sparkSession.read.parquet(f"{path}/parquet")
    json_lines(again, f"{path}/json")
    csv(again, f"{path}/csv")


def archive(df: DataFrame, path: str, day: str) -> None:
    """Append to an archive partitioned by day."""
    df.write.mode("append").partitionBy(day).parquet(path)


def archived(spark: SparkSession, path: str, day: str, start: str, stop: str, **equal: object) -> DataFrame:
    """Archive rows of a range of days, and of a model, contest or other column's value; only the days' partitions are read."""
    out = spark.read.parquet(path).where(F.col(day).between(F.lit(start).cast("date"), F.lit(stop).cast("date")))
    for column, value in equal.items():
        out = out.where(F.col(column) == value)
    return out


def union_csv(tables: list[DataFrame], path: str) -> None:
    """Rows of several tables in one CSV whose columns are all of theirs, empty where a table lacks one."""
    csv(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(flat, tables)), path)


def save_scaler(limits: DataFrame, path: str) -> None:
    """Parameters of a scaler or calibrator as JSON lines, one row a column."""
    limits.write.mode("errorifexists").json(path)


def load_scaler(spark: SparkSession, path: str) -> dict[str, dict[str, float]]:
    """Saved parameters by column; as many rows as there were columns."""
    return {r["field"]: {k: v for k, v in r.asDict().items() if k != "field"} for r in spark.read.json(path).collect()}


def log_step(spark: SparkSession, path: str, step: str, inputs: list[str], output: str) -> None:
    """Append a step to the lineage table."""
    rows = [(step, i, output) for i in inputs]
    spark.createDataFrame(rows, "step string, input string, output string").withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def lineage(spark: SparkSession, path: str, output: str) -> DataFrame:
    """Every step and table that ``output`` comes from, however deep.

    A chain of more steps than there are tables repeats one, so their number
    ends the search in a log with a cycle.
    """
    log = spark.read.parquet(path)
    log.createOrReplaceTempView("_lineage")
    deepest = log.select("output").distinct().count()
    spark.conf.set("spark.sql.cteRecursionLevelLimit", deepest + 2)
    return spark.sql(
        """WITH RECURSIVE up (step, input, output, depth) AS (
             SELECT step, input, output, 1 FROM _lineage WHERE output = :output
             UNION ALL SELECT l.step, l.input, l.output, depth + 1 FROM _lineage AS l JOIN up ON l.output = up.input WHERE depth < :deepest)
           SELECT DISTINCT step, input, output, depth FROM up""",
        args={"output": output, "deepest": deepest},
    )
