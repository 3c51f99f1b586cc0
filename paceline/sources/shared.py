"""Tables that a job keeps for itself in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``. Local sessions without that setting, such as tests, get a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of its own and read back, which cuts its lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
