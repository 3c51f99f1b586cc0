"""Dealing a corpus into evenly filled groups of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP_BYTES = 8_000_000


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0


def group_count(docs: DataFrame, text_col: str = "text", size: int = GROUP_BYTES, total: int | None = None) -> int:
    """How many groups of about ``size`` bytes of text the documents make; ``total`` is their bytes where they are known."""
    total = text_bytes(docs, text_col) if total is None else total
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, -(-total // size))


def group_of(id_col: str, text_col: str, n: int) -> Column:
    """A document's group; rows without an id are dealt by their text."""
    return F.pmod(F.xxhash64(F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col))), F.lit(n)).cast("int")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Local runs without one, such as tests, get a temporary folder."""
    import tempfile

    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, which cuts its lineage."""
    import gc
    import uuid

    gc.collect()  # lets go of the plans of steps that nothing refers to, which the driver would keep
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote for tables that nothing will read again."""
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t._stored_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
