"""Tables that change all at once, and results that are kept until their inputs change.

A published table is a folder of versions and of numbered manifests. A job
writes its version beside the others; one rename of a manifest makes it the
newest, and fails if another job has taken the number. Readers follow the
newest manifest, so a job that dies half-way leaves the table as it was.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another job has published first."""


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[str]:
    at, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _text(spark: SparkSession, path: str) -> str:
    at, fs = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """Everything that was ever published at ``path`` and not expired, oldest first."""
    names = [n for n in _listed(spark, f"{path}/manifests") if re.fullmatch(r"\d{12}", n)]
    return [json.loads(_text(spark, f"{path}/manifests/{n}")) | {"number": int(n)} for n in names]


def publish(df: DataFrame, path: str, after: int | None = None, **notes: str | float) -> int:
    """Write ``df`` as the next version of the table at ``path`` and make it the newest; returns its number.

    ``after`` is the number that the new version builds on, by default the
    newest: if another one has been published since, ``Conflict`` is raised
    and the table stays as that job left it.
    """
    spark = df.sparkSession
    known = [int(n) for n in _listed(spark, f"{path}/manifests") if re.fullmatch(r"\d{12}", n)]
    last = max(known, default=0) if after is None else after
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{version}")
    staged, fs = _fs(spark, f"{path}/manifests/.{version}")
    stream = fs.create(staged)
    stream.write(bytearray(json.dumps({"version": version, "at": time.time()} | notes).encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri() if staged.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{last + 1:012d}")
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(staged, target, none)
    except Exception as e:
        fs.delete(staged, False)
        _drop(spark, f"{path}/versions/{version}")
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"{path}: number {last + 1} is taken") from e
        raise
    return last + 1


def published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version of a published table, or the one with a number."""
    found = [m for m in manifests(spark, path) if number in (None, m["number"])]
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/versions/{found[-1]['version']}")


def _drop(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions, and what failed jobs have left; returns how many versions went. No job may be publishing."""
    known = manifests(spark, path)
    stay = {m["version"] for m in known[-keep:]}
    gone = [v for v in _listed(spark, f"{path}/versions") if v not in stay]
    for m in known[:-keep]:
        _drop(spark, f"{path}/manifests/{m['number']:012d}")
    for v in gone:
        _drop(spark, f"{path}/versions/{v}")
    return len(gone)


def files_digest(spark: SparkSession, paths: list[str]) -> str:
    """A digest of the paths, lengths and times of all files below ``paths``, whose contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length", F.col("modificationTime").cast("double").alias("at"))
    row = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", "at")).alias("a"), F.bit_xor(F.xxhash64("at", "length", "path")).alias("b")).first()
    return f"{row['n']}-{row['a'] or 0}-{row['b'] or 0}"


def plan_digest(df: DataFrame) -> str:
    """A digest of what ``df`` computes: its plan without the numbers that Spark gives to expressions."""
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    return hashlib.sha256(re.sub(r"#\d+L?|plan_id=\d+|lambda \w+", "", plan).encode()).hexdigest()


def memoised(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame], folder: str, hours: float | None = None) -> DataFrame:
    """The result of ``build``, from ``folder`` if it is there for these input files and this plan and not older than ``hours``.

    A changed, new or missing file, another plan or another name computes
    anew; the result is published under its digest, so a job that dies while
    it writes leaves nothing that would be read.
    """
    df = build()
    key = hashlib.sha256(f"{name}|{files_digest(spark, inputs)}|{plan_digest(df)}".encode()).hexdigest()[:32]
    path = f"{folder}/{name}/{key}"
    newest = (manifests(spark, path) or [None])[-1]
    if newest is None or (hours is not None and time.time() - newest["at"] > hours * 3600):
        publish(df, path, name=name)
    return published(spark, path)


def memo_status(spark: SparkSession, folder: str) -> list[dict]:
    """Names, keys and ages of the results in ``folder``."""
    return [{"name": n, "key": k, "hours": (time.time() - m["at"]) / 3600} for n in _listed(spark, folder) for k in _listed(spark, f"{folder}/{n}") for m in manifests(spark, f"{folder}/{n}/{k}")[-1:]]


def forget(spark: SparkSession, folder: str, name: str | None = None) -> None:
    """Delete the results of a name, or all."""
    _drop(spark, f"{folder}/{name}" if name else folder)
