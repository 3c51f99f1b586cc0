"""Centroid clustering over distinct vectors with multiplicities.

Components are quantised to integers. Equal vectors are counted once in a
grouping that Spark combines before it shuffles; Lloyd's rounds run over the
distinct ones with their counts as weights, so a round reads each different
vector once however many copies it has. A task returns one row of integer
sums a cluster; Spark adds them as decimals, and the centroids, whose size is
fixed by k and the number of components, are floored quotients of exact
integers. At the end the assignment of each distinct vector is joined back to
the ids: vectors that own a large share of the rows by a broadcast of bounded
length, the others by a shuffle.

Distances are exact: products are taken in float64 where all sums stay below
2**53, in 64-bit integers beyond. A quantised component past 2**27 raises an
error, as its squared distance need not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.lookup import looked_up
from paceline.llm.spread import stored

LARGEST = 1 << 27
_SIGN = 1 << 31
#: Up to this component, 64 products and their sums are exact in float64; others are multiplied as integers.
_FLOAT_EXACT = 1 << 22
_BLOCK = 4096


def packed(q: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes whose order is that of the components."""
    wide = (q + _SIGN).astype(">u4")
    return [r.tobytes() for r in wide]


def unpacked(keys: pa.Array, dims: int) -> np.ndarray:
    """Integers of the packed rows."""
    data = b"".join(keys.to_pylist())
    return np.frombuffer(data, ">u4").reshape(-1, dims).astype(np.int64) - _SIGN


def quantised(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: float) -> DataFrame:
    """``id`` and packed ``key`` of the vectors with exactly ``dims`` components, none of them null or not finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            keep = np.asarray(column.value_lengths().fill_null(-1)) == dims
            ids, column = batch.column(0).filter(pa.array(keep)), column.filter(pa.array(keep))
            flat = column.flatten().cast(pa.float64())
            x = np.asarray(flat.fill_null(np.nan)).reshape(-1, dims)
            fine = np.isfinite(x).all(axis=1)
            q = np.floor(scale * x[fine])
            if (np.abs(q) > LARGEST).any():
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            yield pa.record_batch([ids.filter(pa.array(fine)).cast(pa.int64()), pa.array(packed(q.astype(np.int64)), pa.binary())], ["id", "key"])

    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return slim.mapInArrow(run, "id long, key binary")


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller on ties, and the squared distance."""
    cluster, distance = np.empty(len(q), np.int64), np.empty(len(q), np.int64)
    for at in range(0, len(q), _BLOCK):
        part = q[at : at + _BLOCK]
        exact = max(np.abs(part).max(initial=0), np.abs(centroids).max(initial=0)) <= _FLOAT_EXACT and part.shape[1] <= 128
        kind = np.float64 if exact else np.int64
        cross = part.astype(kind) @ centroids.T.astype(kind)
        d = (part * part).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None, :] - 2 * cross.astype(np.int64)
        own = d.argmin(axis=1)
        cluster[at : at + _BLOCK], distance[at : at + _BLOCK] = own, d[np.arange(len(part)), own]
    return cluster, distance


def _sums(distinct: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster``, ``dim`` and exact ``total`` of the weighted components; dim -1 has the weights, -2 the weighted distances."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [[0] * (dims + 2) for _ in range(k)]
        for batch in batches:
            q, weight = unpacked(batch.column(0), dims), np.asarray(batch.column(1))
            cluster, distance = nearest(q, centroids)
            for c in np.unique(cluster):
                own = cluster == c
                w = weight[own].astype(object) if weight[own].sum() > 1 << 24 or distance[own].max() > 1 << 36 else weight[own]
                whole = np.column_stack([distance[own], np.ones(own.sum(), np.int64), q[own]])
                totals[c] = [a + int(b) for a, b in zip(totals[c], w @ whole.astype(w.dtype), strict=True)]
        rows = [(c, d - 2, v) for c, row in enumerate(totals) for d, v in enumerate(row) if v]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([str(r[2]) for r in rows], pa.string())], ["cluster", "dim", "part"])

    parts = distinct.mapInArrow(run, "cluster int, dim int, part string")
    return parts.groupBy("cluster", "dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))


def weighted_kmeans(vectors: DataFrame, k: int, rounds: int, dims: int, scale: float = 256.0, salt: str = "", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Lloyd's clustering of quantised vectors.

    Returns ``vec_id`` (under the name of ``id_col``), ``cluster``,
    ``distance`` (squared), ``cluster_inertia``, ``inertia``,
    ``centroid_sha256`` and ``weight`` (rows with the same vector), one row
    for each kept row of the input.

    Centroids start as the k kept vectors with the smallest SHA-256 of
    ``salt`` and the id; rows with equal ids follow the components, so each of
    them may start one. With fewer rows there are fewer centroids, with none
    the result is empty. Rows without an id start no centroid but are
    clustered; if no row has an id the result is empty. Rows whose vector is
    null, too short or too long, or has a null or non-finite component are
    left out. Other columns aren't read.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, dims, scale)
    seeds = rows.where("id is not null").select(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256).alias("h"), "key").orderBy("h", "key").limit(k).collect()
    schema = f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, weight long"
    if not seeds:
        return spark.createDataFrame([], schema)
    centroids = unpacked(pa.array([bytes(s["key"]) for s in seeds]), dims)
    distinct = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("weight")), "distinct-vectors")
    for _ in range(rounds):
        found = {(r["cluster"], r["dim"]): int(r["total"]) for r in _sums(distinct, centroids).collect()}
        centroids = np.array([[found.get((c, d), 0) // n for d in range(dims)] if (n := found.get((c, -1))) else own for c, own in enumerate(centroids.tolist())], np.int64)
    last = {(r["cluster"], r["dim"]): int(r["total"]) for r in _sums(distinct, centroids).where("dim < 0").collect()}
    total, inertia = sum(v for (_, d), v in last.items() if d == -1), sum(v for (_, d), v in last.items() if d == -2)
    clusters = [(c, last.get((c, -2), 0), inertia, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(unpacked(batch.column(0), dims), centroids)
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(1), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["key", "weight", "n", "cluster", "distance"])

    assigned = distinct.mapInArrow(run, "key binary, weight long, n long, cluster int, distance long")
    named = spark.createDataFrame(clusters, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = looked_up(rows, assigned, ["key"], "n", total).join(F.broadcast(named), "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "weight")
