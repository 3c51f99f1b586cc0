"""Large JSON arrays and maps read by many tasks, and whole records salvaged from files that are cut off.

The text reader cuts a file at closing braces instead of lines, so it is split
like any text file, in whatever store Spark reads. Whether a brace counts
depends on all text before it: on the parity of quotes and on the depth. Both
are sums, so a first pass takes them per split, for either beginning; a window
over one row a split carries them along the file. A second pass begins each
split in its own state and puts its records together in the reading task, so
their text isn't shuffled or sorted. Only what a split has of records that
cross its boundaries is shuffled.

Only the end of a cut-off file is lost: its last, open record. A file with an
unbalanced quote loses what follows the quote.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts beyond this many bytes are no records but the trace of an unbalanced quote; they are left out unassembled.
MAX_RECORD_BYTES = 1 << 26

#: Tasks a core at most; beyond that, splits share a task and are read one after the other.
TASKS_A_CORE = 16
_SPLIT = ["file", "block"]
_QUOTE, _BRACE = ord('"'), ord("}")
_STEPS = np.zeros(256, np.int64)
_STEPS[[ord("{"), ord("[")]], _STEPS[[_BRACE, ord("]")]] = 1, -1


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Texts up to each closing brace with their place."""
    raw = spark.read.option("lineSep", "}").text(path)
    placed = raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"))
    return placed.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where another split begins."""
    for batch in batches:
        block, file = (batch.column(c) for c in ("block", "file"))
        new = block.to_numpy()[1:] != block.to_numpy()[:-1]
        if len(batch) > 1:
            new = new | pa.compute.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(batch)]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def _structure(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of fragments with their braces, less escapes; the parity of quotes after each; what each does to the depth; the places of the fragments' ends."""
    plain = np.frombuffer(b"}".join(values).replace(b"\\\\", b"").replace(b'\\"', b"") + b"}", np.uint8)
    parity = np.cumsum(plain == _QUOTE) & 1
    return plain, parity, _STEPS[plain], np.flatnonzero(plain == _BRACE)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a run of fragments of a split: quotes, bytes, and the depth's sum if it begins outside (``s0``) or inside (``s1``) a string."""
    open_run: dict | None = None
    for run in _runs(batches):
        values = run.column("value").to_pylist()
        _, parity, steps, _ = _structure(values)
        at, odd = (run.column("file")[0].as_py(), run.column("block")[0].as_py()), int(parity[-1])
        s = [int(steps[parity == p].sum()) for p in (0, 1)]
        if open_run is None or (open_run["file"], open_run["block"]) != at:
            if open_run is not None:
                yield pa.RecordBatch.from_pylist([open_run], schema=_SUMS_ARROW)
            open_run = {"file": at[0], "block": at[1], "size": run.column("size")[0].as_py(), "odd": 0, "s0": 0, "s1": 0, "bytes": 0}
        turned = open_run["odd"]
        open_run["s0"] += s[turned]
        open_run["s1"] += s[1 - turned]
        open_run["odd"] = turned ^ odd
        open_run["bytes"] += sum(map(len, values)) + len(values)
    if open_run is not None:
        yield pa.RecordBatch.from_pylist([open_run], schema=_SUMS_ARROW)


_SUMS = "file string, block long, size long, odd long, s0 long, s1 long, bytes long"
_SUMS_ARROW = pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("block", "size", "odd", "s0", "s1", "bytes"))])


def _starts(fragments: DataFrame) -> DataFrame:
    """Per split: whether it begins inside a string (``inside``), at which ``depth`` and at which byte (``at``).

    Quotes and depth of a split are summed for both cases; which one holds follows from the splits before.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    known = fragments.mapInArrow(_sums, _SUMS).withColumns({"inside": before("odd") % 2, "at": before("bytes")})
    known = known.withColumn("sum", F.when(F.col("inside") == 0, F.col("s0")).otherwise(F.col("s1")))
    return known.select(*_SPLIT, "inside", before("sum").alias("depth"), "at")


_PIECES = "file string, block long, place long, ends int, bytes long, text binary"
_PIECES_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("ends", pa.int32()), ("bytes", pa.int64()), ("text", pa.binary())])


def _pieces(level: int, max_bytes: int, inner: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts of a split up to each brace that ends a record: those of whole records (``inner``), or the first one and the open rest.

    A text of more than ``max_bytes`` is given up as soon as it is that long; of the edges, its length is kept.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, size, place, inside, depth, at = None, [], 0, 0, 0, 0, 0

        def piece(text: list[bytes], n: int, ends: int) -> tuple:
            return (*split, place, ends, n, b"".join(text) if n <= max_bytes else None)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECES_ARROW.types, strict=True)], schema=_PIECES_ARROW)

        for run in _runs(batches):
            rows = []
            here = (run.column("file")[0].as_py(), run.column("block")[0].as_py())
            if here != split:
                if size and not inner:
                    rows.append(piece(held, size, 0))
                split, held, size, place = here, [], 0, 0
                inside, depth, at = (run.column(c)[0].as_py() for c in ("inside", "depth", "at"))
            values = run.column("value").to_pylist()
            _, parity, steps, ends = _structure(values)
            outside = parity == inside
            deep = depth + np.cumsum(np.where(outside, steps, 0))
            closes = outside[ends] & (deep[ends] == level)
            inside, depth = inside ^ int(parity[-1]), int(deep[-1])
            at += sum(map(len, values)) + len(values)
            # The brace of a file's last fragment is missing if it would stand behind the file's end.
            missing = at > run.column("size")[0].as_py()
            if missing:
                closes[-1] = False
            begun = 0
            for end in np.flatnonzero(closes).tolist():
                text = b"}".join(values[begun : end + 1]) + b"}"
                begun, size = end + 1, size + len(text)
                if inner == (place > 0) and (size <= max_bytes or not inner):
                    rows.append(piece([*held, text], size, 1))
                held, size, place = [], 0, place + 1
            if begun < len(values):
                text = b"}".join(values[begun:]) + (b"" if missing else b"}")
                size += len(text) + missing
                held = [*held, text] if size <= max_bytes else []
            if rows:
                yield batch(rows)
        if size and not inner:
            yield batch([piece(held, size, 0)])

    return cut


def json_records(spark: SparkSession, path: str | list[str], level: int = 1, max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """Texts of all objects at a depth: ``file``, ``block``, ``place`` (in order within them) and ``text``, with what stands before the object.

    ``level`` is the number of brackets around a record: 1 in a file that
    holds an array or a map of records, 0 for records that follow each other.
    Objects of deeper levels belong to their record; scalars of an array are
    no records. An empty file has none.
    """
    fragments = _fragments(spark, path)
    placed = fragments.join(F.broadcast(_starts(fragments)), _SPLIT)
    # Inside a split, a record that isn't the first has begun there. The first one, and one without an end, may go on elsewhere.
    inner = placed.mapInArrow(_pieces(level, max_bytes, inner=True), _PIECES).select(*_SPLIT, "place", "text")
    edges = placed.mapInArrow(_pieces(level, max_bytes, inner=False), _PIECES)
    along = Window.partitionBy("file").orderBy("block", "place")
    chained = edges.withColumn("chain", F.coalesce(F.sum("ends").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = Window.partitionBy("file", "chain")
    chained = chained.withColumns({"all": F.sum("bytes").over(total), "done": F.max("ends").over(total)}).where((F.col("done") == 1) & (F.col("all") <= max_bytes))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", F.col("text").cast("string").alias("text")))), lambda p: p["text"]), "")
    crossing = chained.groupBy("file", "chain").agg(F.max(F.struct("block", "place")).alias("last"), joined.alias("text"))
    return inner.withColumn("text", F.col("text").cast("string")).unionByName(crossing.select("file", "last.block", "last.place", "text"))


#: What stands before the object of an array (brackets, commas, scalars) and before that of a map (also scalars with their keys).
_LEAD = r"^[^{]*"
_KEY = r'(?s)^.*?("(?:[^"\\]|\\.)*")\s*:\s*(?=\{)'


def _parsed(records: DataFrame, text: Column, schema: T.StructType, keep: list[str], keep_bad: bool) -> DataFrame:
    bad = T.StructField("_corrupt_record", T.StringType())
    read = F.from_json(text, T.StructType([*schema.fields, bad]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad.name})
    out = records.select(*keep, read.alias("_record"))
    if not keep_bad:
        return out.where("_record._corrupt_record is null").select(*keep, *(F.col("_record").getField(f.name).alias(f.name) for f in schema.fields))
    return out.select(*keep, "_record.*")


def split_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType, keep_bad: bool = False) -> DataFrame:
    """Records of files that hold one JSON array each, whole or cut off, read in splits; broken records are dropped, or kept in ``_corrupt_record``."""
    return _parsed(json_records(spark, path), F.regexp_replace("text", _LEAD, ""), schema, [], keep_bad)


def split_json_map(spark: SparkSession, path: str | list[str], schema: T.StructType, key: str = "key", keep_bad: bool = False) -> DataFrame:
    """Values of files that hold one JSON object of records each, with their keys, read in splits."""
    named = json_records(spark, path).withColumn(key, F.get(F.from_json(F.concat(F.lit("["), F.regexp_extract("text", _KEY, 1), F.lit("]")), "array<string>"), F.lit(0)))
    return _parsed(named, F.regexp_replace("text", _KEY, ""), schema, [key], keep_bad)
