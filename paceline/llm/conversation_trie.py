"""Prefix trie of conversations that share their first turns, one row a node.

Every conversation is rebuilt from the head of another one and its own tail.
A node is a sequence of turns that some rebuilt conversation starts with; its
smallest member owns it. Whoever owns a node owns the rest of its own path, so
a conversation owns a suffix of it, and all its figures follow from where that
suffix starts. Windows mark the owned nodes, then one grouping by prefix sums
what members hold below the prefix, less what they own of it, and the flags
of leaves and children.

No task needs a whole conversation or all members of a node. Turns are dealt
by ranges of (conversation, turn), so a long one spans several partitions and
its running sums and prefix hashes continue by the totals of the partitions
before; at most one conversation crosses each boundary, which bounds the table
of totals by the number of partitions. The window that marks owned nodes keeps
one row a node and task before it shuffles. Prefixes are told apart by two
64-bit hashes: exclusive ors over the hashes of (depth, role, text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.lookup import looked_up
from paceline.llm.spread import discard, stored

#: The longest head that a conversation takes from another.
HEAD = 8
FAMILY = 5
#: Ids that the list of a node's ends is packed in before it is hashed.
_CHUNK = 512
KEY = ["depth", "a", "b"]


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(HEAD + 1))


def slim_turns(conversations: DataFrame) -> DataFrame:
    """Turns without their texts: hashes and length; equal turn numbers are told apart by role and SHA-256 of the text."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    sha = F.unhex(F.sha2(text.cast("binary"), 256))
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), sha.alias("sha"), F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("row")]


def rebuilt(slim: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations in parts: -1 marks the conversation, 0 is the head from elsewhere, 1 all its own turns."""
    place = F.row_number().over(Window.partitionBy("conv").orderBy(*_order()))
    heads = slim.withColumn("i", place).where(F.col("i") <= HEAD)
    convs = heads.where("i = 1").select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), head_turns(F.col("conv")).alias("h"))
    given = heads.select(F.col("conv").alias("base"), "i", "role", "sha", "bytes")
    part0 = convs.join(given, "base").where("i <= h").select("conv", F.lit(0).alias("part"), F.col("i").cast("long").alias("turn"), "role", "sha", "bytes", F.lit(0).cast("long").alias("row"))
    marks = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("sha"), F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("row"))
    own = slim.select("conv", F.lit(1).alias("part"), "turn", "role", "sha", "bytes", "row")
    return marks.unionByName(part0).unionByName(own)


def _carried(df: DataFrame, sums: dict[str, Column], before: dict[str, Column]) -> DataFrame:
    """Add to each row what the earlier partitions hold of its conversation: ``before`` by the names of ``sums``.

    Only conversations that cross a partition's boundary have such rows, at most one a boundary, so the broadcast is bounded.
    """
    per = df.groupBy("conv", "pid").agg(*(c.alias(k) for k, c in sums.items()))
    w = Window.partitionBy("conv").orderBy("pid")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    crossing = per.withColumn("spans", F.count(F.lit(1)).over(Window.partitionBy("conv"))).where("spans > 1")
    carry = crossing.select("conv", "pid", *(c.over(earlier if k.startswith("before") else Window.partitionBy("conv")).alias(k) for k, c in before.items()))
    return df.join(F.broadcast(carry), ["conv", "pid"], "left")


def occurrences(conversations: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation: ``conv``, ``depth``, hashes ``a`` and ``b``, those of the parent, ``below`` (bytes from this turn on), ``length`` and ``pid``."""
    slim = stored(slim_turns(conversations), "trie-slim")
    order = [F.col("conv"), F.col("part"), *_order()]
    turns = stored(rebuilt(slim).repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "trie-turns")
    local = Window.partitionBy("pid", "conv").orderBy("part", *_order())
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = {"heads": F.sum((F.col("part") == 0).cast("long")), "owns": F.sum((F.col("part") == 1).cast("long"))}
    placed = _carried(turns, counts, {"before_heads": F.sum("heads"), "before_owns": F.sum("owns")})
    heads = F.coalesce("before_heads", F.lit(0)) + F.sum((F.col("part") == 0).cast("long")).over(running)
    own = F.coalesce("before_owns", F.lit(0)) + F.sum((F.col("part") == 1).cast("long")).over(running)
    h = head_turns(F.col("conv"))
    kept = placed.withColumns({"heads": heads, "own": own}).where((F.col("part") < 1) | (F.col("own") > h))
    depth = F.when(F.col("part") < 0, F.lit(0)).when(F.col("part") == 0, F.col("heads")).otherwise(F.col("heads") + F.col("own") - h).cast("long")
    hashed = kept.select("conv", "pid", depth.alias("depth"), "role", "sha", "bytes")
    mark = F.col("depth") > 0
    hashed = hashed.select("conv", "pid", "depth", "bytes", F.when(mark, F.xxhash64("depth", "role", "sha")).otherwise(F.lit(0)).alias("x"), F.when(mark, F.xxhash64("sha", "role", "depth")).otherwise(F.lit(0)).alias("y"))
    hashed = stored(hashed, "trie-hashed")
    sums = {"x_sum": F.bit_xor("x"), "y_sum": F.bit_xor("y"), "byte_sum": F.sum("bytes"), "last": F.max("depth")}
    before = {"before_x": F.bit_xor("x_sum"), "before_y": F.bit_xor("y_sum"), "before_bytes": F.sum("byte_sum"), "all_bytes": F.sum("byte_sum"), "all_last": F.max("last")}
    along = Window.partitionBy("pid", "conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("pid", "conv")
    zero = F.lit(0).cast("long")
    a, b = (F.coalesce(f"before_{c}", zero).bitwiseXOR(F.bit_xor(c).over(along)) for c in "xy")
    total = F.coalesce("all_bytes", F.sum("bytes").over(whole))
    done = F.coalesce("before_bytes", zero) + F.sum("bytes").over(along) - F.col("bytes")
    out = _carried(hashed, sums, before).select("conv", "pid", "depth", "x", "y", a.alias("a"), b.alias("b"), (total - done).alias("below"), F.coalesce("all_last", F.max("depth").over(whole)).alias("length"))
    out = stored(out.select("conv", "pid", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"), "below", "length"), "trie-prefixes")
    discard(slim, turns, hashed)
    return out


def ownership(prefixes: DataFrame) -> DataFrame:
    """Per conversation that owns a node: ``first_own`` depth, ``own_bytes`` from there on, ``above`` (owner of the node above it) and ``leaf`` (its last node has no child)."""
    first = F.row_number().over(Window.partitionBy(*KEY).orderBy("conv"))
    owned = stored(prefixes.withColumn("at", first).where("at = 1").select("conv", *KEY, "pa", "pb", "below"), "trie-owned")
    mine = owned.groupBy("conv").agg(F.min(F.struct("depth", "pa", "pb", "below")).alias("top"), F.max(F.struct(*KEY)).alias("end"))
    mine = stored(mine.select("conv", F.col("top.depth").alias("first_own"), F.col("top.below").alias("own_bytes"), F.struct((F.col("top.depth") - 1).alias("depth"), F.col("top.pa").alias("a"), F.col("top.pb").alias("b")).alias("up"), "end"), "trie-mine")
    roots, hung = mine.where("first_own = 0"), mine.where("first_own > 0")
    parents = hung.groupBy("up").agg(F.count(F.lit(1)).alias("n"))
    owners = owned.select(F.struct(*KEY).alias("up"), F.col("conv").alias("above")).join(parents, "up")
    hung = looked_up(hung, owners, ["up"], "n", hung.count())
    mine = roots.withColumn("above", F.lit(None).cast("long")).unionByName(hung)
    leaves = mine.select("conv", "end").join(parents.select(F.col("up").alias("end")), "end", "left_anti").select("conv", F.lit(1).alias("leaf"))
    return mine.join(leaves, "conv", "left").select("conv", "first_own", "own_bytes", "above", F.coalesce("leaf", F.lit(0)).alias("leaf"))


def ends_digest(prefixes: DataFrame) -> DataFrame:
    """``KEY`` and ``ends_sha256``: the hash of the ascending, comma-joined ids of the conversations that end at a node.

    Ids are packed in chunks of a range-sorted table; then each node's chunks
    are streamed in order through one hash, with constant memory. A hash reads
    its bytes one after the other, so this last pass is one task a node.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([np.asarray(batch.column(i)) for i in range(3)])
            ids = np.asarray(batch.column(3))
            new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            cuts = [(at, min(at + _CHUNK, to)) for begin, to in zip(new, np.append(new[1:], len(ids)), strict=True) for at in range(begin, to, _CHUNK)]
            starts = [at for at, _ in cuts]
            text = [",".join(map(str, ids[at:to].tolist())) for at, to in cuts]
            yield pa.record_batch([*(pa.array(keys[starts, i]) for i in range(3)), pa.array(ids[starts]), pa.array(text, pa.string())], [*KEY, "first_id", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if key != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.record_batch([pa.array([r[i] for r in out], kind) for i, kind in enumerate([pa.int64()] * 3 + [pa.string()])], [*KEY, "ends_sha256"])
        if now is not None:
            yield pa.record_batch([pa.array([x], kind) for x, kind in zip((*now, state.hexdigest()), [pa.int64()] * 3 + [pa.string()], strict=True)], [*KEY, "ends_sha256"])

    ends = prefixes.where("depth = length").select(*KEY, "conv")
    sorted_ends = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    chunks = sorted_ends.mapInArrow(pack, "depth long, a long, b long, first_id long, ids string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first_id").mapInArrow(digest, "depth long, a long, b long, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row a node of the trie of rebuilt conversations.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``. Turns
    are ordered by number, null first; equal numbers by role and SHA-256 of
    the text, and repeated rows are turns of their own. A null role or text is
    empty. Rows without a ``conv_id`` belong to no conversation and are left
    out; other columns aren't read. An empty table has no node, not even a
    root. The first of c's family is c - c % 5, with the sign of c.

    Returns ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``.
    """
    prefixes = occurrences(conversations)
    mine = ownership(prefixes)
    # Of a conversation that spans partitions each gets its own copy of the row, so no key has more rows than a partition.
    dealt = prefixes.select("conv", "pid").distinct().join(mine, "conv", "left")
    seen = prefixes.join(dealt, ["conv", "pid"])
    own = F.col("first_own")
    left_over = F.greatest(F.lit(0), F.col("below") - F.coalesce("own_bytes", F.lit(0)))
    nodes = seen.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.max(F.when(own == F.col("depth"), F.col("above"))).alias("above"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(((own <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))).cast("long")).alias("n_children"),
        F.sum(F.coalesce("leaf", F.lit(0)).cast("long")).alias("n_leaves"),
        F.sum(left_over).alias("saved_tokens"),
    )
    named = nodes.join(ends_digest(prefixes), KEY, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("above", "conv_id"))
    figures = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    return named.select("conv_id", "depth", parent.alias("parent_conv_id"), *figures, F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
