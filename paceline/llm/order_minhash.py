"""Order MinHash fingerprints of texts, in DataFrame operations only.

A text's k-mers are windows of k tokens, each numbered by its occurrence, so
repeats count. Every component of a fingerprint takes the few k-mers that are
minimal under its own order of all numbered k-mers, puts them back in the
order of the text and hashes the tuple. Two fingerprints agree in a component
when the same k-mers were minimal and stand in the same order in both texts,
so rearranged texts, which share their k-mers, still differ.

The orders are rotations of one keyed order: component j starts at the j-th of
equally spaced anchors on the circle of hash values and takes the next few
k-mers. Each rotation is a min-wise order of its own, and one sort a text
serves all of them. Nothing is exploded: a text stays in its row.

Tokens are words cut into pieces of at most ``PIECE`` code points; ideographs,
kana and hangul syllables are tokens each. k-mers of single code points would
need a sort over every code point of the corpus, which interpreted array
functions don't reach within the limits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.lookup import heavy_limit
from paceline.llm.spread import stored

#: Tokens of a k-mer, k-mers of a tuple, tuples of a fingerprint (a power of two).
K, TUPLE, COMPONENTS = 5, 2, 64
PIECE = 16
_IDEOGRAPHS = r"\x{2E80}-\x{9FFF}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
TOKEN = rf"[{_IDEOGRAPHS}]|[^\x20\x09-\x0D{_IDEOGRAPHS}]{{1,{PIECE}}}"
#: A hashed k-mer and its place share a long: 33 bits of the hash order it, 30 bits are the place, and no string has more tokens.
PLACE = (1 << 30) - 1
#: Documents that stand in one block on average, in order of their ids.
BLOCK = 64
COPIES = 64


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, and only where the result is needed."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _high(h: Column, place: Column) -> Column:
    return h.bitwiseAND(F.lit(~PLACE)).bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(PLACE)).cast("int")


def _upto(n: Column) -> Column:
    return F.sequence(F.lit(0), n - 1)


def _numbered(kmers: Column, n: Column) -> Column:
    """Hashes of (k-mer, occurrence number) with the k-mer's place, in any order."""
    plain = F.transform(kmers, lambda x, i: _high(F.xxhash64(x, F.lit(0)), i))

    def counted(p: Column) -> Column:
        same = lambda i: F.get(p, i).bitwiseOR(F.lit(PLACE)) == F.get(p, i - 1).bitwiseOR(F.lit(PLACE))
        starts = F.filter(_upto(n), lambda i: (i == 0) | ~same(i))
        lengths = _let(starts, lambda s: F.transform(s, lambda at, r: F.coalesce(F.get(s, r + 1), n) - at))
        occurrence = F.flatten(F.transform(lengths, _upto))
        return _let(occurrence, lambda o: F.transform(p, lambda x, i: _high(F.xxhash64(F.get(kmers, _place(x)), F.get(o, i)), _place(x))))

    repeated = F.size(F.array_distinct(kmers)) < n
    return F.when(repeated, _let(F.sort_array(F.transform(kmers, _high)), counted)).otherwise(plain)


def fingerprinted(df: DataFrame, text: Column, out: str, k: int = K, per_tuple: int = TUPLE, components: int = COMPONENTS) -> DataFrame:
    """Add ``out``, the fingerprint of ``text`` (null: empty) as an array of 32-bit integers, empty for a text without tokens."""
    bits = components.bit_length() - 1
    if components != 1 << bits:
        raise ValueError("components must be a power of two")
    bin_of = lambda x: F.shiftright(x, 64 - bits) + components // 2
    keep = [F.col(f"`{c}`") for c in df.columns]
    step = df.select(*keep, F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w)).alias("_words"))
    n = F.size("_words")
    window = lambda i: F.xxhash64(*(F.get(F.col("_words"), i + j) for j in range(k)))
    short = F.array(F.aggregate("_words", F.lit(42).cast("long"), lambda h, x: F.xxhash64(h, x)))
    kmers = F.when(n == 0, F.array().cast("array<bigint>")).when(n < k, short).otherwise(F.transform(_upto(n - k + 1), window))
    step = step.select(*keep, kmers.alias("_kmers"))
    n = F.size("_kmers")
    step = step.select(*keep, "_kmers", F.when(n > 0, F.sort_array(_numbered(F.col("_kmers"), n))).alias("_sorted"))
    at = lambda i: F.get(F.col("_sorted"), i)
    firsts = F.filter(_upto(n), lambda i: (i == 0) | (bin_of(at(i)) != bin_of(at(i - 1))))
    start = F.struct(F.array().cast("array<int>").alias("of"), F.lit(0).cast("long").alias("next"))

    def reach(acc: Column, i: Column) -> Column:
        own = bin_of(at(i))
        return F.struct(F.concat(acc["of"], F.array_repeat(i, (own - acc["next"] + 1).cast("int"))).alias("of"), (own + 1).alias("next"))

    anchors = F.aggregate(firsts, start, reach, lambda acc: F.concat(acc["of"], F.array_repeat(F.lit(0), (F.lit(components) - acc["next"]).cast("int"))))
    step = step.select(*keep, "_kmers", "_sorted", F.when(n > 0, anchors).alias("_anchors"))

    def tuple_hash(i: Column) -> Column:
        taken = F.sort_array(F.transform(_upto(F.least(F.lit(per_tuple), n)), lambda t: _place(at((i + t) % n))))
        return F.aggregate(taken, F.lit(42).cast("long"), lambda h, p: F.xxhash64(h, F.get(F.col("_kmers"), p)), lambda h: F.shiftright(h, 32).cast("int"))

    return step.select(*keep, F.when(n > 0, F.transform("_anchors", tuple_hash)).otherwise(F.array().cast("array<int>")).alias(out))


def as_text(fingerprint: Column) -> Column:
    """A fingerprint in lowercase hex, eight digits a component."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of components that agree; 1 for two texts without tokens, 0 if only one has none."""
    agree = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(agree / F.size(a))


def with_next(rows: DataFrame, id_col: str, text_col: str, derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add ``next_<column>`` of the row that follows by id, then by SHA-256 of the text; after the last comes the first.

    The columns are the text and those that ``derive`` adds to the rows. Rows
    stand in blocks of neighbouring ids, so one shuffle brings neighbours
    together and a window leads within a block. Only the last row of a block
    looks up the first of the next one; of these first rows, one a block,
    ``derive`` computes its columns a second time. A block with far more rows
    than its share (equal ids, null ids, clustered ids) is split by id, text
    and, for equal rows, by a number of copies.
    """
    ident, sha = F.col(id_col).cast("long"), F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    span = rows.agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("least"), F.max(ident).alias("most")).first()
    n, width = span["n"], BLOCK
    if span["least"] is not None:
        width = max(BLOCK, BLOCK * (span["most"] - span["least"]) // n)
    block = (F.floor(ident / F.lit(width)) if width < 1 << 40 else F.floor(ident.cast("decimal(38,0)") / F.lit(width))).cast("long")
    heavy = [r["block"] for r in rows.groupBy(block.alias("block")).count().where(F.col("count") > max(4 * BLOCK, heavy_limit(rows, n))).select("block").collect()]
    parts = [block.alias("block")]
    if heavy:
        fine = F.coalesce(block.isin([b for b in heavy if b is not None]), F.lit(None in heavy))
        parts += [F.when(fine, x).alias(c) for c, x in (("fine_id", ident), ("fine_sha", sha), ("fine_copy", F.pmod(F.monotonically_increasing_id(), F.lit(COPIES))))]
    dealt = rows.withColumn("_block", F.struct(*parts)).withColumn("_sha", sha)
    blocks = stored(dealt.select("_block").distinct().repartitionByRange("_block").withColumn("pid", F.spark_partition_id()), "blocks")
    edges = blocks.groupBy("pid").agg(F.min("_block").alias("least")).withColumn("after", F.lead("least").over(Window.orderBy("pid")))
    first = F.first("least").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edges = edges.select("pid", F.coalesce("after", first).alias("after"))
    follows = blocks.join(F.broadcast(edges), "pid").select("_block", F.coalesce(F.lead("_block").over(Window.partitionBy("pid").orderBy("_block")), "after").alias("after"))
    order = Window.partitionBy("_block").orderBy(F.col(id_col).asc_nulls_first(), "_sha")
    begins = derive(dealt.withColumn("_at", F.row_number().over(order)).where("_at = 1").drop("_at"))
    columns = [text_col, *(c for c in begins.columns if c not in dealt.columns)]
    begins = begins.select(F.col("_block").alias("after"), *(F.col(c).alias(f"first_{c}") for c in columns))
    led = derive(dealt).withColumns({f"next_{c}": F.lead(c).over(order) for c in columns} | {"_ends": F.lead(F.lit(1)).over(order).isNull()})
    given = follows.join(begins, "after").drop("after").withColumnRenamed("_block", "of")
    # The window has dealt and sorted the rows by block, so this join moves only the first rows.
    found = led.join(given, (F.col("_block") == F.col("of")) & F.col("_ends"), "left")
    return found.select(*(c for c in rows.columns if c not in columns), *columns, *(F.when(F.col("_ends"), F.col(f"first_{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in columns))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last half replaced by the beginning of the next
    document's. Returns ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``, one row for each row of the input.

    A null text is empty; empty and blank texts have the empty fingerprint.
    Documents follow by id, null ids first, equal ids by SHA-256 of the text;
    of equal rows each but the last is followed by its own copy. A single
    document is followed by itself. An empty table gives an empty result;
    other columns aren't read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", "text", lambda df: fingerprinted(df, F.col("text"), "marks"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "marks", "next_marks")
    out = fingerprinted(rows, F.col("edited"), "edited_marks")
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_text(F.col("marks")).alias("fingerprint"), as_text(F.col("edited_marks")).alias("edited_fingerprint"), likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"), likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))
