"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

A document is its set of word n-grams. Documents with one set are one row of
the incidence matrix.

Blocks: with all n-grams in one global order, two sets that are similar
enough share an n-gram among the first n - ceil(t n) + 1 of each. The order
puts frequent n-grams last: those that a sketch of their counts over all
documents shows above its floor, and those whose words are so frequent that
as many n-grams of them are to be expected by chance. The sketch's floor rises
with the corpus and hides what is below it; the words' counts don't, as
a larger corpus has much the same words.
These deciding columns are dealt into buckets. The sets of a column of few
rows are paired where sizes and positions leave room for enough overlap; a
longer column, such as that of a group of copies, chains its sets by size at
one edge a row, so no column gives more than a fixed number of edges a row.
Pairs are held against a bound of their overlap from counts of their n-grams
by hash. What is left ties sets into the blocks of rows.

Product: a block's rows come to one task with all of their n-grams. A row's
product with the block accumulates its overlaps with all other rows over the
full incidence; pairs below the bound that the two sizes set are discarded.
Of the links only those that join two components are kept, and rows whose
component already holds all that is left need no product, so a block of
copies costs a few products. A block of more than ``block`` n-grams is cut
into parts: first the parts on their own, then one row of each component
found, then every row outside of a block's largest component with all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm import textnum as tn
from paceline.llm.components import connected_components
from paceline.llm.spread import discard, group_count, stored

#: Counters of the frequency sketch (4 bytes each), how many make one row, and groups of tasks that add theirs up first.
COUNTERS, BLOCK, SKETCH_PARTS = 1 << 20, 1 << 14, 512
#: Counters of the words' sketch, and steps that a word's rarity has to a power of two.
WORD_COUNTERS, STEPS = 1 << 18, 16
#: Blocks over which a frequent n-gram's column is split.
SALTS = 64
#: N-grams of a set to one count of those that share a hash, and least number of counts.
PER_COUNT, LEAST_COUNTS = 4, 32
#: Rows up to which the sets in blocks, and the blocks that are cut, are broadcast (some 32 bytes each).
MAX_BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Rule:
    """Two sets link when 100 * intersection >= percent * union of their ``size``-word n-grams.

    Columns of up to ``paired`` rows are paired, longer ones chained, and those of n-grams counted ``heavy`` times or
    more split; blocks of more than ``block`` n-grams are cut.
    """

    size: int = 5
    percent: int = 80
    heavy: int = 1 << 17
    block: int = 1 << 20
    paired: int = 256

    def least(self, n: np.ndarray) -> np.ndarray:
        """Smallest overlap of a set of n with any set that it links to."""
        return -(-self.percent * n // 100)

    def possible(self, n: np.ndarray, p: np.ndarray, m: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether sets of n and m n-grams that share one at places p and q can overlap enough."""
        need = -(-self.percent * (n + m) // (100 + self.percent))
        return (n - p >= need) & (m - q >= need) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * self.percent)

    def links(self, overlap: np.ndarray, n: int, m: np.ndarray) -> np.ndarray:
        return (overlap > 0) & (100 * overlap >= self.percent * (n + m - overlap))


def _spots(hashes: np.ndarray, counters: int) -> np.ndarray:
    """Counters of hashes."""
    return (hashes >> np.uint64(65 - counters.bit_length())).astype(np.int64)


def sets(w: tn.Words, rule: Rule, rarity: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and hash of each text's distinct n-grams, ordered by both, and the sum of their words' ``rarity``; a shorter text is one n-gram and the rarest."""
    at, grams = tn.windows(w, rule.size)
    text, n = w.text[at], w.counts
    rare = np.zeros(len(grams), np.int64)
    if rarity is not None:  # whole numbers, so that an n-gram has the same sum wherever it stands
        total = np.append(0, np.cumsum(rarity[_spots(w.hashes, WORD_COUNTERS)]))
        rare = total[at + rule.size] - total[at]
    short = np.flatnonzero((n > 0) & (n < rule.size))
    if len(short):
        lone = np.zeros(len(short), np.uint64)
        for k in range(rule.size - 1):
            more = n[short] > k
            word = w.hashes[np.minimum(w.first[:-1][short] + k, len(w.hashes) - 1)]
            lone = np.where(more, tn.mix(lone * np.uint64(31) + word + np.uint64(k)), lone)
        text, grams, rare = np.concatenate([text, short]), np.concatenate([grams, lone]), np.concatenate([rare, np.full(len(short), 1 << 20)])
    order = np.lexsort((grams, text))
    text, grams, rare = text[order], grams[order], rare[order]
    new = np.append(True, (np.diff(text) != 0) | (grams[1:] != grams[:-1]))[: len(text)]
    return text[new], grams[new], rare[new]


def _signatures(text: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and a 64-bit hash of each text's set."""
    size = np.bincount(text, minlength=n)
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(tn.mix(grams + np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    cuts = np.concatenate([[0], np.cumsum(size)])
    return size, tn.mix(total[cuts[1:]] - total[cuts[:-1]]).view(np.int64)


def _slices(column, rule: Rule) -> Iterator[tuple[int, int, tn.Words]]:
    data, offsets = tn.text_buffers(column)
    for lo, hi in tn.slices(offsets):
        yield lo, hi, tn.words(data, offsets[lo : hi + 1], lower=True)


def _count_hashes(text: np.ndarray, grams: np.ndarray, size: np.ndarray) -> list[bytes]:
    """For each text, counts (up to 255) of its n-grams by hash; the number of counts is a power of two that follows the size."""
    width = np.maximum(LEAST_COUNTS, 1 << np.ceil(np.log2(np.maximum(size, 1) / PER_COUNT)).clip(0).astype(np.int64))
    begin = np.append(0, np.cumsum(width))
    spot = begin[text] + (grams % width[text].astype(np.uint64)).astype(np.int64)
    counts = np.minimum(np.bincount(spot, minlength=begin[-1]), 255).astype(np.uint8).tobytes()
    return [counts[a:b] if n else b"" for a, b, n in zip(begin[:-1].tolist(), begin[1:].tolist(), size.tolist(), strict=True)]


def _most_overlap(a: bytes, b: bytes) -> int:
    """A bound of the overlap of two sets from their counts."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    if max(x.max(), y.max()) == 255:
        return 2**62
    width = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, width).sum(axis=0), y.reshape(-1, width).sum(axis=0)).sum())


_SCAN = "id long, n int, sig long, hashes binary, block int, part int, counts binary"


def _scan(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen, schema = np.zeros(COUNTERS, np.uint32), np.zeros(WORD_COUNTERS, np.uint32), pa.schema([("id", pa.int64()), ("n", pa.int32()), ("sig", pa.int64()), ("hashes", pa.binary()), ("block", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
        for b in batches:
            size, sig, hashes = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), []
            for lo, hi, w in _slices(b["text"], rule):
                text, grams, _ = sets(w, rule)
                size[lo:hi], sig[lo:hi] = _signatures(text, grams, hi - lo)
                hashes += _count_hashes(text, grams, size[lo:hi])
                sketch += np.bincount(_spots(grams, COUNTERS), minlength=COUNTERS).astype(np.uint32)
                seen += np.bincount(_spots(w.hashes, WORD_COUNTERS), minlength=WORD_COUNTERS).astype(np.uint32)
            nulls = [pa.nulls(b.num_rows, f.type) for f in schema][4:]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(size, pa.int32()), pa.array(sig), pa.array(hashes, pa.binary()), *nulls], schema=schema)
        sketch = np.append(sketch, seen)
        used = [k for k in range(-(-len(sketch) // BLOCK)) if sketch[k * BLOCK : (k + 1) * BLOCK].any()]
        part = [TaskContext.get().partitionId() % SKETCH_PARTS] * len(used)
        counts = [sketch[k * BLOCK : (k + 1) * BLOCK].astype(np.uint64).tobytes() for k in used]
        nulls = [pa.nulls(len(used), f.type) for f in schema][:4]
        yield pa.RecordBatch.from_arrays([*nulls, pa.array(used, pa.int32()), pa.array(part, pa.int32()), pa.array(counts, pa.binary())], schema=schema)

    return run


def _add_up(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, np.uint64)
    for x in table["counts"]:
        counts = np.frombuffer(x.as_buffer(), np.uint64)
        total[: len(counts)] += counts
    return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _frequencies(scan: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The sketches of n-grams (8 MB) and words over all documents, added up by groups of tasks and then over these."""
    partial = scan.where("block is not null").select("block", "part", "counts")
    grouped = partial.groupBy("block", "part").applyInArrow(_add_up, "block int, counts binary")
    out = np.zeros(-(-(COUNTERS + WORD_COUNTERS) // BLOCK) * BLOCK, np.uint64)
    for r in grouped.groupBy("block").applyInArrow(_add_up, "block int, counts binary").collect():
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], np.uint64)
    return out[:COUNTERS], out[COUNTERS : COUNTERS + WORD_COUNTERS]


@dataclass(frozen=True)
class Order:
    """The global order of n-grams, rare ones first: counts above the sketch's floor, by counter, and the rarity of words, in STEPS to a power of two."""

    above: np.ndarray
    rarity: np.ndarray
    base: int

    @classmethod
    def of(cls, grams: np.ndarray, words: np.ndarray) -> Order:
        """From both sketches. What most counters hold is the floor: n-grams that fell together by chance."""
        total = max(1, int(words.sum()))
        rarity = np.rint(STEPS * (np.log2(total) - np.log2(np.maximum(words, 1).astype(np.float64)))).astype(np.int64)
        return cls(grams.astype(np.int64) - int(np.median(grams)), rarity, int(STEPS * np.log2(total)))

    def levels(self, grams: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Powers of two of the n-grams' counts, as the sketch has them or as their words let expect, and the counts above the floor."""
        above = self.above[_spots(grams, COUNTERS)]
        counted = np.where(above > 0, np.frexp(np.maximum(above, 1).astype(np.float64))[1], np.iinfo(np.int64).min)
        return np.maximum(counted, (self.base - rare) // STEPS + 1), above


_PREFIX = "bucket int, heavy boolean, grams binary, sigs binary, sizes binary, places binary"


def _prefixes(rule: Rule, shared, buckets: int):
    """Each set's deciding n-grams with its size and their places in it, in blocks of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for b in batches:
            for lo, hi, w in _slices(b["text"], rule):
                text, grams, rare = sets(w, rule, ranks.rarity)
                size, sig = _signatures(text, grams, hi - lo)
                _, one = np.unique(sig, return_index=True)  # equal sets are one row
                only = np.zeros(hi - lo, bool)
                only[one] = True
                text, grams, rare = text[only[text]], grams[only[text]], rare[only[text]]
                level, seen = ranks.levels(grams, rare)
                order = np.lexsort((grams, level, text))
                text, grams, seen = text[order], grams[order], seen[order]
                first = np.searchsorted(text, np.arange(hi - lo))
                place = np.arange(len(text)) - first[text]
                use = place <= size[text] - rule.least(size[text])
                text, grams, place, heavy = text[use], grams[use], place[use], seen[use] >= rule.heavy
                deal = tn.mix(grams + np.where(heavy, sig[text].view(np.uint64) % np.uint64(SALTS), 0).astype(np.uint64))
                order, present, begin = tn.by_bucket(tn.bucket_of(deal, buckets) * 2 + heavy)
                cells = {c: [] for c in ("bucket", "heavy", "grams", "sigs", "sizes", "places")}
                for k, x, y in zip(present.tolist(), begin[:-1], begin[1:], strict=True):
                    mine = order[x:y]
                    for c, v in zip(cells, (k // 2, bool(k % 2), grams[mine].tobytes(), sig[text[mine]].tobytes(), size[text[mine]].astype(np.int32).tobytes(), place[mine].astype(np.int32).tobytes()), strict=True):
                        cells[c].append(v)
                yield pa.record_batch(cells, schema=pa.schema([("bucket", pa.int32()), ("heavy", pa.bool_()), *((c, pa.binary()) for c in ("grams", "sigs", "sizes", "places"))]))

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Indexes of edges that span the components of the graph on n nodes."""
    root, keep = list(range(n)), []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            keep.append(k)
    return np.array(keep, np.int64)


def _pairs_of(begin: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places inside runs of ``many`` places from ``begin``."""
    first = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    after = np.repeat(begin + many, many) - first - 1
    one = np.repeat(first, after)
    return one, one + 1 + np.arange(after.sum()) - np.repeat(np.cumsum(after) - after, after)


_EDGES = "gram long, paired boolean, a long, b long"


def _tied(rule: Rule):
    """Pairs of the short columns, chains of the long ones; a part of a split column also names the ends of its chains."""

    def run(table: pa.Table) -> pa.Table:
        read = lambda c, kind: [np.frombuffer(x.as_buffer(), kind) for x in table[c]]
        grams, sigs, sizes, places = read("grams", np.int64), read("sigs", np.int64), read("sizes", np.int32), read("places", np.int32)
        heavy = np.repeat(np.array(table["heavy"].to_pylist(), bool), [len(x) for x in grams])
        g, s, n, p = (np.concatenate(x) for x in (grams, sigs, sizes, places))
        n, p = n.astype(np.int64), p.astype(np.int64)
        order = np.lexsort((s, n, g))
        g, s, n, p, heavy = g[order], s[order], n[order], p[order], heavy[order]
        new = np.append(True, (np.diff(g) != 0) | (np.diff(s) != 0))
        g, s, n, p, heavy = g[new], s[new], n[new], p[new], heavy[new]
        begin = np.flatnonzero(np.append(True, np.diff(g) != 0))
        many = np.diff(np.append(begin, len(g)))
        names, at = np.unique(s, return_inverse=True)
        key = lambda x, y: np.unique(np.minimum(at[x], at[y]) * len(names) + np.maximum(at[x], at[y]))
        pairs = [np.zeros(0, np.int64)]
        short = np.flatnonzero((many > 1) & (many <= rule.paired) & ~heavy[begin])
        for cut in np.split(short, np.flatnonzero(np.diff(np.cumsum(many[short] * many[short]) >> 21)) + 1):
            x, y = _pairs_of(begin[cut], many[cut])
            ok = rule.possible(n[x], p[x], n[y], p[y])
            pairs.append(key(x[ok], y[ok]))
        pairs = np.unique(np.concatenate(pairs))
        long = np.repeat((many > rule.paired) | heavy[begin], many)
        x = np.flatnonzero(long[:-1] & (g[:-1] == g[1:]))
        x = x[n[x] * 100 >= n[x + 1] * rule.percent]
        chain = key(x, x + 1)
        chain = chain[_forest(chain // len(names), chain % len(names), len(names))]
        # where a split column's sizes leave a gap, each run between gaps has an end for the other parts
        ends = np.flatnonzero(heavy & np.append((g[1:] != g[:-1]) | (n[:-1] * 100 < n[1:] * rule.percent), True))
        both, alone = np.concatenate([pairs, chain]), len(ends)
        return pa.table({
            "gram": pa.array([None] * len(both) + g[ends].tolist(), pa.int64()),
            "paired": pa.array([True] * len(pairs) + [False] * (len(chain) + alone), pa.bool_()),
            "a": np.concatenate([names[both // len(names)], s[ends]]),
            "b": pa.array(names[both % len(names)].tolist() + [None] * alone, pa.int64()),
        })

    return run


def _bounded(rule: Rule):
    """Pairs whose counts leave room for enough overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = zip(b["hashes_a"], b["hashes_b"], b["n_a"].to_pylist(), b["n_b"].to_pylist(), strict=True)
            ok = [_most_overlap(x.as_buffer(), y.as_buffer()) * (100 + rule.percent) >= rule.percent * (n + m) for x, y, n, m in cells]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


class _Incidence:
    """Rows of n-grams with the columns that two or more of them share."""

    def __init__(self, grams: list[np.ndarray]):
        self.n = np.array([len(x) for x in grams], np.int64)
        owner, flat = np.repeat(np.arange(len(grams)), self.n), np.concatenate(grams)
        order = np.argsort(flat, kind="stable")
        run = np.append(True, flat[order][1:] != flat[order][:-1])
        column = np.cumsum(run) - 1
        many = np.bincount(column)
        use = many[column] > 1
        self.rows, columns = owner[order][use], (np.cumsum(many > 1) - 1)[column[use]]
        self.begin = np.append(0, np.cumsum(many[many > 1]))
        back = np.argsort(self.rows, kind="stable")
        self.columns = columns[back]
        self.first = np.searchsorted(self.rows[back], np.arange(len(grams) + 1))
        total = np.append(0, np.cumsum((self.begin[1:] - self.begin[:-1])[self.columns]))
        self.weight = total[self.first[1:]] - total[self.first[:-1]]  # entries that a row shares columns with

    def overlaps(self, row: int) -> np.ndarray:
        """Overlaps of one row with all rows: its product with the incidence matrix."""
        c = self.columns[self.first[row] : self.first[row + 1]]
        many = self.begin[c + 1] - self.begin[c]
        spots = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.begin[c], many)
        return np.bincount(self.rows[spots], minlength=len(self.n))


def _joined(rows: _Incidence, rule: Rule, comp: np.ndarray, ask: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """Links between components of the rows; only rows that ``ask`` are multiplied, by default as many as need be."""
    comp = comp.copy()
    open_ = np.ones(len(comp), bool) if ask is None else ask.copy()
    while True:
        left = np.flatnonzero(open_)
        if ask is None:
            # links of rows without a product are known unless their components differ; the largest one waits
            labels, count = np.unique(comp[left], return_counts=True)
            if len(labels) < 2:
                return
            left = left[comp[left] != labels[count.argmax()]] if count.max() > 1 else left
        elif not len(left):
            return
        row = int(left[rows.weight[left].argmax()])
        found = rule.links(rows.overlaps(row), int(rows.n[row]), rows.n) & (comp != comp[row])
        if ask is None:
            found &= open_
        others, first = np.unique(comp[found], return_index=True)
        for x in np.flatnonzero(found)[first].tolist():
            yield row, x
        comp[np.isin(comp, others)] = comp[row]
        open_[row] = False


def _product(rule: Rule):
    """Links of a block's clusters: rows that ask are multiplied with all rows, rows that can't ask (null) with each other."""

    def run(table: pa.Table) -> pa.Table:
        cluster, sig, comp = (table[c].to_numpy() for c in ("cluster", "sig", "comp"))
        alone, ask = table["ask"].is_null().to_numpy(), table["ask"].fill_null(False).to_numpy()
        order = np.lexsort((~ask, sig, cluster))
        order = order[np.append(True, (np.diff(cluster[order]) != 0) | (np.diff(sig[order]) != 0))]
        a, b = [], []
        for mine in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            if len(mine) > 1 and (alone[mine[0]] or ask[mine].any()):
                rows = _Incidence([np.frombuffer(table["grams"][int(k)].as_buffer(), np.uint64) for k in mine])
                for x, y in _joined(rows, rule, comp[mine], None if alone[mine[0]] else ask[mine]):
                    a.append(sig[mine[x]])
                    b.append(sig[mine[y]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _incidence_rows(rule: Rule):
    """The n-grams of each text whose set is the one it stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = b["sig"].to_numpy()
            for lo, hi, w in _slices(b["text"], rule):
                text, grams, _ = sets(w, rule)
                _, sig = _signatures(text, grams, hi - lo)
                cuts = np.searchsorted(text, np.arange(hi - lo + 1))
                same = np.flatnonzero(sig == want[lo:hi])
                cells = [grams[cuts[k] : cuts[k + 1]].tobytes() for k in same.tolist()]
                yield pa.RecordBatch.from_arrays([b["cluster"].take(pa.array(lo + same)), pa.array(sig[same]), pa.array(cells, pa.binary())], names=["cluster", "sig", "grams"])

    return run


def _small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it is small enough."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else df


def _links(clusters: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """a, b: links that span the components of the sets, given sets (sig, id, n, cluster) in clusters."""
    sums = clusters.groupBy("cluster").agg(F.sum("n").alias("mass"))
    wide = stored(sums.where(F.col("mass") > rule.block).select("cluster", F.ceil(F.col("mass") / rule.block).cast("int").alias("parts")), "ngram-wide")
    total = clusters.agg(F.sum("n")).first()[0] or 0
    buckets, any_wide = max(1, -(-total // rule.block)), not wide.isEmpty()
    grams = clusters.select(F.col("id").alias("of"), "sig", "cluster")
    texts = docs.where("id is not null").join(_small(grams), F.col("id") == F.col("of")).select("cluster", "sig", "text")
    rows = texts.mapInArrow(_incidence_rows(rule), "cluster long, sig long, grams binary")
    product = lambda df: stored(df.groupBy("block").applyInArrow(_product(rule), "a long, b long"), "ngram-links")
    alone = lambda df, block: df.select(block.alias("block"), "cluster", F.col("sig").alias("comp"), F.lit(None).cast("boolean").alias("ask"), "sig", "grams")
    bucket = F.pmod(F.xxhash64("cluster"), F.lit(buckets))
    if not any_wide:
        return product(alone(rows, bucket))
    rows = stored(rows.join(_small(wide), "cluster", "left").dropDuplicates(["sig"]), "ngram-rows")
    part = lambda seed, n: F.pmod(F.xxhash64("sig", F.lit(seed)), n)
    own = lambda *c: F.xxhash64("cluster", *c)
    links = product(alone(rows, F.when(F.col("parts").isNull(), bucket).otherwise(own(part(0, F.col("parts"))))))
    rows = rows.where("parts is not null")

    def labelled(links: DataFrame) -> DataFrame:
        parts = connected_components(links)
        return rows.join(parts.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("component", "sig")).drop("component")

    # one row of each component, that with the most links: parts of one group of copies meet here
    degree = links.select(F.col("a").alias("sig")).unionByName(links.select(F.col("b").alias("sig"))).groupBy("sig").agg(F.count(F.lit(1)).alias("degree"))
    chosen = labelled(links).drop("grams").join(degree, "sig", "left").groupBy("cluster", "comp").agg(F.max_by("sig", F.struct(F.coalesce("degree", F.lit(0)), "sig")).alias("sig"))
    heads = rows.join(chosen.select("sig"), "sig", "left_semi")
    room = heads.groupBy("cluster").agg(F.ceil(F.sum(F.octet_length("grams") / 8) / rule.block).cast("int").alias("room"))
    links = links.unionByName(product(alone(heads.join(_small(room), "cluster"), own(part(1, F.col("room"))))))
    # every row outside of its cluster's largest component with all rows of the cluster
    at = stored(labelled(links), "ngram-rows")
    largest = at.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("many")).groupBy("cluster").agg(F.max_by("comp", F.struct("many", "comp")).alias("largest"))
    asks = at.join(_small(largest), "cluster").where("comp <> largest")
    sides = asks.groupBy("cluster").agg(F.ceil(F.sum(F.octet_length("grams") / 8) / rule.block).cast("int").alias("sides"))
    asks, sides = asks.join(_small(sides), "cluster"), _small(sides)
    spread = lambda df, mine, others, asking: df.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1))).select(
        own(*((mine, F.col("other")) if asking else (F.col("other"), mine))).alias("block"), "cluster", "comp", F.lit(asking).alias("ask"), "sig", "grams")
    asking = spread(asks, part(2, F.col("sides")).cast("int"), F.col("parts"), True)
    asked = spread(at.join(sides, "cluster"), part(3, F.col("parts")).cast("int"), F.col("sides"), False)
    return links.unionByName(product(asking.unionByName(asked)))


def ngram_components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rule: Rule | None = None) -> DataFrame:
    """Set size and component of every document: doc_id, n_shingles, component_id.

    Two documents link when the Jaccard similarity of their sets of
    ``size``-word n-grams (words lower-cased in A-Z) is at least ``percent``;
    a component's id is its smallest doc_id. A text of fewer words is one
    n-gram; null texts and texts without words have none and link with
    nothing. Rows with a null id link with nothing and have no component;
    repeated rows are all returned. Other columns are ignored; an empty table
    gives an empty result.
    """
    rule, spark = rule or Rule(size, percent), docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scan = stored(docs.mapInArrow(_scan(rule), _SCAN), "ngram-scan")
    rows = scan.where("block is null").select("id", "n", "sig", "hashes")
    reps = stored(rows.where("n > 0 and id is not null").groupBy("sig").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("hashes").alias("hashes")), "ngram-sets")
    shared = spark.sparkContext.broadcast(Order.of(*_frequencies(scan)))
    columns = docs.where("id is not null").mapInArrow(_prefixes(rule, shared, group_count(docs)), _PREFIX)
    edges = stored(columns.groupBy("bucket").applyInArrow(_tied(rule), _EDGES), "ngram-edges")
    side = lambda k: reps.select(F.col("sig").alias(k), F.col("n").alias(f"n_{k}"), F.col("hashes").alias(f"hashes_{k}"))
    pairs = edges.where("paired").select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.select("a", "b", "n_a", "n_b", "hashes_a", "hashes_b").mapInArrow(_bounded(rule), "a long, b long")
    split = edges.where("gram is not null").select("gram", "a")
    heads = split.groupBy("gram").agg(F.min("a").alias("b"))
    chains = edges.where("gram is null and not paired").select("a", "b").unionByName(split.join(heads, "gram").select("a", "b"))
    clusters = connected_components(pairs.unionByName(chains))
    blocks = stored(reps.join(clusters, reps["sig"] == clusters["node"]).select("sig", "id", "n", F.col("component").alias("cluster")), "ngram-blocks")
    links = _links(blocks, docs, rule)
    as_ids = links.join(reps.select(F.col("sig").alias("a"), F.col("id").alias("x")), "a").join(reps.select(F.col("sig").alias("b"), F.col("id").alias("y")), "b").select("x", "y")
    parts = connected_components(as_ids)
    discard(edges, blocks)
    of_set = reps.join(parts, reps["id"] == parts["node"], "left").select(F.col("sig").alias("set"), F.coalesce("component", "id").alias("part"))
    rows = rows.drop("hashes")
    joined = rows.join(of_set, (rows["sig"] == of_set["set"]) & (rows["n"] > 0) & rows["id"].isNotNull(), "left")
    return joined.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("part", "id").alias("component_id"))
