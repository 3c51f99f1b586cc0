"""Language-model scoring with a log-bilinear neural model.

Counting: documents are dealt into groups; each group sends its distinct
words once, with their training counts, to hash buckets, which add them up
and send each group the totals of its words.

Model: words are symbols, the commonest ones each on their own and the rest
by a class of their ending; a word of a class has its smoothed share of it.
There are more symbols the larger the corpus. Symbol 0 is the end of a text,
and what stands before its start.
A symbol's logit is the product of its output vector with the sum of the
vectors of the two symbols before, plus a bias. Training is noise-contrastive
estimation by numpy in Spark tasks, each over its own share of all training
documents, with parameters averaged after each round. The softmax over all
symbols is exact: exp(a + b) = exp(a) exp(b), so the normalisers of all
pairs of contexts are one matrix product.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm import textnum as tn
from paceline.llm.spread import group_count, group_of, stored, text_bytes

#: Classes of word endings are this times the eighth root of the corpus's bytes, as a power of two: 256 at 0.5 GB, 1024 at 100 TB.
CLASS_FACTOR = 21
DIM, BATCH, NOISE, RATE, ROUNDS = 16, 4096, 64, 0.15, 2
#: Parameters in one piece of the model, and groups of tasks that add theirs up first.
PIECE, SUM_PARTS = 8192, 512
#: Documents whose crc32(id) has this remainder are held out of training.
MODULUS, HELD_OUT = 7, 2

_TAIL = np.zeros(256, bool)
_TAIL[list(b".,;:!?#*$%&|<>()\"'")] = True


def class_count(n_bytes: int) -> int:
    """Classes of the model of a corpus: a root of its size, so that the tables of all pairs of symbols stay below 70 MB each at 100 TB."""
    return 2 ** max(1, round(np.log2(CLASS_FACTOR * max(n_bytes, 1) ** 0.125)))


def word_count(classes: int) -> int:
    """Words that are symbols on their own; with symbol 0 and the classes there are four times as many symbols as classes."""
    return 3 * classes - 1


def held_out(ids: list[int | None]) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % MODULUS == HELD_OUT for i in ids], bool)


def ending_class(w: tn.Words, which: np.ndarray, n_classes: int) -> np.ndarray:
    """Class of words by their last three bytes before any closing punctuation, and whether there was any."""
    start, end = w.starts[which], w.ends[which].copy()
    bare = np.ones(len(end), np.uint64)
    for _ in range(4):
        cut = (end - start > 1) & _TAIL[w.data[end - 1]] if len(end) else np.zeros(0, bool)
        end[cut] -= 1
        bare[cut] = 2
    key = bare
    for k in range(1, 4):
        inside = end - k >= start
        byte = np.where(inside, tn._LOWER[w.data[np.maximum(end - k, 0)]], 0).astype(np.uint64) if len(end) else np.zeros(0, np.uint64)
        key = key * np.uint64(257) + byte
    return (tn.mix(key) % np.uint64(n_classes)).astype(np.int64)


@dataclass
class _Group:
    ids: list
    held: np.ndarray
    first: np.ndarray  # first word of each text, and the total
    which: np.ndarray  # distinct word of each word
    hashes: np.ndarray  # of distinct words
    classes: np.ndarray
    text: np.ndarray


def _group(table: pa.Table, n_classes: int) -> _Group:
    data, offsets = tn.text_buffers(table["text"])
    ids, hashes, classes, first, text = table["id"].to_pylist(), [], [], [np.zeros(1, np.int64)], []
    for a, b in tn.slices(offsets):
        w = tn.words(data, offsets[a : b + 1], lower=True)
        seen, _ = tn.first_of_each(w.hashes)
        hashes.append(w.hashes)
        classes.append((w.hashes[seen], ending_class(w, seen, n_classes)))
        first.append(first[-1][-1] + w.first[1:])
        text.append(a + w.text)
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    distinct, which = np.unique(every, return_inverse=True)
    of = np.zeros(len(distinct), np.int64)
    for h, c in classes:
        of[np.searchsorted(distinct, h)] = c
    return _Group(ids, held_out(ids), np.concatenate(first), which, distinct, of, np.concatenate(text) if text else np.zeros(0, np.int64))


def _count(buckets: int, n_classes: int):
    def run(table: pa.Table) -> pa.Table:
        g, grp = _group(table, n_classes), table["grp"][0].as_py()
        train = ~g.held
        n = np.bincount(g.which[train[g.text]], minlength=len(g.hashes))
        order, present, begin = tn.by_bucket(tn.bucket_of(g.hashes, buckets))
        out = {"bucket": [], "grp": [], "hashes": [], "counts": [], "classes": []}
        for k, a, b in zip(present.tolist(), begin[:-1], begin[1:], strict=True):
            mine = order[a:b]
            for c, v in zip(out, (k, grp, g.hashes[mine].tobytes(), n[mine].astype(np.uint32).tobytes(), g.classes[mine].astype(np.uint16).tobytes()), strict=True):
                out[c].append(v)
        return pa.table(out, schema=_COUNTS)

    return run


_COUNTS = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()), ("classes", pa.binary())])
_TOTALS = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("words", pa.binary()), ("sizes", pa.binary())])
TOTALS = "grp int, bucket int, counts binary, words binary, sizes binary"


def _total(n_classes: int):
    def run(table: pa.Table) -> pa.Table:
        """Totals of the words of a bucket for each group; a row without a group has its commonest words and its class sums."""
        hashes = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        every, n = np.concatenate(hashes), np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()])
        kind = np.concatenate([np.frombuffer(x, np.uint16) for x in table["classes"].to_pylist()])
        distinct, first, which = np.unique(every, return_index=True, return_inverse=True)
        total = np.zeros(len(distinct), np.uint64)
        np.add.at(total, which, n.astype(np.uint64))
        kind = kind[first]
        cuts = np.cumsum([0, *map(len, hashes)])
        counts = [total[which[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        known = total > 0
        sizes = np.stack([np.bincount(kind[known], weights=total[known], minlength=n_classes), np.bincount(kind[known], minlength=n_classes)])
        best = np.lexsort((distinct, -total.astype(np.int64)))[: word_count(n_classes)]
        best = best[total[best] > 0]
        words = np.stack([distinct[best], total[best], kind[best].astype(np.uint64)])
        bucket = table["bucket"][0].as_py()
        return pa.table({"grp": table["grp"].to_pylist() + [None], "bucket": table["bucket"].to_pylist() + [bucket], "counts": counts + [None], "words": [None] * len(counts) + [words.tobytes()], "sizes": [None] * len(counts) + [sizes.tobytes()]}, schema=_TOTALS)

    return run


@dataclass
class Vocabulary:
    """Symbols of the commonest words, sizes of the classes without them, and totals."""

    hashes: np.ndarray
    symbols: np.ndarray
    tokens: np.ndarray  # training tokens of each symbol
    within: np.ndarray  # log10 of the denominator of a word's share of its class; 0 for single words
    n_tokens: int
    n_words: int
    n_classes: int

    def of(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        by_class = 1 + word_count(self.n_classes) + classes
        if not len(self.hashes):
            return by_class
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbols[at], by_class)


def vocabulary(totals: DataFrame, n_texts: int, n_classes: int) -> Vocabulary:
    """From the bucket rows. Sums first tell the count that the commonest words reach, then only words that do are gathered."""
    n_single = word_count(n_classes)
    spoken = totals.where("grp is null").select("words", "sizes")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, s in zip(b["words"].to_pylist(), b["sizes"].to_pylist(), strict=True):
                tokens, types = np.frombuffer(s).reshape(2, -1)
                powers = np.bincount(np.frexp(np.frombuffer(x, np.uint64).reshape(3, -1)[1].astype(float))[1], minlength=65)
                yield pa.record_batch({"c": np.arange(n_classes + 65, dtype=np.int32), "n": np.append(tokens.astype(np.int64), powers), "v": np.append(types.astype(np.int64), np.zeros(65, np.int64))})

    found = spoken.mapInArrow(sums, "c int, n long, v long").groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    sizes, powers = [r for r in found if r["c"] < n_classes], {r["c"] - n_classes: r["n"] for r in found if r["c"] >= n_classes}
    # words of at least 2**(k - 1), the least k with enough of them
    cut = max((k for k in range(65) if sum(powers.get(j, 0) for j in range(k, 65)) >= n_single), default=0)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b["words"].to_pylist():
                h, n, c = np.frombuffer(x, np.uint64).reshape(3, -1)
                use = np.frexp(n.astype(float))[1] >= cut
                yield pa.record_batch({"h": h[use].view(np.int64), "c": c[use].astype(np.int32), "n": n[use].astype(np.int64)})

    top = spoken.mapInArrow(words, "h long, c int, n long").orderBy(F.desc("n"), "h").limit(n_single).collect()
    tokens, types = np.zeros(n_classes), np.zeros(n_classes)
    for r in sizes:
        tokens[r["c"]], types[r["c"]] = r["n"], r["v"]
    n_words, n_tokens = int(types.sum()) + (n_texts > 0), int(tokens.sum()) + n_texts
    for r in top:
        tokens[r["c"]] -= r["n"]
        types[r["c"]] -= 1
    h = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(h)
    each = np.concatenate([[n_texts], [r["n"] for r in top], np.zeros(n_single - len(top)), tokens])
    within = np.concatenate([np.zeros(1 + n_single), np.log10(tokens + types + 1)])
    return Vocabulary(h[order], 1 + order, each, within, n_tokens, n_words, n_classes)


@dataclass
class Model:
    context: np.ndarray  # 2, symbols, dim: vectors of the symbol one and two places before
    target: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.target, self.bias)])

    @staticmethod
    def of(flat: np.ndarray) -> Model:
        symbols = len(flat) // (3 * DIM + 1)
        a, b = 2 * symbols * DIM, 3 * symbols * DIM
        return Model(flat[:a].reshape(2, symbols, DIM).copy(), flat[a:b].reshape(symbols, DIM).copy(), flat[b:].copy())

    @staticmethod
    def start(tokens: np.ndarray) -> Model:
        """The unigram model: biases are log probabilities, vectors small noise."""
        rng = np.random.default_rng(3)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return Model(small(2, len(tokens), DIM), small(len(tokens), DIM), np.log(noise_of(tokens)).astype(np.float32))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Log10 logits of symbol given each one context, bias included in the first, and log10 normalisers of context pairs."""
        first = self.context[0].astype(np.float64) @ self.target.T + self.bias
        second = self.context[1].astype(np.float64) @ self.target.T
        top1, top2 = first.max(1, keepdims=True), second.max(1, keepdims=True)
        z = np.log(np.exp(first - top1) @ np.exp(second - top2).T) + top1 + top2.T
        return np.stack([first, second]) / np.log(10), z / np.log(10)


def noise_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens + 1) / (tokens + 1).sum()


def _add(into: np.ndarray, squares: np.ndarray, at: np.ndarray, grads: np.ndarray) -> None:
    """Adagrad step of the rows ``at``, each by the sum of its gradients."""
    order = np.argsort(at, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(at[order]) != 0))
    step = np.add.reduceat(grads[order], begin, axis=0)
    rows = at[order][begin]
    squares[rows] += (step * step).mean(axis=1)
    into[rows] += RATE * step / np.sqrt(squares[rows])[:, None]


def train_on(model: Model, squares: Model, symbols: np.ndarray, noise: np.ndarray, rng: np.random.Generator) -> None:
    """One pass of noise-contrastive estimation over contexts and targets (columns: two before, one before, target).

    The noise symbols are shared by a batch; biases stay at the unigram's log
    probabilities. ``squares`` holds Adagrad's sums, in the first column of
    each vector.
    """
    log_kp = np.log(noise * NOISE).astype(np.float32)
    cdf = np.cumsum(noise)
    for a in range(0, len(symbols), BATCH):
        two, one, w = symbols[a : a + BATCH].T
        r = model.context[0][one] + model.context[1][two]
        q = model.target[w]
        fake = np.minimum(np.searchsorted(cdf, rng.random(NOISE)), len(noise) - 1)
        good = 1 / (1 + np.exp(np.clip((r * q).sum(1) + model.bias[w] - log_kp[w], -30, 30)))
        bad = -1 / (1 + np.exp(-np.clip(r @ model.target[fake].T + model.bias[fake] - log_kp[fake], -30, 30)))
        grad_r = good[:, None] * q + bad @ model.target[fake]
        _add(model.target, squares.target[:, 0], np.concatenate([w, fake]), np.concatenate([good[:, None] * r, bad.T @ r]))
        _add(model.context[0], squares.context[0, :, 0], one, grad_r)
        _add(model.context[1], squares.context[1, :, 0], two, grad_r)


def _contexts(g: _Group, vocab: Vocabulary, texts: np.ndarray) -> np.ndarray:
    """Rows of (two before, one before, target) for the words of the marked texts and their ends."""
    sym = vocab.of(g.hashes, g.classes)[g.which]
    n = np.diff(g.first)
    starts = g.first[:-1] + np.arange(len(n)) * 3
    line = np.zeros(len(sym) + 3 * len(n), np.int64)  # two starts before each text and an end after it, all symbol 0
    line[np.arange(len(sym)) + 3 * g.text + 2] = sym
    owner = np.repeat(np.arange(len(n)), n + 3)
    use = np.ones(len(line), bool)
    use[starts] = use[starts + 1] = False
    at = np.flatnonzero(use & texts[owner])
    return np.stack([line[at - 2], line[at - 1], line[at]], axis=1)


def round_share(docs: DataFrame, k: int) -> DataFrame:
    """The documents of round k; each document is in exactly one round, rows with a null id by their text."""
    return docs.where(F.pmod(F.xxhash64("id", "text"), F.lit(ROUNDS)) == k)


_SUMS = "v binary, n double"


def _add_pieces(table: pa.Table) -> pa.Table:
    """Sums of the weighted parameters of one piece, and of their weights."""
    total = np.zeros(PIECE)
    for x in table["v"]:
        v = np.frombuffer(x.as_buffer())
        total = total[: len(v)] + v
    return pa.table({"at": table["at"][:1], "part": table["part"][:1], "v": pa.array([total.tobytes()], pa.binary()), "n": pa.array([sum(table["n"].to_pylist())])})


def _fit(spark_docs: DataFrame, vocab: Vocabulary) -> Model:
    """Rounds of local training in tasks, averaged by tokens; each round takes its share of the training texts."""
    spark = spark_docs.sparkSession
    flat, noise = Model.start(vocab.tokens).flat(), noise_of(vocab.tokens)
    width = len(flat)
    for k in range(ROUNDS):
        at = spark.sparkContext.broadcast((flat, noise, vocab))

        def local(batches: Iterator[pa.RecordBatch], at=at, k=k) -> Iterator[pa.RecordBatch]:
            flat, noise, vocab = at.value
            model, squares, seen, rng = Model.of(flat), Model.of(np.full_like(flat, 1e-2)), 0, np.random.default_rng(k)
            for b in batches:
                data, offsets = tn.text_buffers(b["text"])
                for lo, hi in tn.slices(offsets):
                    piece = pa.table({"id": b["id"].slice(lo, hi - lo), "text": b["text"].slice(lo, hi - lo)})
                    g = _group(piece, vocab.n_classes)
                    rows = _contexts(g, vocab, ~g.held)
                    train_on(model, squares, rows[rng.permutation(len(rows))], noise, rng)
                    seen += len(rows)
            if seen:
                total, part = model.flat().astype(np.float64) * seen, TaskContext.get().partitionId() % SUM_PARTS
                cells = [total[a : a + PIECE].tobytes() for a in range(0, width, PIECE)]
                yield pa.record_batch({"at": pa.array(range(len(cells)), pa.int32()), "part": pa.array([part] * len(cells), pa.int32()), "v": cells, "n": [float(seen)] * len(cells)})

        sums = round_share(spark_docs, k).select("id", "text").mapInArrow(local, f"at int, part int, {_SUMS}")
        for by in (("at", "part"), ("at",)):
            sums = sums.groupBy(*by).applyInArrow(_add_pieces, f"at int, part int, {_SUMS}")
        for r in sums.collect():  # the model's parameters in a few pieces
            flat[r["at"] * PIECE :][:PIECE] = np.frombuffer(r["v"]) / r["n"]
        at.unpersist()
    return Model.of(flat)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _score(shared, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return _RESULT.empty_table()
        vocab, logits, z = shared.value
        g = _group(left, vocab.n_classes)
        counts = np.zeros(len(g.hashes), np.int64)
        order, found, begin = tn.by_bucket(tn.bucket_of(g.hashes, buckets))
        said = dict(zip(right["bucket"].to_pylist(), right["counts"].to_pylist(), strict=True))
        for k, a, b in zip(found.tolist(), begin[:-1], begin[1:], strict=True):
            counts[order[a:b]] = np.frombuffer(said[k], np.uint64).astype(np.int64)
        n = len(g.ids)
        per_text = lambda x: np.bincount(g.text, weights=x, minlength=n)
        n_end = int(vocab.tokens[0])
        size = np.log10(vocab.n_tokens + vocab.n_words + 1)
        logc = np.log10(counts + 1.0)
        base = per_text((logc - size)[g.which]) + np.log10(n_end + 1) - size
        symbols = vocab.of(g.hashes, g.classes)
        share = np.where(symbols > word_count(vocab.n_classes), logc - vocab.within[symbols], 0.0)
        rows = _contexts(g, vocab, np.ones(n, bool))
        owner = np.repeat(np.arange(n), np.diff(g.first) + 1)
        lp = logits[0][rows[:, 1], rows[:, 2]] + logits[1][rows[:, 0], rows[:, 2]] - z[rows[:, 1], rows[:, 0]]
        score = np.bincount(owner, weights=lp, minlength=n) + per_text(share[g.which])
        tokens = np.diff(g.first) + 1
        known = per_text(counts[g.which] > 0).astype(np.int64) + (n_end > 0)
        return pa.table({"doc_id": pa.array(g.ids, pa.int64()), "held_out": g.held, "n_tokens": tokens, "n_known": known, "train_tokens": np.full(n, vocab.n_tokens), "base_score": base, "score": score}, schema=_RESULT)

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Unigram and log-bilinear log10 probabilities of every text.

    Returns one row per input row: doc_id, held_out, n_tokens (words and one
    end), n_known (those seen in training), train_tokens, base_score and
    score.

    Null and empty texts are one end token. Rows with a null id train like
    any other; repeated rows count as often as they stand. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n_bytes = text_bytes(docs)
    n, n_classes = group_count(docs, total=n_bytes), class_count(n_bytes)
    dealt = docs.select("id", "text", group_of("id", "text", n).alias("grp"))
    counts = dealt.groupBy("grp").applyInArrow(_count(n, n_classes), "bucket int, grp int, hashes binary, counts binary, classes binary")
    totals = stored(counts.groupBy("bucket").applyInArrow(_total(n_classes), TOTALS), "lm-totals")
    trains = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(MODULUS)) != HELD_OUT, F.lit(True))
    n_texts = docs.where(trains).count()
    vocab = vocabulary(totals, n_texts, n_classes)
    model = _fit(docs.where(trains), vocab)
    logits, z = model.tables()
    shared = spark.sparkContext.broadcast((vocab, logits.astype(np.float32), z.astype(np.float32)))
    replies = totals.where("grp is not null").select("grp", "bucket", "counts")
    return dealt.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(_score(shared, n), RESULT)
