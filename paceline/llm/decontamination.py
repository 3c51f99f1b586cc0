"""Benchmark decontamination by latent semantic retrieval.

Passages are word windows of the documents and count the benchmark's words,
whose number bounds every matrix. One pass over all passages adds up their
document frequencies; words too frequent to tell passages apart are no
features. A second adds up the sketch A'A R of a randomised SVD of the TF-IDF
matrix A, which a small eigenvalue problem on the driver turns into a latent
basis. A third projects overlapping passages at scales that fit the items,
takes those whose cosine with an item is high enough as candidates, and
verifies these by the longest common subsequence with the item and with its
answer. Only pairs that hold enough of an item's rarer words for that
subsequence are projected, which loses none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.llm import textnum as tn

RANK, OVERSAMPLE = 96, 16
#: Cosine from which a passage is a candidate, and shares of an item and of its answer that a leak has in order.
MIN_COSINE, MIN_ITEM, MIN_ANSWER = 0.15, 0.6, 0.5
#: A feature stands in at most this share of passages, or is in this rarer part of some item's words.
MAX_SHARE, FEATURE_PART = 0.005, 0.4
#: Part of an item's words, rarest first, that decides which pairs can hold a long enough subsequence; over 1 - MIN_ITEM.
RARE_PART = 0.6
#: Passage lengths in words, doubled on until the last fits the longest item; an item is searched at the shortest of at least 1.5 times its own length.
SCALES = (24, 48, 96, 192, 384)
#: The benchmark is a stated query set; the driver and each task hold it whole with RANK + OVERSAMPLE numbers a word, so its size is checked.
MAX_BENCHMARK_BYTES = 4_000_000
#: Numbers in one piece of a summed vector, and groups of tasks that add theirs up first.
PIECE, SUM_PARTS = 1 << 14, 512
#: Candidate passages projected at once.
STEP = 1 << 15


@dataclass
class Benchmark:
    ids: list[int]
    words: list[list[int]]  # word numbers of each item
    answers: list[tuple[int, int]]  # span of each item's answer
    scales: tuple[int, ...]  # passage lengths
    scale: np.ndarray  # of each item
    vocabulary: np.ndarray  # sorted hashes of all words of all items

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words outside the vocabulary."""
        out = np.full(len(hashes), -1)
        if len(self.vocabulary):
            table = np.zeros(1 << 16, bool)
            table[self.vocabulary >> np.uint64(48)] = True
            maybe = np.flatnonzero(table[hashes >> np.uint64(48)])
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            same = self.vocabulary[at] == hashes[maybe]
            out[maybe[same]] = at[same]
        return out


def scales_for(longest: int) -> tuple[int, ...]:
    """Passage lengths for a benchmark whose longest item has so many words."""
    out = list(SCALES)
    while out[-1] < 1.5 * longest:
        out.append(2 * out[-1])
    return tuple(out)


def _read(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None) -> Benchmark:
    size = benchmark.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes; search it in parts of at most {MAX_BENCHMARK_BYTES}")
    rows = [r for r in benchmark.orderBy(id_col, text_col).collect() if r[text_col] and r[id_col] is not None]
    texts, spans = [], []
    for r in rows:
        body, answer = r[text_col], (r[answer_col] or "") if answer_col else ""
        n, m = len(body.encode().split()), len(answer.encode().split())
        texts.append(f"{body} {answer}" if m else body)
        spans.append((n, n + m) if m else (n - max(1, n // 4), n))  # without an answer column the last quarter counts as the answer
    keep = [i for i, t in enumerate(texts) if t.encode().split()]
    texts, spans, rows = [texts[i] for i in keep], [spans[i] for i in keep], [rows[i] for i in keep]
    data, offsets = tn.text_buffers(pa.array(texts, pa.string()))
    w = tn.words(data, offsets, lower=True)
    vocabulary = np.unique(w.hashes)
    numbers = np.searchsorted(vocabulary, w.hashes)
    words = [numbers[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    scales = scales_for(max(map(len, words), default=0))
    scale = np.searchsorted(scales, [1.5 * len(x) for x in words])
    return Benchmark([r[id_col] for r in rows], words, spans, scales, scale, vocabulary)


def _passages(w: tn.Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (word indexes) of passages that overlap by two thirds and cover each text to its end, and their number per text."""
    stride, n = length // 3, w.counts
    per = np.where(n > 0, np.maximum(0, -(-(n - length) // stride)) + 1, 0)
    text = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    start = w.first[:-1][text] + k * stride
    return start, np.minimum(start + length, w.first[1:][text]), per


def _cells(bench: Benchmark, column, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of side-by-side passages of ``length`` words: their number, and the passage and word number of each known word."""
    data, offsets = tn.text_buffers(column)
    for lo, hi in tn.slices(offsets):
        w = tn.words(data, offsets[lo : hi + 1], lower=True)
        if len(w.starts):
            at = bench.numbers(w.hashes)
            passage = np.cumsum((np.arange(len(at)) - w.first[:-1][w.text]) % length == 0) - 1
            known = np.flatnonzero(at >= 0)
            yield int(passage[-1]) + 1, passage[known], at[known]


_SUMS = "at int, part int, v binary"


def _add_pieces(table: pa.Table) -> pa.Table:
    """The sum of a piece of the vector over tasks."""
    total = 0.0
    for x in table["v"]:
        total = total + np.frombuffer(x.as_buffer())
    return pa.table({"at": table["at"][:1], "part": table["part"][:1], "v": pa.array([total.tobytes()], pa.binary())})


def _summed(docs: DataFrame, width: int, add) -> np.ndarray:
    """Sum over all tasks of the vector that ``add`` fills from a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            add(b["text"], total)
        part = TaskContext.get().partitionId() % SUM_PARTS
        used = [k for k in range(0, width, PIECE) if total[k : k + PIECE].any()]
        yield pa.record_batch({"at": pa.array(used, pa.int32()), "part": pa.array([part] * len(used), pa.int32()), "v": pa.array([total[k : k + PIECE].tobytes() for k in used], pa.binary())})

    sums = docs.mapInArrow(run, _SUMS)
    for by in (("at", "part"), ("at",)):
        sums = sums.groupBy(*by).applyInArrow(_add_pieces, _SUMS)
    out = np.zeros(width)
    for r in sums.collect():  # the vector in a few pieces
        out[r["at"] :][:PIECE] = np.frombuffer(r["v"])
    return out


def _frequencies(docs: DataFrame, bench: Benchmark, length: int) -> tuple[np.ndarray, int]:
    n = len(bench.vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(bench)

    def add(column, total: np.ndarray) -> None:
        for passages, row, word in _cells(shared.value, column, length):
            total[:n] += np.bincount(np.unique(row * n + word) % max(n, 1), minlength=n)
            total[n] += passages

    out = _summed(docs, n + 1, add)
    return out[:n], int(out[n])


def _features(bench: Benchmark, df: np.ndarray, passages: int) -> np.ndarray:
    """Which words of the vocabulary are features."""
    keep = df <= MAX_SHARE * passages
    for x in bench.words:
        rare = np.unique(x)
        keep[rare[np.argsort(df[rare], kind="stable")][: int(np.ceil(FEATURE_PART * len(rare)))]] = True
    return keep


def _sketch(docs: DataFrame, bench: Benchmark, weights: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The test matrix R and A'A R, where A has the weighted counts of features in passages."""
    n = len(weights)
    rank = min(RANK + OVERSAMPLE, max(n, 1))
    r = np.random.default_rng(17).normal(size=(n, rank))
    shared = docs.sparkSession.sparkContext.broadcast((bench, weights, r))

    def add(column, total: np.ndarray) -> None:
        bench, weights, r = shared.value
        c = total.reshape(n, rank)
        for _, row, word in _cells(bench, column, length):
            use = weights[word] > 0
            row, word = row[use], word[use]
            if len(row):
                begin = np.flatnonzero(np.append(True, np.diff(row) != 0))
                y = np.add.reduceat(r[word] * weights[word][:, None], begin, axis=0)
                y = np.repeat(y, np.diff(np.append(begin, len(row))), axis=0) * weights[word][:, None]
                order = np.argsort(word, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(word[order]) != 0))
                c[word[order][first]] += np.add.reduceat(y[order], first, axis=0)

    return r, _summed(docs, n * rank, add).reshape(n, rank)


def _basis(r: np.ndarray, c: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Word vectors: weights times the leading right singular vectors, by Nystroem's approximation of A'A."""
    core = r.T @ c
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(initial=0), 0) * 1e-10
    u, _, _ = np.linalg.svd(c @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return weights[:, None] * u[:, :RANK]


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, v in enumerate(words):
        out[v] = out.get(v, 0) | 1 << i
    return out


def common_subsequence(n: int, words: list[int], masks: dict[int, int]) -> int:
    """Length of the longest common subsequence of ``words`` and n words with the given position masks, by bit-parallel rows."""
    full = (1 << n) - 1
    row = full
    for x in words:
        if m := masks.get(x):
            row = ((row + (row & m)) | (row & ~m)) & full
    return n - row.bit_count()


_HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("item_share", T.DoubleType()), T.StructField("answer_share", T.DoubleType())]))
_ARROW_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("item_share", pa.float64()), ("answer_share", pa.float64())]))


class _Search:
    def __init__(self, bench: Benchmark, weights: np.ndarray, df: np.ndarray, vectors: np.ndarray):
        self.bench, self.vectors, n = bench, vectors, len(bench.words)
        items = np.stack([vectors[x].sum(axis=0) for x in bench.words]) if n else np.zeros((0, vectors.shape[1]))
        self.items = items / np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-12)
        self.masks, self.answer_masks, entries = [], [], [np.zeros((3, 0), np.int64)]
        #: How many words of its rarer part an item's long enough subsequence needs.
        self.need = np.ones(n, int)
        for k, (x, (a, b)) in enumerate(zip(bench.words, bench.answers, strict=True)):
            self.masks.append(_masks(x))
            self.answer_masks.append(_masks(x[a:b]))
            own, count = np.unique(x, return_counts=True)
            order = np.argsort(df[own], kind="stable")
            part = order[: np.searchsorted(np.cumsum(count[order]), RARE_PART * len(x)) + 1]
            entries.append(np.stack([own[part], np.full(len(part), k), count[part]]))
            self.need[k] = max(1, int(np.ceil(MIN_ITEM * len(x) - 1e-9)) - (len(x) - int(count[part].sum())))
        #: Postings of the rarer words: word, item, count.
        postings = np.concatenate(entries, axis=1)
        self.word, self.item, self.count = postings[:, np.lexsort((postings[1], postings[0]))]

    def texts(self, column) -> list[list[dict]]:
        data, offsets = tn.text_buffers(column)
        out: list[list[dict]] = []
        for lo, hi in tn.slices(offsets):
            w = tn.words(data, offsets[lo : hi + 1], lower=True)
            at, best = self.bench.numbers(w.hashes), {}
            for s in np.unique(self.bench.scale):
                self._scale(w, at, int(s), best)
            rows: list[list[dict]] = [[] for _ in range(hi - lo)]
            for (text, k), (cos, item, answer) in sorted(best.items()):
                rows[text].append({"item_id": self.bench.ids[k], "cosine": cos, "item_share": item, "answer_share": answer})
            out += rows
        return out

    def _pairs(self, w: tn.Words, at: np.ndarray, mine: np.ndarray, stride: int, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages (numbered over all texts) and items that hold enough of the item's rarer words."""
        own = np.isin(self.item, mine)
        word, item, count = self.word[own], np.searchsorted(mine, self.item[own]), self.count[own]
        begin = np.searchsorted(word, np.arange(len(self.vectors) + 1))
        spots = np.flatnonzero(at >= 0)
        many = np.diff(begin)[at[spots]]
        spots, many = spots[many > 0], many[many > 0]
        which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[at[spots]], many)
        spot, k, held = np.repeat(spots, many), item[which], count[which]
        text = w.text[spot]
        last, base = (spot - w.first[text]) // stride, np.cumsum(per) - per
        keys, weights = [], []
        for back in range(3):  # a passage is three strides long
            ok = (last - back >= 0) & (last - back < per[text])
            keys.append((base[text[ok]] + last[ok] - back) * len(mine) + k[ok])
            weights.append(held[ok])
        pairs, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        held = np.bincount(inverse, weights=np.concatenate(weights), minlength=len(pairs))
        passage, k = pairs // len(mine), pairs % len(mine)
        use = held >= self.need[mine][k]
        return passage[use], k[use]

    def _scale(self, w: tn.Words, at: np.ndarray, scale: int, best: dict) -> None:
        mine = np.flatnonzero(self.bench.scale == scale)
        length = self.bench.scales[scale]
        start, end, per = _passages(w, length)
        passage, k = self._pairs(w, at, mine, length // 3, per)
        for i in range(0, len(passage), STEP):
            p = passage[i : i + STEP]
            own, which = np.unique(p, return_inverse=True)
            sums = np.stack([self.vectors[x[x >= 0]].sum(axis=0) for x in (at[start[j] : end[j]] for j in own.tolist())])
            sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
            cosine = (sums[which] * self.items[mine[k[i : i + STEP]]]).sum(axis=1)
            for j in np.flatnonzero(cosine >= MIN_COSINE).tolist():
                self._verify(at, w, int(start[p[j]]), int(end[p[j]]), int(mine[k[i + j]]), float(cosine[j]), best)

    def _verify(self, at: np.ndarray, w: tn.Words, start: int, end: int, k: int, cosine: float, best: dict) -> None:
        x, (a, b), text = self.bench.words[k], self.bench.answers[k], int(w.text[start])
        passage = at[start:end].tolist()
        item = common_subsequence(len(x), passage, self.masks[k]) / len(x)
        if item < MIN_ITEM:
            return
        answer = common_subsequence(b - a, passage, self.answer_masks[k]) / (b - a)
        if answer >= MIN_ANSWER and (item, cosine) > best.get((text, k), (0.0, 0.0, 0.0))[1::-1]:
            best[text, k] = (cosine, item, answer)


def _searched(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, answer_col: str | None) -> DataFrame:
    """Every row as ``row`` with the ``hits`` that the search verified."""
    bench = _read(benchmark, item_col, item_text_col, answer_col)
    text = F.col(text_col).cast("string").alias("text")
    texts = docs.select(text)
    df, passages = _frequencies(texts, bench, SCALES[1])
    weights = np.where(_features(bench, df, passages), np.log((1 + passages) / (1 + df)), 0.0)
    r, c = _sketch(texts, bench, weights, SCALES[1])
    shared = docs.sparkSession.sparkContext.broadcast((bench, weights, df, _basis(r, c, weights)))
    rows = docs.select(text, F.struct(*(F.col(f"`{x}`") for x in docs.columns)).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(*shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(search.texts(b.column("text")), _ARROW_HITS)], names=["row", "hits"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("hits", _HITS)]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """Benchmark items found in each document: doc_id, contaminated and hits (item_id, cosine, item_share, answer_share).

    Null and empty texts hold nothing; items without an id or words are
    skipped. Repeated rows and null ids are searched like any other; other
    columns are ignored; with no benchmark every document is clean.
    """
    out = _searched(docs.select(id_col, text_col), benchmark, text_col, item_col, item_text_col, answer_col)
    return out.select(F.col(f"row.{id_col}").alias("doc_id"), (F.size("hits") > 0).alias("contaminated"), "hits")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """The documents in which no item is found, with their own columns."""
    return _searched(docs, benchmark, text_col, item_col, item_text_col, answer_col).where(F.size("hits") == 0).select("row.*")
