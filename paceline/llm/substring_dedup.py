"""Substring deduplication by Rabin-Karp hashes of fixed-length word windows.

Documents are dealt into groups. Each group hashes all of its windows and
keeps one entry for each distinct hash, that of its smallest document, so a
passage shared by any number of documents gives one entry a group. Entries
are sent to hash buckets, where a hash is a repeat for every group but the
one that holds the smallest document; one bit an entry goes back. The group
then hashes its windows again, marks repeats, and merges marked windows into
maximal removal intervals.

Windows are told apart by 64-bit hashes: of N different windows, N * N / 2**65
pairs are expected to agree by chance. That is one in 10**9 at 2 * 10**5
windows, 270 at 10**11 and some 2.7 million at 10**13, each of which removes
at most 13 words that it shouldn't.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm import textnum as tn
from paceline.llm.spread import group_count, group_of

WINDOW = 13


def _group_windows(table: pa.Table, window: int):
    """Rows ordered by id, and all window hashes of the group in that order.

    Returns row order, ids, texts, words per row, and per distinct hash its
    first row; ``which`` maps every window to its distinct hash.
    """
    ids = table["id"].combine_chunks()
    present = ids.is_valid().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    texts = table["text"].combine_chunks().cast(pa.large_binary()).fill_null(b"")
    order = np.lexsort((values, ~present))
    if len(values) > 1 and (values[order][1:] == values[order][:-1]).any():
        raw = texts.to_pylist()
        order = np.array(sorted(range(len(values)), key=lambda i: (not present[i], values[i], raw[i])))
    texts = texts.take(pa.array(order))
    data, offsets = tn.text_buffers(texts)
    counts = np.zeros(len(order), np.int64)
    rows, at, hashes = [], [], []
    for a, b in tn.slices(offsets):
        w = tn.words(data, offsets[a : b + 1])
        counts[a:b] = w.counts
        s, h = tn.windows(w, window)
        rows.append(a + w.text[s])
        at.append(s - w.first[w.text[s]])
        hashes.append(h)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    rows, at, hashes = join(rows, np.int64), join(at, np.int64), join(hashes, np.uint64)
    use = present[order][rows]
    rows, at, hashes = rows[use], at[use], hashes[use]
    first, which = tn.first_of_each(hashes)
    return values[order], present[order], texts, counts, rows, at, hashes, first, which


def _entries(buckets: int, window: int):
    def run(table: pa.Table) -> pa.Table:
        group = table["grp"][0].as_py()
        ids, _, _, _, rows, _, hashes, first, _ = _group_windows(table, window)
        h, row = hashes[first], rows[first]
        order, present, begin = tn.by_bucket(tn.bucket_of(h, buckets))
        out = {"bucket": [], "grp": [], "ids": [], "counts": [], "hashes": []}
        for k, a, b in zip(present.tolist(), begin[:-1], begin[1:], strict=True):
            mine = order[a:b]
            own, n = np.unique(row[mine], return_counts=True)
            out["bucket"].append(k)
            out["grp"].append(group)
            out["ids"].append(ids[own].astype(np.int64).tobytes())
            out["counts"].append(n.astype(np.int32).tobytes())
            out["hashes"].append(h[mine].tobytes())
        return pa.table(out, schema=ENTRIES)

    return run


ENTRIES = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])
REPLIES = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])


def _repeats(table: pa.Table) -> pa.Table:
    """For each entry of a bucket, whether a smaller document has its hash."""
    ids = [np.repeat(np.frombuffer(i, np.int64), np.frombuffer(c, np.int32)) for i, c in zip(table["ids"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    hashes = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
    doc, h = np.concatenate(ids), np.concatenate(hashes)
    order = np.argsort(h, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(h[order]) != 0))
    least = np.minimum.reduceat(doc[order], begin)
    flag = np.zeros(len(h), bool)
    flag[order] = doc[order] > np.repeat(least, np.diff(np.append(begin, len(h))))
    cuts = np.cumsum([0, *map(len, hashes)])
    bits = [np.packbits(flag[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"grp": table["grp"], "bucket": table["bucket"], "bits": bits}, schema=REPLIES)


RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start: int, stop: int>>"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])


def _cut(buckets: int, window: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return _RESULT.empty_table()
        ids, present, texts, counts, rows, at, hashes, first, which = _group_windows(left, window)
        h = hashes[first]
        order, found, begin = tn.by_bucket(tn.bucket_of(h, buckets))
        bits = dict(zip(right["bucket"].to_pylist(), right["bits"].to_pylist(), strict=True))
        said = np.zeros(len(h), bool)
        for k, a, b in zip(found.tolist(), begin[:-1], begin[1:], strict=True):
            said[order[a:b]] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=int(b - a)).astype(bool)
        repeat = said[which] | (ids[rows] > ids[rows[first][which]])
        rows, at = rows[repeat], at[repeat]
        edge = np.searchsorted(rows, np.arange(len(ids) + 1))
        out = {"doc_id": [], "n_words": counts, "n_removed": [], "kept_text": [], "removed": []}
        for i, (raw, n) in enumerate(zip(texts.to_pylist(), counts.tolist(), strict=True)):
            parts, spans = raw.split(), []
            if edge[i] < edge[i + 1]:
                gone = np.zeros(n + 2, np.int8)
                gone[1:-1] = tn.covered(at[edge[i] : edge[i + 1]], window, n)
                step = np.diff(gone)
                spans = [{"start": a, "stop": b} for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)]
                kept, last = [], 0
                for s in spans:
                    kept += parts[last : s["start"]]
                    last = s["stop"]
                parts = kept + parts[last:]
            out["doc_id"].append(int(ids[i]) if present[i] else None)
            out["n_removed"].append(n - len(parts))
            out["kept_text"].append(b" ".join(parts).decode("utf-8", "replace"))
            out["removed"].append(spans)
        return pa.table(out, schema=_RESULT)

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a window that a smaller document also has.

    Returns one row for each input row: doc_id, n_words, n_removed,
    kept_text (kept words joined by one space) and removed (maximal
    intervals of word positions, stop excluded).

    Null or empty texts have no words. Rows with a null id are kept whole and
    count as no other row's earlier copy. Rows with equal ids don't remove
    each other's words, and all are returned. Other columns are ignored, and
    an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n = group_count(docs)
    dealt = docs.select("id", "text", group_of("id", "text", n).alias("grp"))
    entries = dealt.groupBy("grp").applyInArrow(_entries(n, window), "bucket int, grp int, ids binary, counts binary, hashes binary")
    replies = entries.groupBy("bucket").applyInArrow(_repeats, "grp int, bucket int, bits binary")
    return dealt.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(_cut(n, window), RESULT)
