"""Byte-level tokenising and hashing in numpy, for use inside Arrow tasks.

Words are maximal runs of bytes other than ASCII white space, which equals
the words of the decoded text, since UTF-8 never uses those bytes inside a
longer sequence. Everything here works on one slice of texts at a time, so
memory is bounded by the slice size plus the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000

U64 = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_CODE = np.random.default_rng(97).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(max(n, 1), base % 2**64, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = powers(1, 1)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(self.base, n), powers(self.inverse, n)
        return self.up[:n], self.down[:n]


_POWERS: dict[int, _Powers] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _POWERS.setdefault(base, _Powers(base)).get(n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads 64-bit hashes."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x = x * U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


@dataclass
class Words:
    """Words of consecutive texts: byte spans, text index and hash of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray  # first word of each text, and the total at the end
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column and their n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes, never cutting a text."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts that ``offsets`` cuts from ``data``."""
    base = int(offsets[0])
    part, cuts = data[base : int(offsets[-1])], np.asarray(offsets) - base
    if lower:
        part = _LOWER[part]
    n = len(part)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(part, none, none, none, np.zeros(len(cuts), np.int64), none.astype(U64))
    solid = ~_SPACE[part]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    edges = cuts[:-1][cuts[:-1] < cuts[1:]]
    begin[edges] = solid[edges]
    starts = np.flatnonzero(begin)
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    stop[edges[1:] - 1] |= solid[edges[1:] - 1]
    ends = np.flatnonzero(stop) + 1
    up, down = _powers(_BYTE_BASE, n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(_BYTE_CODE[part] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    first = np.searchsorted(starts, cuts)
    first[-1] = len(starts)
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(first))
    return Words(part, starts, ends, text, first, hashes)


def windows(w: Words, size: int, base: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
    """Start (word index) and Rabin-Karp hash of every window of ``size`` words inside one text."""
    n = len(w.starts)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    up, down = _powers(base, n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(w.hashes * up[:n], out=total[1:])
    at = np.flatnonzero(w.text[: n - size + 1] == w.text[size - 1 :])
    return at, mix((total[at + size] - total[at]) * down[at])


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words are covered by windows of ``size`` words at ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Even split of 64-bit hashes into n buckets by their high bits."""
    return (((hashes >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def by_bucket(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by bucket; the buckets present; where each begins, and the total."""
    order = np.argsort(buckets, kind="stable")
    present, begin = np.unique(buckets[order], return_index=True)
    return order, present, np.append(begin, len(order))


def first_of_each(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of first occurrences in ascending order, and for every item the index into them."""
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], rank[inverse]
