"""Whole-batch text primitives on UTF-8 bytes with numpy: words, lines, their numbers and shingles.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Everything here works on one
slice of an Arrow string column; slices hold about SLICE_BYTES of text (one document
at least), so memory stays bounded by the longest document whatever the Arrow batch holds.

Within a slice equal spans get equal numbers, different spans different ones: a hash sorts
them, then their bytes are compared. Between slices words are known by 64 bits of XXH3.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

SLICE_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
#: Spans of more bytes are hashed and compared one by one.
_SHORT = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Some documents' bytes end to end; `offsets` has each one's first byte and, last, the length."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, Slice]]:
    """(first row, Slice) over an Arrow string column; null is as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield at, Slice(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def _chunks(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By turns the next eight bytes of the spans that have as many left: (which spans, their bytes as one number)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    which, k = np.flatnonzero(size), 0
    while len(which):
        left = np.minimum(size[which] - k, 8).astype(np.uint64)
        yield which, eight[start[which] + k] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left))
        k += 8
        which = which[size[which] > k]


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one place for each distinct span of bytes, for each span its place therein); exact whatever their hashes are."""
    size = end - start
    long = np.flatnonzero(size > _SHORT)
    short = np.where(size > _SHORT, 0, size)
    h = mix(size.astype(np.uint64))
    for which, chunk in _chunks(data, start, short):
        h[which] = mix(h[which] ^ chunk) * np.uint64(_BASE)
    whole = {i: data[a:b].tobytes() for i, a, b in zip(long.tolist(), start[long].tolist(), end[long].tolist())}
    h[long] = np.fromiter(map(xxh3_64_intdigest, whole.values()), np.uint64, len(whole))
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    first, which = order[new], np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    like = first[which]
    same = bool((size[like] == size).all()) and all(whole[i] == whole[j] for i, j in zip(long.tolist(), like[long].tolist()))
    if same:
        same = all((chunk == other).all() for (_, chunk), (_, other) in zip(_chunks(data, start, short), _chunks(data, start[like], short)))
    if not same:  # two spans with one hash
        seen: dict[bytes, int] = {}
        spans = [data[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist())]
        which = np.array([seen.setdefault(x, len(seen)) for x in spans], np.int64)
        first = np.unique(which, return_index=True)[1]
    return first, which


@dataclass
class Words:
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # of each document its first word's place, and last the number of words
    one: np.ndarray  # of each distinct word of the slice one place
    number: np.ndarray  # of each word its number among the distinct ones

    def hashes(self) -> np.ndarray:
        """64 bits of each word that are the same in all slices."""
        spans = zip(self.start[self.one].tolist(), self.end[self.one].tolist())
        data = self.data.tobytes()
        return np.fromiter((xxh3_64_intdigest(data[a:b]) for a, b in spans), np.uint64, len(self.one))[self.number]


def words(s: Slice) -> Words:
    text = ~SPACE[s.data]
    before = np.empty_like(text)
    before[:1] = False
    before[1:] = text[:-1]
    bounds = s.offsets[:-1][s.offsets[:-1] < len(s.data)]
    before[bounds] = False
    start = np.flatnonzero(text & ~before)
    after = np.empty_like(text)
    after[-1:] = False
    after[:-1] = text[1:]
    after[bounds[bounds > 0] - 1] = False
    end = np.flatnonzero(text & ~after) + 1
    first = np.searchsorted(start, s.offsets)
    doc = np.repeat(np.arange(s.n), np.diff(first))
    return Words(s.data, start, end, doc, first, *distinct(s.data, start, end))


def inside(doc: np.ndarray, k: int) -> np.ndarray:
    """The places from which k words on belong to one document."""
    n = len(doc) - k + 1
    return np.flatnonzero(doc[:n] == doc[k - 1 :]) if n > 0 else np.zeros(0, np.int64)


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words within one document, and the places where they begin."""
    at = inside(doc, k)
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + hashes[at + i]
    return mix(out), at


def gram_keys(number: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every k consecutive words within one document, and the places where they begin.

    Keys are equal for the same words of the same document only: they are made of the words' numbers, without hashing."""
    at = inside(doc, k)
    if not len(at):
        return np.zeros(0, np.int64), at
    base = int(number.max()) + 1
    key, most = doc[at], int(doc[-1]) + 1
    for i in range(k):
        if most > 2**62 // base:
            key = np.unique(key, return_inverse=True)[1]
            most = len(at)
        key, most = key * base + number[at + i], most * base
    return key, at


def repeated(number: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Which words lie in some k consecutive words that occur twice or more in their document."""
    key, at = gram_keys(number, doc, k)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    out = np.zeros(len(number), bool)
    for i in range(k):
        out[at[twice] + i] = True
    return out


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between the places in first."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def shingle_sets(s: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each document with A-Z lower-cased: (sorted hashes end to end, offsets).

    Fewer than k words are one shingle together; no word, no shingle."""
    w = words(Slice(LOWER[s.data], s.offsets))
    count = np.diff(w.first)
    hashes = w.hashes()
    g, at = grams(hashes, w.doc, k)
    doc = w.doc[at]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = count[short] > i
            whole[has] = whole[has] * np.uint64(_BASE) + hashes[w.first[short[has]] + i]
        g, doc = np.concatenate([g, mix(whole + count[short].astype(np.uint64))]), np.concatenate([doc, short])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    if len(g):
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
        g, doc = g[new], doc[new]
    return g, np.searchsorted(doc, np.arange(s.n + 1))
