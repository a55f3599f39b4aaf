"""Exact n-gram Jaccard join by parity sketches.

Sets whose Jaccard similarity reaches P differ in at most (1 - P) / (1 + P) of the sum of their sizes. Sizes fall into
bands, each as wide as partners may differ in size, so partners lie in one band or in neighbouring ones. For a band
whose sets differ in D shingles at most, a hash deals the shingles to D + 1 words of 64 bits and toggles one bit of the
word. Every differing shingle changes one word, so at least one word of two partners is equal (pigeonhole): classes of
equal sets meet in buckets of (band, place, word), a class with the sketch of its own band and with that of the band
below. The Hamming distance of sketches never exceeds the symmetric difference, so a short sketch of 1024 bits drops
pairs that are too far apart; the others are compared on full sets and grouped (`_links`).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.llm import _text as X
from concordia.llm._cluster import settle, workspace
from concordia.llm._links import Sizes, groups
from concordia.llm.near_dedup import _KEY, _keyed, digests

#: Bits of the short sketch.
SHORT_BITS = 1024


def most_different(a, b, percent: int):
    """The largest symmetric difference of sets of these sizes whose similarity is percent / 100 or more."""
    return (a + b) * (100 - percent) // (100 + percent)


@cache
def size_bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(least size, words of the sketch) of each band, up to sizes of 2^40.

    A set's larger partners are at most 100 / percent times as large, which is less than the end of the next band."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(100 * least[-1] // percent + 1)
    least = np.array(least, np.int64)
    largest = least[1:] - 1
    return least[:-1], most_different(largest, 100 * largest // percent, percent) + 1


def parity_words(sets: np.ndarray, doc: np.ndarray, words: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words end to end, offsets): each document's shingles dealt to so many 64-bit words, a bit of which each toggles."""
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum(words, out=offsets[1:])
    h = X.mix(sets ^ X.mix(seed.astype(np.uint64) + np.uint64(X._BASE))[doc])
    at = (((h >> np.uint64(32)) * words[doc].astype(np.uint64)) >> np.uint64(32)).astype(np.int64) + offsets[doc]
    out = np.zeros(int(offsets[-1]), np.uint64)
    np.bitwise_xor.at(out, at, np.uint64(1) << (h & np.uint64(63)))
    return out, offsets


def sketch(docs: DataFrame, k: int, percent: int, text_col: str) -> DataFrame:
    """id (the key), n_shingles, digest, sketch (short), band, own and below (its words in its band and the one below).

    All but the first two are null without shingles; below is null in the first band."""
    least, words = size_bands(percent)
    kind = docs.schema[_KEY].dataType.simpleString()
    names = ["id", "n_shingles", "digest", "sketch", "band", "own", "below"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, s in X.slices(batch.column(1)):
                sets, offsets = X.shingle_sets(s, k)
                count = np.diff(offsets)
                some = np.flatnonzero(count)
                digest, short, own, below = ([None] * s.n for _ in range(4))
                bands = np.searchsorted(least, count, side="right") - 1
                if len(some):
                    doc, band = np.repeat(np.arange(len(some)), count[some]), bands[some]
                    every = [parity_words(sets, doc, np.full(len(some), SHORT_BITS // 64), np.full(len(some), -1)), parity_words(sets, doc, words[band], band)]
                    down = np.where(band > 0, words[np.maximum(band - 1, 0)], 0)
                    has = (down > 0)[doc]
                    every.append(parity_words(sets[has], doc[has], down, band - 1))
                    for row, d in zip(some.tolist(), digests(sets, np.append(offsets[some], len(sets)))):
                        digest[row] = d
                    for (found, upto), to in zip(every, (short, own, below)):
                        for i, row in enumerate(some.tolist()):
                            if upto[i + 1] > upto[i]:
                                to[row] = found[upto[i] : upto[i + 1]].tobytes()
                columns = [batch.column(0).slice(at, s.n), pa.array(count.astype(np.int64)), *(pa.array(c, pa.binary()) for c in (digest, short)), pa.array(bands.astype(np.int32), mask=count == 0), *(pa.array(c, pa.binary()) for c in (own, below))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(_KEY).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_shingles long, digest binary, sketch binary, band int, own binary, below binary")


def _keys(classes: DataFrame) -> DataFrame:
    """bucket, id: one row for each word of a class's sketches; a bucket is 64 bits of hash of band, place and word."""
    kind = classes.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            band = batch.column(1).to_numpy()
            for side in (0, 1):
                column = batch.column(2 + side).cast(pa.large_binary()).fill_null(b"")
                for a in range(0, len(batch), 4096):
                    part = column.slice(a, 4096)
                    _, upto, data = part.buffers()
                    upto = np.frombuffer(upto, np.int64)[part.offset : part.offset + len(part) + 1]
                    words = np.frombuffer(data, np.uint8)[upto[0] : upto[-1]].view(np.uint64) if data is not None else np.zeros(0, np.uint64)
                    count = np.diff(upto) // 8
                    row = np.repeat(np.arange(a, a + len(part)), count)
                    place = np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count)
                    salt = X.mix((band[row] - side).astype(np.uint64) << np.uint64(40) | place.astype(np.uint64))
                    bucket = X.mix(words ^ salt).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column(0).take(pa.array(row))], ["bucket", "id"])

    return classes.select("id", "band", "own", "below").mapInArrow(run, f"bucket long, id {kind}")


def _grouped(docs: DataFrame, k: int, percent: int, text_col: str, sizes: Sizes) -> DataFrame:
    """key, n_shingles, group of each row of keyed docs: the least key of its component; null without shingles."""
    sketched = settle(sketch(docs, k, percent, text_col), "sketches")
    columns = ["n_shingles", "sketch", "band", "own", "below"]
    classes = sketched.where("digest is not null").groupBy("digest").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in columns])
    classes = settle(classes, "classes")
    keys = _keys(classes)
    shared = keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = settle(keys.join(settle(shared, "shared"), "bucket", "left_semi"), "buckets")

    def near(far: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (far <= most_different(a, b, percent))

    texts = docs.select(F.col(_KEY).alias("id"), F.col(text_col).alias("text"))
    labels = groups(classes.select("id", "n_shingles", "sketch"), buckets, texts, near, k, percent, sizes)
    by_class = classes.select("digest", "id").join(labels, classes.id == labels.node, "left").select("digest", F.coalesce("label", "id").alias("group"))
    return sketched.select(F.col("id").alias("key"), "n_shingles", "digest").join(by_class, "digest", "left")


def join_components(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id that links lead to, its own included).

    Texts link if 100 times the intersection of the sets of their k-word shingles is at least percent times the union
    (A-Z lower-cased; fewer than k words: all of them as one). The join is exact: no link is missed and none is added.
    Null or empty texts, or ones without words, have no shingles and no link. Null ids never win against others; repeated ids
    with different texts are joined text by text, repeated rows are equal sets. Other columns are not read. An empty table
    gives an empty result."""
    with workspace(docs.sparkSession):
        keyed, is_id = _keyed(docs, id_col)
        found = _grouped(keyed, k, percent, text_col, sizes)
        if is_id:
            out = found.select(F.col("key").alias("id"), "n_shingles", F.coalesce("group", "key").alias("component"))
        else:
            found = settle(found.join(keyed.select(F.col(_KEY).alias("key"), F.col(id_col).alias("id")), "key"), "found")
            least = found.where("group is not null").groupBy("group").agg(F.min("id").alias("least"))
            out = found.join(least, "group", "left").select("id", "n_shingles", F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("least")).alias("component"))
        return settle(out.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id")), "joined", keep=True)
