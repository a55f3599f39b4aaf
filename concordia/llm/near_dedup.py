"""MinHash near-dedup with odd sketches.

1. One pass over the texts: the shingle set's size and 128-bit digest, MinHash band keys, and
   an odd sketch: every sample of a one-permutation MinHash (the least hash of each of SAMPLES
   bins) toggles one bit of a parity bitmap.
2. Equal sets are one class (its representative the smallest id); only classes go on.
3. Classes meet in band buckets, are compared by sketches, confirmed on full sets and grouped: see `_links`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.llm import _text as X
from concordia.llm._cluster import semi_by_id, settle, workspace
from concordia.llm._links import Sizes, groups

#: Bits of an odd sketch; bins of its samples (a power of two); standard errors by which an estimate may miss.
SKETCH_BITS, SAMPLES, SLACK = 1024, 1024, 4.5
#: The chance that a pair of exactly the least similarity shares no band.
MISS = 1e-6

#: Members of a hub that one task compares with it; partners by round.
PER_HUB, PARTNERS = 256, (4, None)
#: Classes of a bucket in one block: PER_BLOCK, in buckets of more than BLOCKS blocks up to MOST_PER_BLOCK.
PER_BLOCK, BLOCKS, MOST_PER_BLOCK = 1024, 8, 2048

#: The column that tells rows apart.
_KEY = "_concordia_key"
SKETCHED = "n_shingles long, digest binary, sketch binary, bands array<long>"


def bands_for(similarity: float) -> tuple[int, int]:
    """(bands, rows): the fewest samples among 3 to 6 rows whose MISS holds at the similarity."""
    rows = 5 if similarity >= 0.82 else 4 if similarity >= 0.7 else 3 if similarity >= 0.5 else 2
    return math.ceil(math.log(MISS) / math.log(1 - similarity**rows)), rows


def _seeds(n: int) -> np.ndarray:
    return np.random.default_rng(8).integers(1, 2**63, (n, 2), dtype=np.int64).astype(np.uint64) | np.uint64(1)


def signatures(sets: np.ndarray, offsets: np.ndarray, samples: int) -> np.ndarray:
    """MinHash samples by document (rows) of sorted shingle sets end to end; a set mustn't be empty."""
    out = np.zeros((len(offsets) - 1, samples), np.uint64)
    for i, (a, b) in enumerate(_seeds(samples)):
        x = sets * a
        x ^= x >> np.uint64(32)
        x *= b
        out[:, i] = np.minimum.reduceat(x, offsets[:-1])
    return out


def digests(sets: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128 bits of each set: sums of two mixes of its shingles (a set, so order is none)."""
    out = [np.add.reduceat(X.mix(sets + np.uint64(s)), offsets[:-1]) for s in (11, 12)]
    return [r.tobytes() for r in np.stack(out, axis=1)]


def odd_sketches(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Parity bitmaps, one row of bytes for each of the sorted sets end to end."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    where = doc * SAMPLES + (sets >> np.uint64(64 - SAMPLES.bit_length() + 1)).astype(np.int64)
    least = np.ones(len(sets), bool)  # sets are sorted, so the first of a bin is its least
    least[1:] = where[1:] != where[:-1]
    doc, samples = doc[least], sets[least]
    at = (X.mix(samples + np.uint64(X._BASE)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(doc * SKETCH_BITS + at, minlength=n * SKETCH_BITS).reshape(n, SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1)


def may_match(far: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets with these XOR population counts and sizes may have the similarity J.

    At J the union has N = (|A| + |B|) / (1 + J) shingles, which fill U of the bins. A share 1 - J of these has a least
    hash that one set lacks: one sample differs, and a second one if the other set is in the bin too (a chance p). The
    number of differing samples may pass its mean by SLACK errors (of drawing U of N without replacement, of p and of
    U), and the bitmap's count, which never exceeds that number, its own mean by SLACK errors."""
    j, k, n = similarity, float(SAMPLES), float(SKETCH_BITS)
    large, small = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    union = (large + small) / (1 + j)
    fill, q = np.exp(-union / k), (1 - j) / 2
    bins = k * (1 - fill)
    p = 1 - fill / np.maximum(1 - fill, 1e-12) * np.expm1(union / k * q) / q
    wide = np.maximum(k * (fill - fill * fill * (1 + union / k)), 0)
    error = (1 + p) ** 2 * bins * j * (1 - j) * np.maximum(1 - bins / union, 0) + bins * (1 - j) * p * (1 - p) + ((1 - j) * (1 + p)) ** 2 * wide
    differ = bins * (1 - j) * (1 + p) + SLACK * np.sqrt(error)
    one, two = (1 - 2 / n) ** differ, (1 - 4 / n) ** differ
    most = n / 2 * (1 - one) + SLACK * np.sqrt(np.maximum(n + n * (n - 1) * two - n * n * one * one, 0)) / 2
    return (small >= j * large - 1e-9) & (far <= np.ceil(np.minimum(differ, most) + 1e-9))


def sketch(docs: DataFrame, k: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, digest, sketch, bands (keys); the last three are null without shingles."""
    bands, rows = bands_for(similarity)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, s in X.slices(batch.column(1)):
                sets, offsets = X.shingle_sets(s, k)
                count = np.diff(offsets)
                some = np.flatnonzero(count)
                digest, odd, keys = ([None] * s.n for _ in range(3))
                if len(some):
                    own = np.append(offsets[some], len(sets))
                    signature = signatures(sets, own, bands * rows)
                    band = X.mix(signature.reshape(len(some), bands, rows) * (2 * np.arange(rows, dtype=np.uint64) + np.uint64(X._BASE))).sum(axis=2, dtype=np.uint64)
                    band = X.mix(band + np.arange(bands, dtype=np.uint64)).view(np.int64)
                    for row, d, o, b in zip(some.tolist(), digests(sets, own), odd_sketches(sets, own), band.tolist()):
                        digest[row], odd[row], keys[row] = d, o.tobytes(), b
                columns = [batch.column(0).slice(at, s.n), pa.array(count.astype(np.int64)), pa.array(digest, pa.binary()), pa.array(odd, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "digest", "sketch", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {SKETCHED}")


def _keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, bool]:
    """docs with _KEY, not null and different in all rows, and whether it is the id; else it is a number that a settled
    copy of docs holds."""
    twice = docs.groupBy(id_col).agg(F.count("*").alias("_n")).where(F.col(id_col).isNull() | (F.col("_n") > 1))
    if twice.isEmpty():
        return docs.withColumn(_KEY, F.col(id_col)), True
    return settle(docs.withColumn(_KEY, F.monotonically_increasing_id()), "keyed"), False


def _grouped(docs: DataFrame, k: int, similarity: float, text_col: str) -> DataFrame:
    """key, n_shingles, digest and group of each row of keyed docs; rows of one group are near-duplicates.

    group and digest are null without shingles. Nodes of the links are keys, so that texts under one id stay apart. The
    result is settled; all tables between are deleted."""
    with workspace(docs.sparkSession):
        return settle(_linked_rows(docs, k, similarity, text_col), "groups", keep=True)


def _linked_rows(docs: DataFrame, k: int, similarity: float, text_col: str) -> DataFrame:
    sketched = settle(sketch(docs, k, similarity, _KEY, text_col), "sketches")
    full = sketched.where("digest is not null")
    classes = settle(full.groupBy("digest").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), *[F.first(c).alias(c) for c in ("sketch", "bands")]), "classes")
    texts = docs.select(F.col(_KEY).alias("id"), F.col(text_col).alias("text"))

    buckets = settle(classes.select("id", F.explode("bands").alias("bucket")), "buckets")
    near = lambda far, a, b: may_match(far, a, b, similarity)
    labels = groups(classes.select("id", "n_shingles", "sketch", "bands"), buckets, texts, near, k, round(100 * similarity), Sizes(PER_HUB, PARTNERS, PER_BLOCK, BLOCKS, MOST_PER_BLOCK))
    by_class = classes.join(labels, classes.id == labels.node, "left").select("digest", F.coalesce("label", "id").alias("group"))
    return sketched.select(F.col("id").alias("key"), "n_shingles", "digest").join(by_class, "digest", "left")


def near_duplicates(docs: DataFrame, k: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Texts are linked if the sets of their k-word shingles (A-Z lower-cased; fewer than k words: all of them as one)
    have that Jaccard similarity or more; component_id is the smallest id reachable, kept is whether it is the own one.
    Null or empty texts, or ones without words, have no shingles and are their own component. A null id never wins
    against others; repeated ids with different texts are compared text by text. Other columns are not read. An empty
    table gives an empty result."""
    keyed, is_id = _keyed(docs, id_col)
    found = _grouped(keyed, k, similarity, text_col)
    if is_id:
        out = found.withColumn("id", F.col("key")).withColumn("component", F.coalesce("group", "id"))
    else:
        found = found.join(keyed.select(F.col(_KEY).alias("key"), F.col(id_col).alias("id")), "key")
        least = found.where("group is not null").groupBy("group").agg(F.min("id").alias("least"))
        out = found.join(least, "group", "left").withColumn("component", F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("least")))
    component = F.col("component")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.col("id").isNull() & component.isNull()).alias("kept"))


def keep_one_of_each(docs: DataFrame, k: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", unique_ids: bool = True) -> DataFrame:
    """The rows of docs, with all their columns, of which each group of near-duplicates keeps one (the smallest id, nulls last).

    Texts are told apart whatever their ids. Rows without shingles all stay, but equal ones (id and text) once. With
    unique_ids, of the rows that are left under one id, one stays, even if their texts differ; null ids are not ids. An
    empty table gives an empty result; a column named as one of the operator's own stays as it is."""
    keyed, is_id = _keyed(docs, id_col)
    found = _grouped(keyed, k, similarity, text_col)
    if is_id:
        kept = found.where("group is null or group = key").select(F.col("key").alias(id_col))
        return semi_by_id(docs, kept, id_col).select(*docs.columns)
    ids = keyed.select(F.col(_KEY).alias("key"), F.col(id_col).alias("id"), F.when(F.col(text_col).rlike(r"^[ \t-\r]*$"), F.col(text_col)).alias("blank"))
    found = found.join(ids, "key")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest", "key")).getField("key").alias(_KEY)
    kept = found.where("digest is not null").groupBy("group").agg(first).select(_KEY).unionByName(found.where("digest is null").groupBy("id", "blank").agg(F.min("key").alias(_KEY)).select(_KEY))
    one = semi_by_id(keyed, kept, _KEY)
    if unique_ids:
        nth = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(text_col), _KEY))
        one = one.where(F.col(id_col).isNotNull()).withColumn("_concordia_nth", nth).where("_concordia_nth = 1").drop("_concordia_nth").unionByName(one.where(F.col(id_col).isNull()))
    return one.select(*docs.columns)
