"""Groups of linked sets, from classes of equal sets in buckets: the engine of the near-duplicate operators.

1. Each bucket links its members to its smallest class. Candidate pairs pass if the XOR population count of their sketches
   allows the similarity, and count as links only after their full shingle sets have been compared.
2. Connected components by alternating star contraction. Buckets that still hold several components are compared across
   components, in blocks of bounded size, first the likeliest partners of each class, then more, until no untested pair is
   left. So a large group costs one link for each member, and no link between different texts is lost to a cap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.llm import _text as X
from concordia.llm._cluster import semi_by_id, settle


@dataclass(frozen=True)
class Sizes:
    """per_hub: members of a hub that one task compares with it. partners: likeliest partners of a class by round (None:
    all). per_block: classes of a bucket in one block, in buckets of more than `blocks` blocks up to most_per_block, so that
    a row is not copied too often."""

    per_hub: int = 256
    partners: tuple[int | None, ...] = (4, None)
    per_block: int = 1024
    blocks: int = 8
    most_per_block: int = 2048


#: (XOR population counts, sizes, sizes) to whether such sets may have the similarity.
Near = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def alike(pairs: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the similarity."""
    side = lambda n: classes.select(F.col("id").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("n_shingles", "sketch")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            odd = [np.frombuffer(b"".join(t[f"sketch_{n}"].to_pylist()), np.uint8).reshape(len(batch), -1) for n in "ab"]
            far = np.bitwise_count(odd[0] ^ odd[1]).sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(near(far, t["n_shingles_a"].to_numpy(), t["n_shingles_b"].to_numpy())))

    kind = classes.schema["id"].dataType.simpleString()
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, f"a {kind}, b {kind}")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have percent / 100 of their union in common."""
    if not len(a) or not len(b):
        return False
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int, per_hub: int = Sizes.per_hub) -> DataFrame:
    """Those of the settled pairs (hub a, member b) of which percent / 100 of the union of their full shingle sets are in both.

    docs: id, text. A hub's members are dealt to tasks per_hub at a time, each with the hub's
    text; a task streams its rows and holds one hub's set at a time."""
    kind = docs.schema["id"].dataType.simpleString()
    ids = settle(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    texts = settle(semi_by_id(docs, ids, "id"), "texts")
    per = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / per_hub).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    members = pairs.join(per, "a").select("a", part.alias("part"), F.col("b").alias("id")).join(texts, "id").select("a", "part", "id", "text")
    hubs = per.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(texts.withColumnRenamed("id", "a"), "a")
    rows = members.unionByName(hubs.select("a", "part", F.lit(None).cast(kind).alias("id"), "text"))
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("id").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hubs, key = [], None  # the hub's set
        for batch in batches:
            a, part, b = (batch.column(i).to_pylist() for i in range(3))
            yes_a, yes_b = [], []
            for at, s in X.slices(batch.column(3)):
                sets, offsets = X.shingle_sets(s, k)
                for i in range(s.n):
                    own = sets[offsets[i] : offsets[i + 1]]
                    row = at + i
                    if (a[row], part[row]) != key:
                        hubs, key = [], (a[row], part[row])
                    if b[row] is None:
                        hubs.append(own)
                    elif any(_linked(hub, own, percent) for hub in hubs):
                        yes_a.append(a[row])
                        yes_b.append(b[row])
            yield pa.RecordBatch.from_arrays([pa.array(yes_a, batch.column(0).type), pa.array(yes_b, batch.column(0).type)], ["a", "b"])

    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node that it reaches) of every node on a link (a, b); large-star and small-star by turns.

    Each step is two shuffles of the links with map-side minima; only one count and one sum come to the driver."""
    edges = settle(edges.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select("m", F.explode(F.array("u", "v")).alias("v")).select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        edges = settle(small, "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct())
        before = state


def across(buckets: DataFrame, labels: DataFrame, classes: DataFrame, near: Near, partners: int | None, sizes: Sizes = Sizes()) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs between different components of a bucket, the `partners` likeliest by class and component (None:
    all), and the buckets in which some were left out. If the classes have `bands`, their buckets in one order, a pair is found in
    the first bucket only that both share."""
    kind = classes.schema["id"].dataType.simpleString()
    labelled = buckets.join(labels, buckets.id == labels.node, "left").select("bucket", "id", F.coalesce("label", "id").alias("label"))
    mixed = labelled.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high and n > 2")
    blocks = F.least(F.ceil(F.col("n") / sizes.per_block), F.greatest(F.lit(sizes.blocks), F.ceil(F.col("n") / sizes.most_per_block))).cast("int")
    rows = labelled.join(mixed.select("bucket", blocks.alias("blocks")), "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = [c for c in ("n_shingles", "sketch", "bands") if c in classes.columns]
    rows = rows.join(classes.select("id", *own), "id").select("bucket", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "id", "label", *own)

    def run(t: pa.Table) -> pa.Table:
        size = t["n_shingles"].to_numpy()
        label = np.unique(np.array(t["label"].to_pylist(), object), return_inverse=True)[1]
        odd = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(len(t), -1)
        place = 0  # of the bucket among a class's bands
        if "bands" in t.column_names:
            bands = t["bands"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)
            place = int(np.flatnonzero(bands[0] == t["bucket"][0].as_py())[0])
        block, p, q = t["block"].to_numpy(), t["p"][0].as_py(), t["q"][0].as_py()
        mine, others = np.flatnonzero(block == p), np.flatnonzero(block == q)
        a, b, cut = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], False
        for i in mine:
            js = others[(label[others] != label[i]) & ((others > i) | (p != q))]
            far = np.bitwise_count(odd[js] ^ odd[i]).sum(axis=1, dtype=np.int64)
            on = near(far, size[i], size[js])
            js, far = js[on], far[on]
            if place:
                new = ~(bands[js, :place] == bands[i, :place]).any(axis=1)
                js, far = js[new], far[new]
            if partners is not None and len(js):
                order = np.lexsort((far, label[js]))
                js = js[order]
                starts = np.r_[0, np.flatnonzero(np.diff(label[js])) + 1]
                nth = np.arange(len(js)) - np.repeat(starts, np.diff(np.r_[starts, len(js)]))
                cut |= bool((nth >= partners).any())
                js = js[nth < partners]
            a.append(np.full(len(js), i, np.int32))
            b.append(js.astype(np.int32))
        ids = t["id"]
        left, right = (ids.take(pa.array(np.concatenate(x))) for x in (a, b))
        if cut:  # a row without ids tells of it
            left, right = (pa.chunked_array([*c.chunks, pa.nulls(1, ids.type)], ids.type) for c in (left, right))
        return pa.table({"bucket": pa.array(np.full(len(left), t["bucket"][0].as_py(), np.int64)), "a": left, "b": right})

    found = settle(rows.groupBy("bucket", "p", "q").applyInArrow(run, f"bucket long, a {kind}, b {kind}"), "across")
    pairs = found.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs, found.where("a is null").select("bucket").distinct()


def groups(classes: DataFrame, buckets: DataFrame, texts: DataFrame, near: Near, k: int, percent: int, sizes: Sizes = Sizes()) -> DataFrame:
    """node, label (the smallest id of its group) of the classes that have a link.

    classes: id, n_shingles, sketch (and bands, see `across`); buckets: bucket, id; both settled. texts: id, text, of classes at least."""
    leaders = buckets.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    star = buckets.join(leaders, "bucket").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    star = settle(alike(star, classes, near), "star")
    links = settle(confirmed(star, texts, k, percent, sizes.per_hub), "confirmed")
    labels, tested = components(links), star
    crowded = settle(buckets.join(leaders.where("n > 2").select("bucket"), "bucket", "left_semi"), "crowded")
    for partners in sizes.partners:
        pairs, cut = across(crowded, labels, classes, near, partners, sizes)
        pairs = settle(pairs.join(tested, ["a", "b"], "left_anti"), "untested")
        if not pairs.isEmpty():
            more = settle(confirmed(pairs, texts, k, percent, sizes.per_hub), "confirmed")
            tested, links = tested.unionByName(pairs), links.unionByName(more)
            if not more.isEmpty():
                labels = components(links)
        crowded = settle(crowded.join(cut, "bucket", "left_semi"), "crowded")
        if crowded.isEmpty():
            break
    return labels
