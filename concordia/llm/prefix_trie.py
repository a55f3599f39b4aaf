"""Conversation prefix trie: a node for each distinct sequence of first turns.

Turns are known by 128 bits of hash; a prefix's name is the XOR of its turns' hashes, each
salted by its place. Conversations are cut into strips of STRIP turns, so that no row grows
with a conversation; equal strips under one prefix are one row with a count. Rows are dealt
by ranges of (strip, prefix, turns). A task holds its range as a padded matrix of turn
numbers: lexsort orders it, the OR-accumulated changes of its columns from row to row mark
where nodes start, reduceat sums over the nodes of every depth, and in preorder a subtree
is one run. Only nodes that hold a range's first or last row can go on in another range:
these are summed over ranges afterwards, with what is above them.

Long conversations: the totals of the subtrees that begin at a strip's border are found
first, by doubling the distance from strip to strip, and then hang on the rows above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.llm._cluster import partitions_for, settle, workspace
from concordia.operators.joins import broadcast_if_small
from concordia.operators.sliced import row_numbers

#: Turns of a strip; rows of a range; conversation ids that are hashed as one piece of text.
STRIP, ROWS, IDS = 64, 8192, 4096

TURN = "struct<a: long, b: long, size: long>"
NODE = "depth long, a long, b long, up_a long, up_b long, conv long, up_conv long, n long, children long, leaves long, saved long"
#: What nodes on a range's border add: their text's size, and their and their ancestors' names in the strip.
_NODES = f"{NODE}, border boolean, size long, path array<struct<a: long, b: long>>"
PREFIX = ["a", "b"]


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, n (from 1), two hashes of each turn and the UTF-8 bytes of its text; ties of `turn` by role and text, nulls first."""
    t = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    t = t.withColumns({"late": F.col("turn").isNotNull()})  # false first
    t = row_numbers(t, ["conv"], ["late", "turn", "role", "text"], "n")
    h = lambda seed: F.xxhash64(F.lit(seed), F.length("role"), "role", "text")
    return t.select("conv", "n", h(1).alias("a"), h(2).alias("b"), F.octet_length("text").cast("long").alias("size"))


def rebuilt(turns: DataFrame, borrow: Column, base: Column, most: int) -> DataFrame:
    """conv, n, a, b, size of every conversation rebuilt: the first `borrow` turns of conversation `base`, then its own after
    its first `borrow`. The columns are over `conv`; borrow is at most `most`. Its length may be zero: then it has no row."""
    counts = settle(turns.groupBy("conv").agg(F.count("*").alias("turns")), "counts")
    plan = counts.select("conv", base.cast("long").alias("base"), borrow.cast("long").alias("h"))
    has = counts.select(F.col("conv").alias("base"), F.least("turns", F.lit(most)).alias("has"))
    plan = settle(plan.join(has, "base", "left").withColumn("has", F.least(F.coalesce("has", F.lit(0)), "h")), "plan")
    taken = turns.where(F.col("n") <= most).withColumnRenamed("conv", "base").join(plan.select("conv", "base", "h"), "base").where("n <= h").select("conv", "n", "a", "b", "size")
    own = turns.join(plan.select("conv", "h", "has"), "conv").where("n > h").select("conv", (F.col("n") - F.col("h") + F.col("has")).alias("n"), "a", "b", "size")
    return taken.unionByName(own)


def strips(turns: DataFrame, strip: int) -> DataFrame:
    """conv, s, turns (an array by place), the prefix (a, b) before the strip and, as end_a, end_b, upto, the one at its end."""
    salted = lambda c, seed: F.xxhash64(F.lit(seed), "n", "a", "b").alias(c)
    t = turns.select("conv", "n", ((F.col("n") - 1) / strip).cast("long").alias("s"), salted("pa", 3), salted("pb", 4), "size")
    per = t.groupBy("conv", "s").agg(F.array_sort(F.collect_list(F.struct("n", F.struct(F.col("pa").alias("a"), F.col("pb").alias("b"), "size").alias("t")))).alias("turns"), F.bit_xor("pa").alias("xa"), F.bit_xor("pb").alias("xb"), F.max("n").alias("upto"))
    so_far = Window.partitionBy("conv").orderBy("s")
    per = per.select("conv", "s", F.col("turns.t").alias("turns"), "upto", "xa", "xb", F.bit_xor("xa").over(so_far).alias("end_a"), F.bit_xor("xb").over(so_far).alias("end_b"), F.lead("s").over(so_far).isNull().alias("last"))
    return per.select("conv", "s", "turns", F.col("end_a").bitwiseXOR(F.col("xa")).alias("a"), F.col("end_b").bitwiseXOR(F.col("xb")).alias("b"), "end_a", "end_b", "upto", "last")


def _preorder(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in preorder (rows, then depths) as (row, depth): row i begins those from depth start[i] to length[i]."""
    count = np.maximum(length - start + 1, 0)
    row = np.repeat(np.arange(len(start)), count)
    at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, at


def shard(t: pa.Table, strip: int) -> pa.Table:
    """The nodes of one range of rows: s, a, b, turns, conv, n and, from further strips, children, leaves, saved."""
    s, pa_, pb = (t[c].to_numpy() for c in ("s", "a", "b"))
    lists = t["turns"].combine_chunks()
    length = lists.value_lengths().to_numpy().astype(np.int64)
    flat = lists.flatten()
    ta, tb, size = (flat.field(c).to_numpy() for c in ("a", "b", "size"))
    names = np.empty(len(ta), [("a", np.int64), ("b", np.int64), ("size", np.int64)])
    names["a"], names["b"], names["size"] = ta, tb, size
    first = np.cumsum(length) - length
    of, place = np.repeat(np.arange(len(t)), length), np.arange(len(ta)) - np.repeat(first, length)
    width = int(length.max())
    matrix = np.zeros((len(t), width + 1), np.int64)  # zero pads, so a prefix comes before what extends it
    matrix[of, place + 1] = np.unique(names, return_inverse=True)[1] + 1
    tops = np.empty(len(t), [("s", np.int64), ("a", np.int64), ("b", np.int64)])
    tops["s"], tops["a"], tops["b"] = s, pa_, pb
    matrix[:, 0] = np.unique(tops, return_inverse=True)[1]

    order = np.lexsort(matrix.T[::-1])
    matrix, length = matrix[order], length[order]
    change = np.ones(matrix.shape, bool)
    change[1:] = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
    start = np.maximum(change.argmax(axis=1), 1)  # the first depth in the strip at which a row begins nodes
    row, depth = _preorder(start, length)
    nodes = len(row)
    at = np.full((len(t), width + 1), -1)
    at[row, depth] = np.arange(nodes)
    at = np.maximum.accumulate(at, axis=0)  # of each row and depth (up to its length) its node
    value = lambda c: t[c].to_numpy(zero_copy_only=False)[order]
    n, conv, children, leaves, saved = (value(c) for c in ("n", "conv", "children", "leaves", "saved"))
    members, least = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    for d in range(1, width + 1):
        has = np.flatnonzero(length >= d)
        own = at[has, d]
        begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        members[own[begins]], least[own[begins]] = np.add.reduceat(n[has], begins), np.minimum.reduceat(conv[has], begins)

    # Names, sizes and parents.
    x = np.zeros((2, len(t), width + 1), np.int64)
    x[:, :, 0] = pa_[order], pb[order]
    back = np.empty(len(t), np.int64)
    back[order] = np.arange(len(t))
    x[0, back[of], place + 1], x[1, back[of], place + 1] = ta, tb
    x = np.bitwise_xor.accumulate(x, axis=2)
    sizes = np.zeros((len(t), width + 1), np.int64)
    sizes[back[of], place + 1] = size
    name, above, text = x[:, row, depth], x[:, row, depth - 1], sizes[row, depth]
    parent = np.where(depth > 1, at[row, depth - 1], -1)

    # A row's own end: what hangs below it from further strips.
    end = at[np.arange(len(t)), length]
    below = np.zeros((3, nodes), np.int64)
    for i, v in enumerate((children, leaves, saved)):
        below[i, end] = v
    border = np.zeros(nodes, bool)
    for r in (0, len(t) - 1):
        border[at[r, 1 : length[r] + 1]] = True

    kids = np.bincount(parent[(parent >= 0) & ~border], minlength=nodes) + below[0]
    leaf, weight = (kids == 0) & ~border, np.where(border, 0, (members - 1) * text)
    add = np.stack([leaf + below[1], weight + below[2]])
    total = np.zeros((2, nodes + 1), np.int64)
    np.cumsum(add, axis=1, out=total[:, 1:])
    stop = np.full(nodes, nodes)  # the next node in preorder that isn't deeper
    for d in range(1, width + 1):
        here = np.flatnonzero(depth == d)
        shallow = np.flatnonzero(depth <= d)
        stop[here] = np.r_[shallow, nodes][np.searchsorted(shallow, here) + 1]
    sums = total[:, stop] - total[:, np.arange(nodes)]
    # A border node holds what lies below it and below no deeper border node.
    direct = add.copy()
    hung = np.flatnonzero(~border & (parent >= 0) & border[np.maximum(parent, 0)])
    for i in range(2):
        np.add.at(direct[i], parent[hung], sums[i, hung])
    sums = np.where(border, direct, sums)
    up = np.where((parent >= 0) & ~border[np.maximum(parent, 0)], least[np.maximum(parent, 0)], 0)
    known = (parent >= 0) & ~border[np.maximum(parent, 0)]
    paths: list = [None] * nodes
    for r in {0, len(t) - 1}:
        path = [{"a": a, "b": b} for a, b in zip(x[0, r, 1 : length[r] + 1].tolist(), x[1, r, 1 : length[r] + 1].tolist())]
        for d, node in enumerate(at[r, 1 : length[r] + 1].tolist(), 1):
            paths[node] = path[:d]
    columns = [s[order][row] * strip + depth, *name, *above, least, pa.array(up, mask=~known), members, kids, *sums, border, text]
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    return pa.table([*map(pa.array, columns), pa.array(paths, kind)], ["depth", "a", "b", "up_a", "up_b", "conv", "up_conv", "n", "children", "leaves", "saved", "border", "size", "path"])


def _nodes(rows: DataFrame, count: int, strip: int, per_range: int) -> tuple[DataFrame, DataFrame]:
    """(whole nodes inside ranges, whole nodes of the borders): NODE, of rows with what hangs below them.

    up_conv is null where the parent is a border node or the row's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)  # one range: about per_range rows of at most `strip` turns
        if sum(map(len, got)):
            yield from shard(pa.Table.from_batches(got), strip).to_batches(1 << 16)

    dealt = rows.repartitionByRange(partitions_for(count, per_range), "s", "a", "b", "turns")
    found = settle(dealt.select("s", "a", "b", "turns", "conv", "n", "children", "leaves", "saved").mapInArrow(run, _NODES), "nodes")
    edge = found.where("border").groupBy("depth", "a", "b", "up_a", "up_b").agg(F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.first("size").alias("size"), F.first("path").alias("path"))
    edge = settle(edge, "edge")
    more = edge.where((F.col("depth") - 1) % strip != 0).groupBy("up_a", "up_b").agg(F.count("*").alias("more")).withColumnsRenamed({"up_a": "a", "up_b": "b"})
    edge = edge.join(more, PREFIX, "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    own = edge.select(F.explode("path").alias("p"), (F.col("leaves") + (F.col("children") == 0).cast("long")).alias("leaves"), (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"))
    sums = own.groupBy("p.a", "p.b").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    names = [c.split()[0] for c in NODE.split(", ")]
    edge = settle(edge.drop("leaves", "saved").withColumn("up_conv", F.lit(None).cast("long")).join(sums, PREFIX).select(*names), "borders")
    return found.where("not border").select(*names), edge


def _under(tops: DataFrame) -> DataFrame:
    """a, b, children, leaves, saved of whole subtrees under the strips' borders; tops: (a, b, up_a, up_b, children, leaves,
    saved) of the part in one strip, up being the border above (null under the first strip).

    Each step adds what lies as far again below, so steps grow with the logarithm of the most strips of a conversation."""
    at = settle(tops, "tops")
    jump = at.select("a", "b", "up_a", "up_b", "leaves", "saved")
    while not jump.where("up_a is not null").isEmpty():
        lower = jump.where("up_a is not null").groupBy("up_a", "up_b").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).withColumnsRenamed({"up_a": "a", "up_b": "b"})
        above = jump.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("up_a").alias("next_a"), F.col("up_b").alias("next_b"))
        z = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        jump = settle(jump.join(lower, PREFIX, "left").join(above, ["up_a", "up_b"], "left").select("a", "b", F.col("next_a").alias("up_a"), F.col("next_b").alias("up_b"), z("leaves", "l"), z("saved", "s")), "jump")
    return at.select("a", "b", "children").join(jump.select("a", "b", "leaves", "saved"), PREFIX)


def ends(last: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256 of prefixes at which conversations end (rows depth, a, b, conv): the hash of their ids in order.

    Ids are sorted over all tasks by ranges and joined IDS at a time; only the hash, which is serial, reads a prefix's
    pieces one after another, and holds one of them."""
    rows = last.repartitionByRange(int(last.sparkSession.conf.get("spark.sql.shuffle.partitions")), "depth", "a", "b", "conv").sortWithinPartitions("depth", "a", "b", "conv").select("depth", "a", "b", "conv")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(3)])
            new = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]) if len(batch) else np.zeros(0, int)
            conv = batch.column(3).to_pylist()
            cuts = [(i, min(i + IDS, b)) for a, b in zip(new.tolist(), [*new[1:].tolist(), len(conv)]) for i in range(a, b, IDS)]
            starts = pa.array([a for a, _ in cuts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(starts) for i in range(4)), pa.array([",".join(map(str, conv[a:b])) for a, b in cuts], pa.string())], ["depth", "a", "b", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        row = lambda out: pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*[k for k, _ in out])) or [[]] * 3), pa.array([h for _, h in out], pa.string())], ["depth", "a", "b", "ends_sha256"])
        for batch in batches:
            for depth, a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if (depth, a, b) != key:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) >= 1 << 14:
                yield row(out)
                out = []
        if key is not None:
            out.append((key, state.hexdigest()))
        yield row(out)

    pieces = rows.mapInArrow(join, "depth long, a long, b long, first long, ids string")
    dealt = pieces.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "first")
    return dealt.mapInArrow(digest, "depth long, a long, b long, ends_sha256 string")


def trie(turns: DataFrame, borrow: Column | None = None, base: Column | None = None, most: int = 8, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", strip: int = STRIP, per_range: int = ROWS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of first turns (role, text; null as empty), the root that of none; its members are the
    conversations that begin with it, conv_id the smallest. n_leaves and saved_tokens (members but one times the bytes of the
    node's text) are of its whole subtree, ends_sha256 of the ids that end there. Turns are in the order of turn, role and text,
    nulls first; repeated rows are turns of their own. Rows without a conversation id belong to none. With `borrow` and `base`
    (columns over `conv`) conversations are rebuilt first: see `rebuilt`. An empty table has no conversation and so no node.
    Other columns are not read."""
    with workspace(turns.sparkSession):
        said = settle(numbered(turns, conv_col, turn_col, role_col, text_col), "turns")
        convs = settle(said.select("conv").distinct(), "convs")
        if borrow is not None:
            said = rebuilt(said, borrow, base, most)
        cut = settle(strips(said, strip), "strips")
        rows = cut.groupBy("s", "a", "b", "turns").agg(F.min("conv").alias("conv"), F.count("*").alias("n"), F.min("end_a").alias("end_a"), F.min("end_b").alias("end_b"))
        rows = settle(rows, "rows")
        none = {c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
        later = rows.where("s > 0")
        if later.isEmpty():
            hung = rows.withColumns(none)
        else:
            # Of each border the nodes right below it; of its own strip only, so nothing hangs below yet. A row whose
            # conversations go on is no leaf: it hangs one child that counts nothing.
            goes = later.select(F.col("a").alias("end_a"), F.col("b").alias("end_b")).distinct().withColumn("goes", F.lit(1).cast("long"))
            alone = settle(later.join(goes, ["end_a", "end_b"], "left").withColumns(none | {"children": F.coalesce("goes", F.lit(0))}).drop("goes"), "alone")
            inside, edge = _nodes(alone, alone.count(), strip, per_range)
            under = inside.unionByName(edge).where((F.col("depth") - 1) % strip == 0).groupBy("up_a", "up_b").agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).withColumnsRenamed({"up_a": "a", "up_b": "b"})
            above = rows.join(under.select(F.col("a").alias("end_a"), F.col("b").alias("end_b")), ["end_a", "end_b"]).select(F.col("end_a").alias("a"), F.col("end_b").alias("b"), F.when(F.col("s") > 0, F.col("a")).alias("up_a"), F.when(F.col("s") > 0, F.col("b")).alias("up_b"))
            full = _under(under.join(above, PREFIX)).withColumnsRenamed({"a": "end_a", "b": "end_b"})
            hung = settle(rows.join(full, ["end_a", "end_b"], "left").withColumns({c: F.coalesce(c, z) for c, z in none.items()}), "hung")
        inside, edge = _nodes(hung, hung.count(), strip, per_range)

        all_of = convs.agg(F.min("conv"), F.count("*")).first()
        top = inside.unionByName(edge).where("depth = 1").agg(F.count("*"), F.coalesce(F.sum("leaves"), F.lit(1)), F.coalesce(F.sum("saved"), F.lit(0))).first()
        whole = [(0, 0, 0, all_of[0], None, all_of[1], *top)] if all_of[1] else []
        root = turns.sparkSession.createDataFrame(whole, "depth long, a long, b long, conv long, up_conv long, n long, children long, leaves long, saved long")

        # Parents: inside a range they are known; else they are border nodes, ends of strips or the root.
        upper = edge.select("depth", "a", "b", "conv").unionByName(inside.where(F.col("depth") % strip == 0).select("depth", "a", "b", "conv")).unionByName(root.select("depth", "a", "b", "conv"))
        upper = broadcast_if_small(upper.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("from")))
        nodes = inside.unionByName(edge)
        adrift = nodes.where("up_conv is null").join(upper, ["depth", "up_a", "up_b"]).withColumn("up_conv", F.col("from")).select(*nodes.columns)
        columns = ["depth", "a", "b", "conv", "up_conv", "n", "children", "leaves", "saved"]
        nodes = nodes.where("up_conv is not null").select(*columns).unionByName(adrift.select(*columns)).unionByName(root.select(*columns))

        last = cut.where("last").select(F.col("upto").alias("depth"), F.col("end_a").alias("a"), F.col("end_b").alias("b"), "conv")
        bare = convs.join(last.select("conv"), "conv", "left_anti").select(*[F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b")], "conv")
        out = nodes.join(ends(last.unionByName(bare)), ["depth", "a", "b"], "left")
        nothing = F.lit(hashlib.sha256(b"").hexdigest())
        return settle(out.select(F.col("conv").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256")), "trie", keep=True)
