"""Hard-negative mining by threshold joins.

Anchors meet blocks of candidates. Within a block, strips of dimensions run from the one of
most energy to the least. Strip by strip a row is left out of the inverted index once no
anchor can reach its threshold by the rest alone (norm of the row's suffix times that of
the anchor's). Partial scores accumulate over the indexed strips; a pair lives on while
its partial score and the product of the remaining norms reach the anchor's threshold; what
lives at the end gets the strips that the index lacks. Scores are sums of integers, so exact.

Thresholds start where statistics of all rows expect a few times the rows that a window
needs. Windows that don't fill meet the blocks again under a lower threshold, at last their
own lower end, so results are the exact first rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.llm._cluster import settle, workspace
from concordia.llm.learned_partitions import _matrix

#: Dimensions of a strip; anchors and candidates of one accumulator; the share of live pairs below which they go on one by one.
STRIP, ANCHORS, ROWS, SPARSE = 8, 256, 2048, 8
#: Candidates of a block: a 64th of a table's, within these bounds. Anchors that meet a block at a time.
BLOCK, CHUNK = (2048, 32_768), 16_384
#: Rows expected above the first threshold for each row that a window needs, and the factor of each lower one.
AHEAD, LOWER = 4, 64
#: Squared lengths from which on rows take no part: a hundred times a score must fit a long.
LONG = 2.0**55
_END = 2**62


def _suffix_norms(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Of each row the norms of what lies from each edge on, rounded up; the last is zero."""
    out = np.zeros((len(x), len(edges)))
    if x.shape[1]:
        square = np.add.reduceat(np.square(x.astype(float)), edges[:-1], axis=1)
        out[:, :-1] = np.sqrt(np.cumsum(square[:, ::-1], axis=1)[:, ::-1]) * (1 + 1e-9)
    return out


def reaching(q: np.ndarray, x: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, row, score) of all pairs of integer vectors with score >= least[anchor], some anchors and rows at a time."""
    d = x.shape[1]
    edges = np.unique(np.r_[np.arange(0, d, STRIP), d])
    order = np.argsort(-np.square(x.astype(float)).sum(axis=0), kind="stable")
    q, x = q[:, order], x[:, order]
    qn, xn = _suffix_norms(q, edges), _suffix_norms(x, edges)
    kind = np.float64 if qn[:, 0].max(initial=0) * xn[:, 0].max(initial=0) < 2**52 else np.int64  # sums are exact either way
    q, x, strips = q.astype(kind), x.astype(kind), len(edges) - 1
    alike = np.argsort(-least / np.maximum(qn[:, 0], 1e-9), kind="stable")  # anchors of like thresholds together
    for a in range(0, len(q), ANCHORS):
        qs = alike[a : a + ANCHORS]
        cover = (least[qs, None] / np.maximum(qn[qs], 1e-9)).min(axis=0)[:strips]
        indexed = np.logical_and.accumulate(xn[:, :strips] >= cover, axis=1).sum(axis=1)  # strips of each row in the index
        rows = np.argsort(-indexed, kind="stable")
        for b in range(0, len(x), ROWS):
            xs = rows[b : b + ROWS]
            yield from _reaching(q[qs], x[xs], qn[qs], xn[xs], indexed[xs], least[qs], edges, qs, xs)


def _reaching(q, x, qn, xn, indexed, least, edges, qs, xs):
    strips = len(edges) - 1
    score, done = np.zeros((len(q), len(x)), q.dtype), strips
    for j in range(strips):
        posted = int((indexed > j).sum())  # rows come with the most indexed strips first
        if posted:
            score[:, :posted] += q[:, edges[j] : edges[j + 1]] @ x[:posted, edges[j] : edges[j + 1]].T
        if j + 1 in (strips // 2, 3 * strips // 4, strips) or not posted:
            upto = np.minimum(indexed, j + 1)
            live = score + qn[:, upto] * xn[np.arange(len(x)), upto] >= least[:, None]
            if not posted or SPARSE * np.count_nonzero(live) < live.size:
                done = j + 1
                break
    else:
        if not strips:
            live = score >= least[:, None]
    a, b = np.nonzero(live)
    s, upto = score[a, b], np.minimum(indexed[b], done)
    for j in range(strips):
        rest = upto <= j
        if rest.any():
            s[rest] += (q[a[rest], edges[j] : edges[j + 1]] * x[b[rest], edges[j] : edges[j + 1]]).sum(axis=1)
            level = np.maximum(upto, j + 1)
            on = s + qn[a, level] * xn[b, level] >= least[a]
            a, b, s, upto = a[on], b[on], s[on], upto[on]
    on = s >= least[a]
    yield qs[a[on]], xs[b[on]], s[on].astype(np.int64)


def _firsts(keys: list[np.ndarray], k: int) -> np.ndarray:
    """Places of the first k of each group; keys: group columns, then two that order it (the second ascending, the first descending)."""
    *group, score, least = keys
    order = np.lexsort((least, -score, *group[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in group:
        new[1:] |= g[order][1:] != g[order][:-1]
    start = np.flatnonzero(new)
    nth = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[nth < k]


WINDOWS = "array<struct<w: int, low: long, high: long, at: double>>"
_FOUND = "q long, w int, id long, score long"


def _meet(asked: DataFrame, classes: DataFrame, same: bool, k: int) -> DataFrame:
    """q, w, id, score: the first k rows of each window among those of the same label (or of others) that reach its threshold.

    asked: q, id, d, label, v, wins. A group of the cogroup is one block and at most CHUNK anchors."""
    part = F.col("label") if same else F.lit(0).cast("long")
    x, a = classes.withColumn("part", part), asked.withColumn("part", part)
    per = F.least(F.lit(BLOCK[1]), F.greatest(F.lit(BLOCK[0]), F.ceil(F.col("n") / 64)))
    grid = x.groupBy("d", "part").agg(F.count("*").alias("n")).select("d", "part", F.ceil(F.col("n") / per).cast("int").alias("blocks"))
    grid = grid.join(a.groupBy("d", "part").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), ["d", "part"])
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = x.join(grid, ["d", "part"]).select("d", "part", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("block"), each("chunks").alias("chunk"), "label", "ids", "v")
    a = a.join(grid, ["d", "part"]).select("d", "part", each("blocks").alias("block"), F.pmod(F.xxhash64("q"), "chunks").cast("int").alias("chunk"), "q", "id", "label", "v", "wins")
    keys = ["d", "part", "block", "chunk"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, out = ["q", "w", "id", "score"], []
        if len(left) and len(right):
            number, own, label = (left[c].to_numpy() for c in ("q", "id", "label"))
            wins = left["wins"].to_pylist()
            most = max(map(len, wins))
            w, high, at = np.zeros((len(left), most), np.int32), np.full((len(left), most), -_END), np.full((len(left), most), np.inf)
            for i, row in enumerate(wins):
                for j, win in enumerate(row):
                    w[i, j], high[i, j], at[i, j] = win["w"], win["high"], win["at"]
            lists = right["ids"].combine_chunks()
            count, ids, theirs = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy(), right["label"].to_numpy()
            first = np.cumsum(count) - count
            for a, b, s in reaching(_matrix(left["v"]), _matrix(right["v"]), at.min(axis=1)):
                if not same:
                    on = label[a] != theirs[b]
                    a, b, s = a[on], b[on], s[on]
                for j in range(most):
                    on = (s >= at[a, j]) & (s <= high[a, j])
                    c, to, score = a[on], b[on], s[on]
                    on = _firsts([c, score, ids[first[to]]], k + 1)  # k + 1 classes hold the first k other rows
                    c, to, score = c[on], to[on], score[on]
                    times = count[to]
                    place = np.repeat(first[to], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    c, score, to = np.repeat(c, times), np.repeat(score, times), ids[place]
                    on = np.flatnonzero(to != own[c])
                    on = on[_firsts([c[on], score[on], to[on]], k)]
                    out.append((number[c[on]], w[c[on], j], to[on], score[on]))
        if not out:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], names)
        q, w, to, score = map(np.concatenate, zip(*out))
        on = _firsts([q, w, score, to], k)
        return pa.table([q[on], w[on], to[on], score[on]], names)

    near = a.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInArrow(run, _FOUND)
    return near.withColumn("nth", F.row_number().over(Window.partitionBy("q", "w").orderBy(F.desc("score"), "id"))).where(F.col("nth") <= k)


def _threshold(v: list[int], mean: list[float], square: list[float], rows: int, low: int, high: int, target: float) -> float:
    """Where about `target` of the rows are expected from there up to high; low once that is an eighth of them."""
    if 8 * target >= rows:
        return float(low)
    middle = sum(a * b for a, b in zip(v, mean))
    spread = sum(a * a * max(s - b * b, 0.0) for a, b, s in zip(v, mean, square)) ** 0.5
    if not spread:
        return float(low)
    normal = NormalDist(middle, spread)
    share = target / rows + (1 - normal.cdf(high) if high < _END else 0.0)
    return max(float(low), normal.inv_cdf(1 - share)) if share < 1 else float(low)


def _fill(anchors: DataFrame, windows: DataFrame, classes: DataFrame, stats: DataFrame, same: bool, k: int) -> DataFrame:
    """q, w, id, score, nth of each window (q, w, low, high): its first k rows, by lower thresholds from round to round."""
    kept, target = [], float(AHEAD * k)
    while True:

        def opened(batches: Iterator[pa.RecordBatch], target=target) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                wins = [[x | {"at": _threshold(r["v"], r["mean"], r["square"], r["n"], x["low"], x["high"], target)} for x in r["wins"]] for r in batch.select(["v", "mean", "square", "n", "wins"]).to_pylist()]
                kind = pa.list_(pa.struct([("w", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("at", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*batch.select(["q", "id", "d", "label", "v"]).columns, pa.array(wins, kind)], ["q", "id", "d", "label", "v", "wins"])

        wins = windows.groupBy("q").agg(F.collect_list(F.struct("w", "low", "high")).alias("wins"))
        asked = anchors.join(wins, "q").join(stats, "d").mapInArrow(opened, f"q long, id long, d int, label long, v array<long>, wins {WINDOWS}")
        asked = settle(asked, "asked")
        found = settle(_meet(asked, classes, same, k), "found")
        state = asked.select("q", F.inline("wins")).join(found.groupBy("q", "w").agg(F.count("*").alias("n")), ["q", "w"], "left")
        short = settle(state.where(~((F.coalesce("n", F.lit(0)) >= k) | (F.col("at") <= F.col("low")))).select("q", "w", "low", "high"), "short")
        if short.isEmpty():
            kept.append(found)
            break
        kept.append(found.join(short.select("q", "w"), ["q", "w"], "left_anti"))
        windows, target = short, target * LOWER
    out = kept[0]
    for df in kept[1:]:
        out = out.unionByName(df)
    return settle(out, "filled")


def mine(vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, every: int = 100, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Each component x counts as floor(scale * x); a row's score with an anchor is their integer inner product. Anchors are
    rows whose id is divisible by `every`. Of each, the positives are the first rows of its label (highest score, ties to the
    smaller id), the negatives of each positive the first rows of other labels whose score is `low` to `high` percent of the
    positive's. All rows are searched; where there are fewer, all are returned.

    Rows with a null id, label or vector, or a null or non-finite component take no part, nor do those of a squared
    length of 2^55 or more in scaled units. Vectors meet those of their own length only. Repeated rows count once; different
    rows of one id are rows of their own, but never partners of each other. An empty table gives an empty result; other
    columns are not read.

    Equal vectors of one label are one class, of which the first ids suffice, so a vector that a third of the rows share
    costs as much as any other. A label of any size is dealt to blocks."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    raw = F.col(vector_col)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & raw.isNotNull() & ~F.exists(raw, bad))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(raw, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    rows = rows.where(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) < LONG).withColumn("d", F.size("v"))
    with workspace(vectors.sparkSession):
        rows = settle(rows, "rows")
        most = max(positives, negatives) + 1
        nth = F.dense_rank().over(Window.partitionBy("d", "label", "v").orderBy("id"))
        firsts = rows.withColumn("nth", nth).where(F.col("nth") <= most)
        classes = firsts.groupBy("d", "label", "v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
        classes = settle(classes.withColumn("key", F.monotonically_increasing_id()), "classes")
        parts = rows.select("d", F.posexplode("v").alias("pos", "x")).groupBy("d", "pos").agg(F.avg("x").alias("mean"), F.avg(F.col("x").cast("double") * F.col("x")).alias("square"))
        sized = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("pos", c))), lambda s: s[c]).alias(c)
        none = F.array().cast("array<double>")
        stats = rows.select("d").distinct().join(parts.groupBy("d").agg(sized("mean"), sized("square")), "d", "left")
        stats = settle(stats.select("d", *[F.coalesce(c, none).alias(c) for c in ("mean", "square")]), "stats")
        anchors = settle(rows.where(F.col("id") % every == 0).distinct().withColumn("q", F.monotonically_increasing_id()), "anchors")

        own = anchors.join(rows.groupBy("d", "label").agg(F.count("*").alias("n")), ["d", "label"])
        whole = anchors.select("q", F.lit(0).alias("w"), F.lit(-_END).alias("low"), F.lit(_END).alias("high"))
        found = _fill(own, whole, classes, stats, True, positives)
        found = found.join(anchors.select("q", F.col("id").alias("anchor_id")), "q").select("q", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))

        floor = lambda p: F.expr(f"(positive_score * {p} - pmod(positive_score * {p}, 100)) div 100")
        bounds = found.select("q", "positive_score").distinct().select("q", F.row_number().over(Window.partitionBy("q").orderBy("positive_score")).alias("w"), "positive_score", (-floor(-low)).alias("low"), floor(high).alias("high"))
        bounds = settle(bounds.where("low <= high"), "bounds")
        all_of = anchors.join(rows.groupBy("d").agg(F.count("*").alias("n")), "d")
        hard = _fill(all_of, bounds.drop("positive_score"), classes, stats, False, negatives)
        out = found.join(bounds.select("q", "w", "positive_score"), ["q", "positive_score"]).join(hard, ["q", "w"])
        return settle(out.select("anchor_id", "positive_id", F.col("nth").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "mined", keep=True)
