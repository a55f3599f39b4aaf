"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors: the graph of nearest neighbours, cut into parts of equal
size by recursive bisection (each cut along the graph's slowest diffusion), and a small
network that learns which parts a vector's neighbours lie in. Every vector is indexed in its
most probable part; a query goes to several most probable ones, where all candidates are
ranked by the exact measure. How many is read off a part of the sample that the fit doesn't
see, so that the expected recall is RECALL: few for clustered vectors, most parts for vectors
without structure.

A part that is still large is fitted and cut again in the same way, by a task of its own, so
parts grow in number with the table and not in size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.llm._cluster import settle, workspace

#: Most vectors that the cut of a part, or of the table, is fitted on (the first by hash), and neighbours in their graph.
SAMPLE, NEIGHBOURS = 6000, 20
#: Vectors of a part that a cut aims at, seen vectors that it needs for each, the expected recall and the vectors kept to measure it.
PER_PART, SEEN, RECALL, UNSEEN = 400, 32, 0.94, 1500
#: Vectors from which on a part is cut again, the recall of that, and most times.
LARGE, RECALL_AGAIN, LEVELS = 16_384, 0.98, 4
#: Vectors and queries of one group; queries that are ranked at a time; pairs whose exact score is taken at a time.
BLOCK, QUERIES, QUERY_BLOCK, PAIRS = 4096, 16_384, 1024, 1 << 17
HIDDEN, EPOCHS = 128, 60


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For each row the k others of largest inner product."""
    out = np.zeros((len(x), min(k, max(len(x) - 1, 0))), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]] if out.shape[1] else 0
    return out


def bisect(u: np.ndarray, v: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Two halves of n nodes with few edges (u, v) between them: the median of a damped Fiedler vector, then swaps."""
    degree = np.bincount(u, minlength=n) + np.bincount(v, minlength=n) + 1e-9
    f = np.random.default_rng(seed).normal(size=n)
    for _ in range(80):
        f -= (f * degree).sum() / degree.sum()
        f = 0.5 * f + 0.5 * (np.bincount(u, f[v], n) + np.bincount(v, f[u], n)) / degree
        f /= np.abs(f).max() + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(f, kind="stable")[n // 2 :]] = True
    for _ in range(10):  # swap pairs of nodes that both gain
        sign = np.where(side, 1.0, -1.0)
        gain = -(np.bincount(u, sign[v], n) + np.bincount(v, sign[u], n)) * sign
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        most = min(len(left), len(right))
        swap = np.flatnonzero(gain[left[:most]] + gain[right[:most]] > 0)[: max(1, n // 50)]
        if not len(swap):
            break
        side[left[swap]], side[right[swap]] = True, False
    return side


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """A part of each node, in sizes that differ by halving only; parts is a power of two."""
    n = len(graph)
    part, u, v = np.zeros(n, np.int64), np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    done = 1
    while done < parts:
        half = np.zeros(n, np.int64)
        for p in range(done):
            own = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            inside = (place[u] >= 0) & (place[v] >= 0)
            half[own] = bisect(place[u[inside]], place[v[inside]], len(own), p)
        part, done = 2 * part + half, 2 * done
    return part


@dataclass
class Router:
    """A network of one hidden layer: vector to log probabilities of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def best(self, x: np.ndarray, m: int) -> np.ndarray:
        """The m most probable parts, the most probable first."""
        s = self.logits(x)
        return np.argsort(-s, axis=1, kind="stable")[:, :m]


def fit_router(x: np.ndarray, target: np.ndarray, seed: int = 3) -> Router:
    """Cross entropy against each vector's distribution of its neighbours' parts, by Adam."""
    rng = np.random.default_rng(seed)
    n, d, parts = len(x), x.shape[1], target.shape[1]
    scale = 1 / max(float(np.sqrt((x * x).sum(axis=1).mean() / d)), 1e-30)
    theta = [rng.normal(size=(d, HIDDEN)) * np.sqrt(2 / d), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
    m, v, k = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta], 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for a in range(0, n, 256):
            i = order[a : a + 256]
            z = x[i] * scale @ theta[0] + theta[1]
            h = np.maximum(z, 0)
            s = h @ theta[2] + theta[3]
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            e = (p - target[i]) / len(i)
            back = (e @ theta[2].T) * (z > 0)
            k += 1
            for j, g in enumerate(((x[i] * scale).T @ back, back.sum(axis=0), h.T @ e, e.sum(axis=0))):
                g = g + 1e-5 * theta[j]
                m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.999 * v[j] + 0.001 * g * g
                theta[j] = theta[j] - 0.003 * (m[j] / (1 - 0.9**k)) / (np.sqrt(v[j] / (1 - 0.999**k)) + 1e-8)
    return Router(*theta, scale)


def fit(sample: np.ndarray, rows: int, recall: float = RECALL, least: int = NEIGHBOURS + 1) -> tuple[Router, int]:
    """A router over parts (two at least) for `rows` vectors and how many parts to probe, from a sample of one or more: enough
    for the recall, and for the smallest parts to hold `least` vectors.

    Of fewer than four vectors none can be spared to measure on, so the seen ones are."""
    unseen = sample[len(sample) - min(UNSEEN, len(sample) // 4) :]
    seen = sample[: len(sample) - len(unseen)]
    unseen = unseen if len(unseen) else seen
    parts = 2
    while rows / parts > PER_PART and len(seen) / (2 * parts) >= SEEN:
        parts *= 2
    graph = neighbour_graph(seen, NEIGHBOURS)
    part = balanced_parts(graph, parts)
    target = np.zeros((len(seen), parts))
    np.add.at(target, (np.arange(len(seen))[:, None], part[graph]), 0.7 / max(graph.shape[1], 1))
    target[np.arange(len(seen)), part] += 0.3
    router = fit_router(seen, target)
    near = np.argsort(-(unseen @ seen.T), axis=1)[:, :NEIGHBOURS]
    place = np.argsort(router.best(unseen, parts), axis=1)
    needed = np.take_along_axis(place, router.best(seen, 1)[:, 0][near], axis=1)
    probes = int(np.quantile(needed, min(1.0, recall + 0.5 / np.sqrt(len(unseen))), method="higher")) + 1
    held = np.cumsum(np.sort(np.bincount(router.best(seen, 1)[:, 0], minlength=parts))) * rows / len(seen)
    return router, min(parts, max(probes, int(np.searchsorted(held, least)) + 1))


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in one fixed order."""
    return (q * c).sum(axis=-1)


def nearest(q: np.ndarray, x: np.ndarray, least: np.ndarray, k: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row of x, score) of the k rows of largest inner product for each query, ties to the smaller `least`; only of
    the rows that the query is allowed.

    A fast product finds all rows that may be among them, by a bound of its error; these are ranked exactly."""
    s, m = q @ x.T, min(len(x), k)
    if allowed is not None:
        s[~allowed] = -np.inf
    error = 4 * q.shape[1] * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1).max(initial=0))
    at, to = np.nonzero((s >= (np.partition(s, len(x) - m, axis=1)[:, len(x) - m] - error)[:, None]) & (s > -np.inf))
    score = np.concatenate([np.zeros(0), *(_exact(q[at[i : i + PAIRS]], x[to[i : i + PAIRS]]) for i in range(0, len(at), PAIRS))])
    order = np.lexsort((least[to], -score, at))
    at, to, score = at[order], to[order], score[order]
    best = np.arange(len(at)) - np.searchsorted(at, at) < k
    return at[best], to[best], score[best]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, none of them null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


#: Names of a part's own parts are consecutive numbers, above those of parts that stay: at most so many each.
CHILDREN = 1024


def _cut_again(index: DataFrame, recall: float) -> DataFrame:
    """part, model, probes of each part of more than LARGE vectors, each fitted by one task on SAMPLE vectors at most."""
    large = index.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > LARGE)
    first = F.row_number().over(Window.partitionBy("part").orderBy("h1", "h2"))
    sample = index.join(large, "part").select("part", "n", "v", first.alias("nth")).where(F.col("nth") <= SAMPLE)

    def run(t: pa.Table) -> pa.Table:
        router, probes = fit(_matrix(t.sort_by("nth")["v"]), t["n"][0].as_py(), recall)
        return pa.table({"part": t["part"][:1], "model": pa.array([pickle.dumps(router)], pa.binary()), "probes": pa.array([probes], pa.int32())})

    return sample.groupBy("part").applyInArrow(run, "part long, model binary, probes int")


def _descend(rows: DataFrame, models: DataFrame, own: bool) -> DataFrame:
    """rows with their parts' own parts: the most probable one, or as many as the model says. Other parts stay.

    A group is BLOCK rows of a part at most, and the part's model."""
    blocks = rows.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).join(models.select("part"), "part", "left_semi")
    there = rows.join(blocks, "part").withColumn("block", F.pmod("h1", F.col("blocks")).cast("int")).drop("blocks")
    sent = models.join(blocks, "part").select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "model", "probes")
    names = rows.columns
    schema = rows.schema

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return left.select(names)
        router, m = pickle.loads(right["model"][0].as_py()), 1 if own else right["probes"][0].as_py()
        best = router.best(_matrix(left["v"]), m)
        at = pa.array(np.repeat(np.arange(len(left)), best.shape[1]))
        part = (np.repeat(left["part"].to_numpy(), best.shape[1]) + 1) * CHILDREN + best.ravel()
        out = left.select(names).take(at)
        return out.set_column(names.index("part"), "part", pa.array(part))

    moved = there.groupBy("part", "block").cogroup(sent.groupBy("part", "block")).applyInArrow(run, schema)
    return moved.unionByName(rows.join(models.select("part"), "part", "left_anti").select(*names))


def usable(vector: str):
    """Not null or zero, and all components finite."""
    v = F.col(vector)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """query_id, rank, id_col, score: for each row whose id is divisible by `every` its k nearest among the other rows.

    Nearness is the largest inner product, in double precision, ties to smaller ids. Vectors that are null, zero or
    hold null or non-finite components take no part, nor do null ids; repeated rows count once. Vectors are compared with
    those of their own length: each length is searched by itself, with parts of its own. Other columns are not read, whatever
    their names. An empty table gives an empty result.

    Equal vectors are one class: of its members only the k + 1 smallest ids can be in a result, so a vector that a
    third of the rows share costs as much as any other."""
    v = vectors.where(usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(2), "v")})
    kind = f"query_id long, rank int, `{id_col}` long, score double"
    with workspace(vectors.sparkSession):
        v = settle(v, "vectors")
        out = vectors.sparkSession.createDataFrame([], kind)
        for width in sorted(r.d for r in v.select(F.size("v").alias("d")).distinct().collect()):
            out = out.unionByName(_search(v.where(F.size("v") == width), width, k, every, id_col, recall))
        return settle(out, "nearest", keep=True)


def _search(v: DataFrame, length: int, k: int, every: int, id_col: str, recall: float) -> DataFrame:
    """`search` over settled rows (id, v, h1, h2) of one length."""
    small = v.select("id", "h1", "h2").distinct().withColumn("nth", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))).where(F.col("nth") <= k + 1)
    members = settle(small.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids")), "members")
    classes = settle(v.groupBy("h1", "h2").agg(F.any_value("v").alias("v"), F.min("id").alias("least")), "classes")
    asked = settle(v.where(F.col("id") % every == 0).select("id", "h1", "h2").distinct(), "asked")
    rows = classes.count()
    sample = np.array([r.v for r in classes.orderBy("h1", "h2").limit(SAMPLE).select("v").collect()]).reshape(-1, length)
    router, probes = fit(sample, rows, recall, k + 1)

    def route(m: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    x = _matrix(batch.column(2))
                    best = router.best(x, m)
                    at = pa.array(np.repeat(np.arange(len(x)), best.shape[1]))
                    yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns), pa.array(best.ravel())], ["h1", "h2", "v", "least", "part"])

        return run

    form = "h1 long, h2 long, v array<double>, least long, part long"
    columns = ["h1", "h2", "v", "least"]
    index = settle(classes.select(*columns).mapInArrow(route(1), form), "index")
    queries = classes.join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select(*columns).mapInArrow(route(probes), form)
    for _ in range(LEVELS):
        models = settle(_cut_again(index, RECALL_AGAIN), "models")
        if models.isEmpty():
            break
        index, queries = settle(_descend(index, models, True), "index"), settle(_descend(settle(queries, "queries"), models, False), "queries")

    # Bundles of neighbouring parts, of about BLOCK vectors: their blocks of candidates meet blocks of the queries that
    # probe any of their parts, once for each bundle and not for each part.
    width = max(1, BLOCK * index.select("part").distinct().count() // max(rows, 1))
    bundle = F.floor(F.col("part") / width).alias("bundle")
    index = index.select("*", bundle)
    queries = settle(queries.groupBy("h1", "h2", bundle).agg(F.collect_set("part").alias("parts"), F.any_value("v").alias("v")), "asking")
    sizes = lambda df, per, name: df.groupBy("bundle").agg(F.ceil(F.count("*") / per).cast("int").alias(name))
    grid = sizes(index, BLOCK, "blocks").join(sizes(queries, QUERIES, "turns"), "bundle")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    there = index.join(grid, "bundle").select("bundle", "part", F.pmod("h1", F.col("blocks")).cast("int").alias("block"), *columns, all_of("turns").alias("turn"))
    dealt = queries.join(grid, "bundle").select("bundle", "parts", F.pmod("h2", F.col("turns")).cast("int").alias("turn"), "h1", "h2", "v", all_of("blocks").alias("block"))
    keys = ["bundle", "block", "turn"]

    def ranked(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q1", "q2", "h1", "h2", "score"]
        out = [pa.table([pa.array([], pa.int64())] * 4 + [pa.array([], pa.float64())], names)]
        if len(left) and len(right):
            x, least, q = _matrix(right["v"]), right["least"].to_numpy(), _matrix(left["v"])
            known, part = np.unique(right["part"].to_numpy(), return_inverse=True)
            probed = np.zeros((len(q), len(known)), bool)
            lists = left["parts"].combine_chunks()
            wanted, of = lists.flatten().to_numpy(), np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy())
            place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            here = known[place] == wanted
            probed[of[here], place[here]] = True
            for a in range(0, len(q), QUERY_BLOCK):
                at, to, score = nearest(q[a : a + QUERY_BLOCK], x, least, k + 1, probed[a : a + QUERY_BLOCK][:, part])
                at, to = pa.array(at + a), pa.array(to)
                out.append(pa.table([left["h1"].take(at), left["h2"].take(at), right["h1"].take(to), right["h2"].take(to), pa.array(score)], names))
        return pa.concat_tables(out)

    near = dealt.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(ranked, "q1 long, q2 long, h1 long, h2 long, score double")
    top = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    near = near.join(members, ["h1", "h2"]).withColumn("least", F.col("ids")[0]).withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= k + 1)
    # k + 1 classes hold the k + 1 nearest members; the query itself is one of them at most.
    top = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "id")
    near = near.select("q1", "q2", "score", F.explode("ids").alias("id")).withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= k + 1)
    near = near.groupBy("q1", "q2").agg(F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))
    out = asked.withColumnRenamed("id", "query_id").join(near, [F.col("h1") == F.col("q1"), F.col("h2") == F.col("q2")])
    others = F.slice(F.filter("near", lambda x: x.id != F.col("query_id")), 1, k)
    return out.select("query_id", F.posexplode(others)).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").alias(id_col), F.col("col.score").alias("score"))
