"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

Lines (those with a word) are described by shares of byte classes, repeats and shape, their
own and their neighbours'. The chain learns from documents whose lines all carry the
document's label. Forward-backward marginals, weighted by line length, give a document's
share of good text, which a logistic curve fitted on the same documents turns into a score.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.llm import _text as X
from concordia.llm._cluster import settle, workspace

#: Most labelled documents that the fit uses (the first by hash of id), and most lines of these together: documents
#: beyond are left out of the fit, whole. A training chain is a whole document.
MOST_LABELLED, MOST_LINES = 4000, 400_000
#: Lines of a long chain that are worked on as one block, at least.
BLOCK = 64
FOLDS, THRESHOLD = 5, 0.3
STEPS, MEMORY, TOLERANCE, DECAY = 60, 10, 1e-5, 1e-4

# Byte classes: 0 white space, 1 A-Z, 2 other letters, 3 digits, 4 symbols, 5 !, 6 |, 7 other punctuation.
_CLASS = np.full(256, 2, np.int64)
_CLASS[:0x80] = 7
_CLASS[X.SPACE] = 0
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 1, 2, 3
_CLASS[list(b"#*$%&<>")], _CLASS[ord("!")], _CLASS[ord("|")] = 4, 5, 6
WIDTH = 18


@dataclass
class Lines:
    own: np.ndarray  # features of each line
    length: np.ndarray
    first: np.ndarray  # of each document its first line's place, and last the number of lines

    def linked(self) -> np.ndarray:
        """Of each line whether the next one belongs to the same document."""
        out = np.ones(max(len(self.own) - 1, 0), bool)
        out[self.first[(self.first > 0) & (self.first < len(self.own))] - 1] = False
        return out

    def odds(self, weights: np.ndarray) -> np.ndarray:
        """Each line's own log odds: its features, those of the line before and of the line after, by three sets of weights."""
        mine, before, after = (self.own @ w for w in weights.reshape(3, WIDTH).astype(self.own.dtype))
        linked = self.linked()
        mine[1:] += before[:-1] * linked
        mine[:-1] += after[1:] * linked
        return mine.astype(float)

    def slope(self, error: np.ndarray) -> np.ndarray:
        """The gradient of the weights from errors of the log odds."""
        linked = self.linked()
        before, after = np.zeros_like(error), np.zeros_like(error)
        before[:-1], after[1:] = error[1:] * linked, error[:-1] * linked
        return np.concatenate([e.astype(self.own.dtype) @ self.own for e in (error, before, after)]).astype(float)


def lines(s: X.Slice) -> Lines:
    w = X.words(s)
    breaks = np.flatnonzero(s.data == 10)
    begin = np.unique(np.concatenate([s.offsets[:-1], breaks + 1]))
    begin = begin[begin < len(s.data)]
    of_word = np.searchsorted(begin, w.start, side="right") - 1
    real, of_word = np.unique(of_word, return_inverse=True)
    end = np.append(begin[1:], len(s.data))[real]
    begin = begin[real]
    n = len(begin)
    doc = np.searchsorted(s.offsets[1:], begin, side="right")
    if not n:
        return Lines(np.zeros((0, WIDTH), np.float32), np.zeros(0), np.zeros(s.n + 1, np.int64))
    size = end - begin
    # Bytes of each class by line, from the places of the classes' bytes: nothing as long as the text times eight.
    kind = _CLASS[s.data]
    counts = np.zeros((n, 8), np.float32)
    for k in range(8):
        place = np.flatnonzero(kind == k)
        line = np.searchsorted(begin, place, side="right") - 1
        line = line[(line >= 0) & (place < end[line])]
        counts[:, k] = np.bincount(line, minlength=n)
    letters = np.maximum(counts[:, 1:].sum(axis=1), 1)
    share = counts[:, 1:] / letters[:, None]
    n_words = np.bincount(of_word, minlength=n)
    again = np.zeros(len(w.number), bool)
    again[1:] = (w.number[1:] == w.number[:-1]) & (w.doc[1:] == w.doc[:-1])
    covered = X.repeated(w.number, w.doc, 3)
    _, which, often = np.unique(doc * np.int64(n) + X.distinct(s.data, begin, end)[1], return_inverse=True, return_counts=True)
    head, tail = s.data[w.start[np.searchsorted(of_word, np.arange(n))]], s.data[w.end[np.searchsorted(of_word, np.arange(n), side="right") - 1] - 1]
    own = np.column_stack([
        np.ones(n), np.log1p(size) / 5, np.minimum(1, 4 * share), np.bincount(of_word, again, n) / n_words, np.bincount(of_word, covered, n) / n_words,
        letters / n_words / 10, often[which] > 1, (head >= 65) & (head <= 90), tail == 46, counts[:, [4, 5, 6]].sum(axis=1) > 0, counts[:, 3] > 0, n_words < 4,
    ])
    return Lines(own.astype(np.float32), size.astype(float), np.searchsorted(doc, np.arange(s.n + 1)))


def _steps(count: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """t and the chains (numbers) that have a line t, for t from 0 on."""
    order = np.argsort(-count, kind="stable")
    active = np.searchsorted(-count[order], -np.arange(1, int(count.max(initial=0)) + 1), side="right")
    for t, k in enumerate(active):
        yield t, order[:k]


def marginals(good: np.ndarray, first: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, expected transitions (2 x 2) and the log partition, over chains of lines.

    good: log odds of each line by itself; first: of each chain its first line, and last the number of lines;
    move: log weights of bad/good to bad/good. Chains are cut into blocks, whose messages are passed on exactly: all
    blocks go at once, line by line, so a chain of n lines takes about sqrt(n) steps."""
    chain_size = np.diff(first)
    longest = int(chain_size.max(initial=0))
    block = max(BLOCK, math.isqrt(longest))
    parts = -(-chain_size // block)
    chain = np.repeat(np.arange(len(chain_size)), parts)
    nth = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = first[:-1][chain] + nth * block
    count = np.minimum(chain_size[chain] - nth * block, block)
    emit = np.exp(np.column_stack([-np.abs(good) * (good > 0), -np.abs(good) * (good < 0)]))
    step = np.exp(move)

    # What comes in at the first line of each block: nothing before a chain's first, else the last block's message.
    into = np.ones((len(at), 2))
    later = np.flatnonzero(nth > 0)
    if len(later):
        through = np.zeros((len(at), 2, 2))  # from the state of a block's first line to that of its last
        for t, b in _steps(count):
            e = emit[at[b] + t][:, None, :]
            through[b] = np.eye(2) * e if t == 0 else (through[b] @ step) * e
            through[b] /= through[b].sum(axis=(1, 2), keepdims=True)
        for k in range(1, int(parts.max())):
            b = later[nth[later] == k]
            out = (into[b - 1][:, None, :] @ through[b - 1])[:, 0]
            into[b] = out / out.sum(axis=1, keepdims=True) @ step
    alpha, scale = np.zeros((len(good), 2)), np.ones(len(good))
    for t, b in _steps(count):
        i = at[b] + t
        a = (into[b] if t == 0 else alpha[i - 1] @ step) * emit[i]
        scale[i] = a.sum(axis=1)
        alpha[i] = a / scale[i][:, None]

    back = np.ones((len(at), 2))  # beta of each block's last line
    if len(later):
        for k in range(int(parts.max()) - 1, 0, -1):
            b = later[nth[later] == k]
            r = (through[b] @ back[b][:, :, None])[:, :, 0] @ step.T
            back[b - 1] = r / (alpha[at[b] - 1] * r).sum(axis=1, keepdims=True)
    beta = np.ones((len(good), 2))
    beta[at + count - 1] = back
    for t, b in reversed(list(_steps(np.maximum(count - 1, 0)))):
        i = at[b] + t
        beta[i] = (emit[i + 1] * beta[i + 1] / scale[i + 1][:, None]) @ step.T
    inner = np.ones(len(good), bool)
    inner[first[:-1][chain_size > 0]] = False
    i = np.flatnonzero(inner)
    expected = (alpha[i - 1].T @ (emit[i] * beta[i] / scale[i][:, None])) * step
    p = alpha * beta
    return p[:, 1] / np.maximum(p.sum(axis=1), 1e-300), expected, np.log(scale).sum() + np.maximum(good, 0).sum()


@dataclass
class Model:
    weights: np.ndarray
    move: np.ndarray
    slope: float
    shift: float

    def share(self, x: Lines) -> np.ndarray:
        """The length-weighted P(good) of each document; nan without lines."""
        p, _, _ = marginals(x.odds(self.weights), x.first, self.move)
        doc = np.repeat(np.arange(len(x.first) - 1), np.diff(x.first))
        with np.errstate(invalid="ignore"):
            return np.bincount(doc, p * x.length, len(x.first) - 1) / np.bincount(doc, x.length, len(x.first) - 1)

    def score(self, x: Lines) -> np.ndarray:
        """0 for documents without a line."""
        share = self.share(x)
        odds = np.log((share + 1e-4) / (1 - share + 1e-4))
        return np.where(np.isnan(share), 0.0, 1 / (1 + np.exp(-np.clip(self.slope * odds + self.shift, -50, 50))))


def least_by_lbfgs(f: Callable[[np.ndarray], tuple[float, np.ndarray]], theta: np.ndarray) -> np.ndarray:
    """Where a smooth convex function (value and slope) is least, by limited-memory BFGS with halved steps: at most STEPS
    steps, MEMORY pairs of which shape the next."""
    value, slope = f(theta)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, back = slope.copy(), []
        for s, g in reversed(moves):
            a = s @ way / (s @ g)
            back.append(a)
            way -= a * g
        if moves:
            s, g = moves[-1]
            way *= s @ g / (g @ g)
        else:
            way /= max(np.abs(way).sum(), 1e-12)
        for (s, g), a in zip(moves, reversed(back)):
            way += (a - g @ way / (s @ g)) * s
        size = 1.0
        while True:
            new = theta - size * way
            new_value, new_slope = f(new)
            if new_value <= value - 1e-4 * size * (way @ slope) or size < 1e-6:
                break
            size /= 2
        s, g = new - theta, new_slope - slope
        done = value - new_value < TOLERANCE * max(abs(value), 1e-3)
        theta, value, slope = new, new_value, new_slope
        if done:
            break
        if s @ g > 1e-12:
            moves = [*moves, (s, g)][-MEMORY:]
    return theta


def fit(x: Lines, label: np.ndarray) -> Model:
    """From lines of documents with labels 0 and 1; of one class or none, a model that scores 0.5."""
    weights, move = np.zeros(3 * WIDTH), np.zeros((2, 2))
    if len(label) == 0 or label.min() == label.max() or not len(x.own):
        return Model(weights, move, 0.0, 0.0)
    doc = np.repeat(np.arange(len(label)), np.diff(x.first))
    y = label[doc].astype(float)
    inner = np.ones(len(y), bool)
    inner[x.first[x.first < len(y)]] = False  # lines with a line before them in their document
    seen = np.array([[(inner & (y == 0)).sum(), 0], [0, (inner & (y == 1)).sum()]], float)

    def value_and_slope(theta: np.ndarray) -> tuple[float, np.ndarray]:
        """Of the penalised mean negative log likelihood of a line."""
        odds = x.odds(theta[:-4])
        p, expected, log_partition = marginals(odds, x.first, theta[-4:].reshape(2, 2))
        value = (log_partition - odds @ y - (seen.ravel() @ theta[-4:])) / len(y) + DECAY / 2 * theta @ theta
        return value, DECAY * theta - np.concatenate([x.slope(y - p), (seen - expected).ravel()]) / len(y)

    theta = least_by_lbfgs(value_and_slope, np.concatenate([weights, move.ravel()]))
    model = Model(theta[:-4], theta[-4:].reshape(2, 2), 1.0, 0.0)
    share = model.share(x)
    has = ~np.isnan(share)
    odds, y = np.log((share[has] + 1e-4) / (1 - share[has] + 1e-4)), label[has].astype(float)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic curve, with a little ridge
        q = 1 / (1 + np.exp(-np.clip(a * odds + b, -30, 30)))
        r = q * (1 - q)
        h = np.array([[(r * odds * odds).sum() + 1, (r * odds).sum()], [(r * odds).sum(), r.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [((y - q) * odds).sum() - (a - 1), (y - q).sum()])
        a, b = a + np.clip(da, -1, 1), b + np.clip(db, -1, 1)
    # The threshold is given: move the curve so that it is where the two kinds of error are fewest.
    value = np.sort(a * odds + b)
    marks = (value[1:] + value[:-1]) / 2
    order = np.argsort(a * odds + b)
    wrong = np.cumsum(y[order])[:-1] + (1 - y)[order].sum() - np.cumsum((1 - y)[order])[:-1]
    best = np.flatnonzero(wrong == wrong.min())
    cut_at = marks[best[len(best) // 2]]
    return Model(model.weights, model.move, float(a), float(b + np.log(THRESHOLD / (1 - THRESHOLD)) - cut_at))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED, most_lines: int = MOST_LINES) -> Model:
    """Fits on at most `most` labelled documents outside the held-out fold, whose lines are at most `most_lines` together.

    Executors compute the lines' features; one task fits on those that the two bounds leave, in the order of a hash of the
    id, and the driver gets the model alone. Labels other than 0 and 1 and null ids are not used; of an
    empty table, or one class, comes a model that scores 0.5."""
    with workspace(docs.sparkSession):
        known = labels.where(~held_out(F.col(id_col)) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        known = settle(known.orderBy(F.xxhash64("id"), "id", "label").limit(most), "labelled")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, s in X.slices(batch.column(1)):
                    x = lines(s)
                    rows = [(b - a, x.own[a:b].tobytes(), x.length[a:b].tobytes()) for a, b in zip(x.first[:-1], x.first[1:])]
                    yield pa.RecordBatch.from_arrays([batch.column(2).slice(at, s.n), batch.column(3).slice(at, s.n), *(pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary())))], ["nth", "label", "n", "features", "length"])

        sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
        sample = sample.select("id", "text", F.xxhash64("id", "text").alias("nth"), "label")
        rows = settle(sample.mapInArrow(run, "nth long, label int, n long, features binary, length binary"), "lines")
        upto = F.sum("n").over(Window.orderBy("nth", "label", "n").rowsBetween(Window.unboundedPreceding, 0))
        sample = rows.orderBy("nth", "label", "n").limit(most).withColumn("upto", upto).where(F.col("upto") <= most_lines)

        def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = list(batches)  # one task has the whole bounded sample
            if not sum(map(len, got)):
                return
            table = pa.Table.from_batches(got)
            own = [np.frombuffer(f, np.float32).reshape(-1, WIDTH) for f in table["features"].to_pylist()]
            x = Lines(np.concatenate([np.zeros((0, WIDTH), np.float32), *own]), np.concatenate([np.zeros(0), *(np.frombuffer(c) for c in table["length"].to_pylist())]), np.cumsum([0, *map(len, own)]))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(x, table["label"].to_numpy().astype(np.int64)))], pa.binary())], ["model"])

        found = sample.select("label", "features", "length").mapInArrow(fit_all, "model binary").collect()
        return pickle.loads(found[0].model) if found else fit(Lines(np.zeros((0, WIDTH), np.float32), np.zeros(0), np.zeros(1, np.int64)), np.zeros(0, np.int64))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted (1 from the threshold on).

    Only the text is scored; null, empty and blank texts get 0. Repeated rows are scored one by one. A null id is
    not held out. An empty table gives an empty result."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, s in X.slices(batch.column(1)):
                score = model.score(lines(s))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, s.n), batch.column(2).slice(at, s.n), pa.array(score), pa.array((score >= threshold).astype(np.int32))], [id_col, "held_out", "score", "predicted"])

    ready = docs.select(F.col(id_col), F.col(text_col), held_out(F.col(id_col)).alias("_held"))
    return ready.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score the threshold or more; nothing is shuffled.

    Null, empty and blank texts score 0 and go. Repeated rows and ids are judged row by row. An empty table stays empty;
    columns named as the results stay as they are."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.zeros(0, bool), *(model.score(lines(s)) >= threshold for _, s in X.slices(batch.column(place)))]
            yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
