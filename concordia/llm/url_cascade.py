"""URL filters: a Bloom filter cascade over the candidate keys of a corpus.

A rule is a host and a path prefix with a verdict. A url's candidate keys are its host
suffixes joined to its path prefixes, in the shapes (labels, path length) that some rule
has. Level 1 of the cascade encodes the listed keys; level 2 those keys of the corpus that
level 1 takes for listed and that aren't; level 3 the listed keys that level 2 takes for
such; and so on until a level errs on none. A key of that universe is listed exactly if the
first level that rejects it is an even one. The lookup needs no join: tasks get the filters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.llm._cluster import settle, workspace
from concordia.llm._text import mix

#: Most bits of the levels that tasks hold at a time (64 MB); a larger list is cut into ranges of keys, looked up by turns.
MOST_BITS = 1 << 29
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty if the url is null or has no ://."""
    host = F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


@dataclass
class Level:
    bits: np.ndarray
    size: int
    hashes: int
    salt: int

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        a, b = mix(h1 ^ np.uint64(self.salt)), mix(h2 + np.uint64(self.salt)) | np.uint64(1)
        return (a[None, :] + np.arange(self.hashes, dtype=np.uint64)[:, None] * b[None, :]) % np.uint64(self.size)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(h1, h2)
        return ((self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def level(keys: DataFrame, n: int, p: float, number: int) -> Level:
    """A Bloom filter of keys (h1, h2): tasks set bits, words are combined by `bit_or`, the driver gets them a batch at a time."""
    hashes = max(1, round(-math.log2(p)))
    size = max(64, math.ceil(n * hashes / math.log(2)))
    empty = Level(np.zeros(0, np.uint64), size, hashes, int(mix(np.array([number], np.uint64))[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = empty.places(*(c.to_numpy().view(np.uint64) for c in batch.columns)).ravel()
            word, which = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, which, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy().tobytes()], pa.binary()) for c in batch.columns], ["word", "bits"])

    bits = np.zeros(-(-size // 64), np.uint64)
    words = keys.select("h1", "h2").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    for r in words.mapInArrow(pack, "word binary, bits binary").toLocalIterator():
        bits[np.frombuffer(r.word, np.int64)] = np.frombuffer(r.bits, np.uint64)
    return Level(bits, size, hashes, empty.salt)


def hashed(key: Column) -> tuple[Column, Column]:
    """128 bits, so that different keys don't meet."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys of the universe are listed: the parity of the first level that rejects them."""
    out, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
    for i, x in enumerate(levels):
        if not len(open_):
            break
        yes = x.has(h1[open_], h2[open_])
        open_ = open_[yes]
        out[open_] = i % 2 == 0  # so far; a later level may turn it
    return out


def _error(n: int, universe_rows: int) -> float:
    """The share of errors that the first level of n keys may have."""
    return min(0.5, max(2.0**-30, n / (math.sqrt(2) * max(universe_rows, 1))))


def ranges_for(n: int, universe_rows: int) -> int:
    """In how many ranges n keys are looked up, so that the levels of each stay below MOST_BITS."""
    return max(1, math.ceil(n * -math.log2(_error(n, universe_rows)) / math.log(2) * 2 / MOST_BITS)) if n else 1


def build(keys: DataFrame, universe: DataFrame, universe_rows: int) -> list[Level]:
    """The cascade of `keys` (h1, h2, distinct) over `universe` (h1, h2; may repeat and hold keys). Neither side has nulls; without
    keys there is no level, and an empty universe gives one level."""
    n = keys.count()
    if not n:
        return []
    first = level(keys, n, _error(n, universe_rows), 1)

    def errs(x: Level, among: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(x.has(*(c.to_numpy().view(np.uint64) for c in batch.columns))))

        return among.select("h1", "h2").mapInArrow(run, "h1 long, h2 long")

    inside = keys.select("h1", "h2")
    outside = settle(errs(first, universe).distinct().join(keys, ["h1", "h2"], "left_anti"), "false")
    levels, wrong = [first], outside.count()
    while wrong:  # what the last level errs on, from the other side
        x = level(outside, wrong, 0.5, len(levels) + 1)
        levels.append(x)
        inside, outside = outside, settle(errs(x, inside), "false")
        wrong = outside.count()
    return levels


def _keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Candidate keys, the longest first; of equally long ones that with the longer host first."""
    if not shapes:
        return F.array().cast("array<struct<n: int, key: string>>")
    known = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in shapes])
    fits = F.filter(known, lambda s: (host != "") & (labels(host) >= s.a) & (F.length(path) >= s.b))
    key = lambda s: F.concat(F.call_function("substring_index", host, F.lit("."), -s.a), F.substring(path, F.lit(1), s.b))
    return F.reverse(F.array_sort(F.transform(F.array_distinct(F.transform(fits, key)), lambda k: F.struct(F.length(k).alias("n"), k.alias("key")))))


def _tagged(tag: str, key: Column) -> Column:
    return F.concat(F.lit(tag + " "), key)


def _hash_of(tag: str, i: int):
    return lambda key: hashed(_tagged(tag, key))[i]


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule (null if none fits), verdict.

    rules: host, path, verdict (allow or block). The longest rule that fits decides; if one rule has both verdicts,
    block. Without a rule, `default`. A null url, or one without ://, has an empty host and path and no rule.
    Repeated rows are judged one by one; an empty table or list gives an empty result or defaults. Of the rules only
    their shapes (host labels, path length) come to the driver; a list of any size is looked up in ranges of keys."""
    with workspace(pages.sparkSession):
        rules = rules.where("host is not null and path is not null").select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").distinct()
        rules = settle(rules.withColumns({"labels": labels(F.col("host")), "length": F.length("path")}), "rules")
        shapes = sorted((r.labels, r.length) for r in rules.select("labels", "length").distinct().collect())
        host, path = host_and_path(F.col(url_col))
        pages = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
        pair = lambda key: [h.alias(n) for h, n in zip(hashed(key), ("h1", "h2"))]
        keys = settle(rules.select(*pair(F.concat("verdict", F.lit(" "), "host", "path"))).distinct(), "listed")
        rows = 2 * len(shapes) * pages.count()
        turns = ranges_for(keys.count(), rows)

        keyed = pages.withColumn("_keys", _keys(F.col("host"), F.col("path"), shapes)).withColumn("_keys", F.col("_keys.key"))
        both = [F.transform("_keys", _hash_of(tag, i)) for tag in ("allow", "block") for i in (0, 1)]
        hits = F.transform("_keys", lambda k: F.lit(0))
        state = keyed.select(id_col, "host", "path", "_keys", *(b.alias(f"_h{i}") for i, b in enumerate(both)), hits.alias("_hits"))
        names, schema = state.columns, state.schema
        universe = state.select(F.explode(F.concat(F.arrays_zip(F.col("_h0").alias("h1"), F.col("_h1").alias("h2")), F.arrays_zip(F.col("_h2").alias("h1"), F.col("_h3").alias("h2")))).alias("k")).select("k.h1", "k.h2")
        if turns > 1:
            state = settle(state, "pages", keep=True)
        for turn in range(turns):
            mine = F.pmod(F.col("h1"), F.lit(turns)) == turn
            levels = build(keys.where(mine), universe.where(mine), rows // turns)
            state = state.mapInArrow(_look_up(levels, names, turn, turns), schema)
            if turn < turns - 1:
                state = settle(state, "pages", keep=True)
        best = F.array_position(F.transform("_hits", lambda h: h > 0), True).cast("int")
        found = state.select(id_col, "host", "path", F.when(best > 0, F.get("_keys", best - 1)).alias("rule"), F.when(best > 0, F.get("_hits", best - 1)).alias("_hit"))
        return found.select(id_col, "host", "path", "rule", F.when(F.col("_hit") >= 2, "block").when(F.col("_hit") == 1, "allow").otherwise(default).alias("verdict"))


def _look_up(levels: list[Level], names: list[str], turn: int, turns: int):
    """Adds 1 to a key's hit if it is listed as allow, 2 if as block; only keys of this turn's range are looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(names) - 1)
            hits = column.flatten().to_numpy(zero_copy_only=False).copy()
            h = [batch.column(4 + i).flatten().to_numpy() for i in range(4)]
            for a, b, worth in ((h[0], h[1], 1), (h[2], h[3], 2)):
                own = np.flatnonzero(a % turns == turn)
                yes = own[listed(levels, a[own].view(np.uint64), b[own].view(np.uint64))]
                hits[yes] += worth
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(column.value_lengths().to_numpy())).astype(np.int32)), pa.array(hits))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names)

    return run
