"""Quality rules: suffix-array repetition.

Within each document, sort the suffixes of its words by prefix doubling and take the
longest common prefixes of neighbours. The LCP intervals of at least `min_words` are the
maximal repeated substrings; every suffix in such an interval covers as many words as
its larger neighbouring LCP. The union of these spans and the longest repeat are limited.

Only places whose first `min_words` words occur twice can lie in such an interval, so
only those are sorted further; text without repeats costs one sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.llm import _text as X

#: A repeat counts from so many words on.
MIN_WORDS = 5
#: A document is rejected if repeats cover more than this part of its words, or one has more words than LONGEST.
MAX_COVERED, MAX_LONGEST = 0.3, 100

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def repeats(number: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """For each word the length in words (0, or k at least) of the longest repeat within its document that begins there."""
    n = len(number)
    out = np.zeros(n, np.int64)
    key, at = X.gram_keys(number, doc, k)
    if not len(key):
        return out
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    begins = np.ones(len(ranked), bool)
    begins[1:] = ranked[1:] != ranked[:-1]
    group = np.flatnonzero(begins)
    sizes = np.diff(np.append(group, len(ranked)))
    # The rank of a place is where its group begins in the order; places without a gram rank apart, after all others.
    rank = np.arange(len(at), len(at) + n + 1, dtype=np.int32 if 2 * n < 2**31 else np.int64)
    rank[at[order]] = np.repeat(group, sizes)
    slot = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places in the order that aren't yet told apart
    if not len(slot):
        return out
    sa = at[order]
    pairs = slot[:-1][(np.diff(slot) == 1) & (rank[sa[slot[:-1]]] == rank[sa[slot[1:]]])]
    levels = [rank.copy()]
    step = 1
    while len(slot):
        place = sa[slot]
        following = rank[np.minimum(place + step, n)]
        now = np.lexsort((following, rank[place]))
        place, following = place[now], following[now]
        sa[slot] = place
        old = rank[place]
        new = np.ones(len(slot), bool)
        new[1:] = (old[1:] != old[:-1]) | (following[1:] != following[:-1])
        starts = np.flatnonzero(new)
        count = np.diff(np.append(starts, len(slot)))
        rank[place] = np.repeat(slot[starts], count)
        slot = slot[np.repeat(count > 1, count)]
        levels.append(rank.copy())
        step *= 2
    a, b = sa[pairs], sa[pairs + 1]
    lcp = np.zeros(len(pairs), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][np.minimum(a + lcp, n)] == levels[level][np.minimum(b + lcp, n)]
        same &= (a + lcp < n) & (b + lcp < n)
        lcp[same] += 1 << level
    np.maximum.at(out, a, lcp + k - 1)
    np.maximum.at(out, b, lcp + k - 1)
    return out


def measure(s: X.Slice, min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """MEASURES of each document of a slice."""
    w = X.words(s)
    letters = ~X.SPACE[s.data]
    out = {
        "n_words": np.diff(w.first),
        "word_chars": X.per_doc(letters & ((s.data & 0xC0) != 0x80), s.offsets),
        "n_symbols": X.per_doc(SYMBOL[s.data], s.offsets),
    }
    # Lines: \n and document ends are their bounds; only those with a word count.
    breaks = np.flatnonzero(s.data == 10)
    begin = np.unique(np.concatenate([s.offsets[:-1], breaks + 1]))
    line_doc = np.searchsorted(s.offsets[1:], begin, side="right")
    stop = np.append(breaks, len(s.data))
    stop = stop[np.searchsorted(stop, begin)]
    ends = s.offsets[1:][np.minimum(line_doc, s.n - 1)] if s.n else stop
    end = np.minimum(stop, ends)
    has = np.zeros(len(s.data) + 1, np.int64)
    np.cumsum(letters, out=has[1:])
    real = (line_doc < s.n) & (end > begin)
    begin, end, line_doc = begin[real], end[real], line_doc[real]
    real = has[end] > has[begin]
    begin, end, line_doc = begin[real], end[real], line_doc[real]
    line = X.distinct(s.data, begin, end)[1]
    order = np.lexsort((line, line_doc))
    again = (line[order][1:] == line[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
    out["n_dup_lines"] = np.bincount(line_doc[order][1:][again], minlength=s.n)

    n = len(w.number)
    out["n_repeat_words"] = X.per_doc(X.repeated(w.number, w.doc, 3), w.first)

    longest = repeats(w.number, w.doc, min_words)
    spans = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(longest)
    np.add.at(spans, starts, 1)
    np.add.at(spans, starts + longest[starts], -1)
    out["covered_words"] = X.per_doc(np.cumsum(spans[:-1]) > 0, w.first)
    most = np.zeros(s.n, np.int64)
    np.maximum.at(most, w.doc[starts], longest[starts])
    out["longest_repeat"] = most
    return out


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def passes(m: dict[str, np.ndarray], max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> np.ndarray:
    return (m["covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_longest)


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per input row: the id, MEASURES (long), base_failed and kept.

    A null or empty text has no words and fails the base rule. Repeated rows and ids are judged row by row;
    other columns are not read. An empty table gives an empty result."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, s in X.slices(batch.column(1)):
                m = measure(s, min_words)
                bad = base_failed(m)
                columns = [batch.column(0).slice(at, s.n), *(pa.array(m[c].astype(np.int64)) for c in MEASURES), pa.array(bad), pa.array(~bad & passes(m, max_covered, max_longest))]
                yield pa.RecordBatch.from_arrays(columns, [id_col, *MEASURES, "base_failed", "kept"])

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in MEASURES) + ", base_failed boolean, kept boolean"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def keep_unrepetitive(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The rows of docs, with all their columns, that the rules keep; nothing is shuffled.

    Null and empty texts have too few words and go. Repeated rows and ids are judged row by row. An empty table stays
    empty; columns named as the measures stay as they are."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.zeros(0, bool)]
            for _, s in X.slices(batch.column(place)):
                m = measure(s, min_words)
                kept.append(~base_failed(m) & passes(m, max_covered, max_longest))
            yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
