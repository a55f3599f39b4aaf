"""Best-fit packing: bounded-space online best-fit over token pieces.

Each task packs its own pieces in one pass with at most `open_bins` open sequences. A
bitset keyed by free space has a bit for every amount of room that some open sequence
has; the lowest bit at or above a piece's length is the best fit. When no open sequence
has room and all are in use, the fullest closes first.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.llm import _text as X
from concordia.llm._cluster import partitions_for, settle
from concordia.llm._pieces import tokenizer_ids

CAPACITY, END_ID = 4096, 1
#: Open sequences of a task, and pieces that a task packs.
OPEN_BINS, PIECES_PER_TASK = 2048, 100_000

#: The column that tells pieces apart.
_ROW = "_concordia_row"
PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A document's ids, then end_id, cut only if longer than capacity: id, piece, start, length, ids_crc32 (and ids).

    A null or empty text is its end_id alone; null and repeated ids are cut row by row. Other columns are not read. An empty
    table gives an empty result."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_ids(tokenizer_path, "")
        for batch in batches:
            for at, s in X.slices(batch.column(1)):
                rows, number, start, length, crc, parts = [], [], [], [], [], []
                found, upto = encoder.of(s)
                for row in range(s.n):
                    data = found[upto[row] : upto[row + 1]].tobytes() + end
                    for k in range(0, len(data), 4 * capacity):
                        part = data[k : k + 4 * capacity]
                        rows.append(at + row)
                        number.append(k // (4 * capacity))
                        start.append(k // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            parts.append(array("I", part).tolist())
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [id_col, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    schema = f"`{id_col}` {kind}, {PIECE_SCHEMA}" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


class BestFit:
    """Open sequences by their free space; `place` gives a piece's sequence number and offset."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.open, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bins = self.by_free[free]
            number = bins.pop()
            if not bins:
                self.bits ^= 1 << free
            self.open -= 1
        else:
            number, free = self.made, self.capacity
            self.made += 1
            if self.open >= self.most:  # the fullest, that with the least free space, closes
                least = (self.bits & -self.bits).bit_length() - 1
                self.by_free[least].pop()
                self.open -= 1
                if not self.by_free[least]:
                    self.bits ^= 1 << least
        left = free - length
        if left:
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(number)
            self.open += 1
        return number, self.capacity - free


def pack(rows: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of 1 to capacity; each partition is packed apart.

    Equal rows are packed one by one; columns that are named like the results are replaced. An empty table stays empty. A null
    length, or one out of bounds, is an error."""
    rows = rows.drop("sequence_id", "offset")
    place = rows.columns.index("length")
    names = [*rows.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, fit = TaskContext.get().partitionId() << 40, BestFit(capacity, open_bins)
        for batch in batches:
            lengths = batch.column(place).to_pylist()
            if any(n is None or not 0 < n <= capacity for n in lengths):
                raise ValueError(f"lengths must be 1 to {capacity}")
            spots = [fit.place(n) for n in lengths]
            columns = [*batch.columns, pa.array([base + s for s, _ in spots], pa.int64()), pa.array([o for _, o in spots], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK, with_ids: bool = False) -> DataFrame:
    """Every piece of every row with its place: the columns of `pieces`, sequence_id, offset.

    A null or empty text is its end_id alone. Repeated rows are packed once each. Of docs only the id and text
    are read. An empty table gives an empty result. Encoded pieces are written once, each with a number of its own, by which
    they are dealt: null ids, or one id on many rows, come to all tasks alike. The number of packing tasks follows the count
    of pieces, and each task's order is fixed, so a task that runs again packs alike."""
    numbered = pieces(docs, tokenizer_path, id_col, text_col, end_id, capacity, with_ids).withColumn(_ROW, F.monotonically_increasing_id())
    encoded = settle(numbered, "pieces", keep=True)
    tasks = partitions_for(encoded.count(), per_task)
    dealt = encoded.repartition(tasks, F.xxhash64(_ROW)).sortWithinPartitions(F.xxhash64(_ROW), _ROW)
    return pack(dealt.drop(_ROW), capacity, open_bins)
