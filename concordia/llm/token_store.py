"""Token-id binary output: documents compressed one by one under a shared zstandard dictionary.

A store is three Parquet tables. `dictionary` has one row: its bytes and SHA-256. `blocks`
has one row for each block of consecutive documents; its `payload` is the file format:

    4s magic, B bytes of an id (2 or 4), 32s SHA-256 of the dictionary, I documents,
    Q tokens of the range before the block, then by document: ids (q), token counts (I),
    frame ends (I), whether the id is null (B); then the frames, each a zstandard frame of
    one document's ids, little-endian.

So one short document needs its block's index and its own frame only. Documents are in
ascending id order over ranges, then blocks, then within a block. `ranges` has the number
of tokens before each range.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.llm import _text as X
from concordia.llm._cluster import partitions_for, settle, workspace
from concordia.llm._pieces import tokenizer_ids

#: The dictionary is trained on at most SAMPLE whole documents of at most SAMPLE_CHARS together, the first by a hash of
#: id and text (it changes sizes, never ids).
SAMPLE, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 8_000_000, 64 << 10
DOCS_PER_RANGE, DOCS_PER_BLOCK, BYTES_PER_BLOCK = 5000, 1024, 4 << 20
#: Ranges that one task adds up at a time; ranges up to which their totals are broadcast.
CHUNK, BROADCAST_RANGES = 4096, 1_000_000
HEAD = struct.Struct("<4sB32sIQ")
MAGIC = b"TOK2"
BLOCKS = "range_no int, block_no int, first_id long, last_id long, n_docs int, n_tokens long, payload binary"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary's bytes: trained, or where the samples are too few for that, the samples themselves; empty without any."""
    import zstandard

    try:
        if len(samples) >= 16:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        pass
    return b"".join(samples)[-DICTIONARY_BYTES:]


def _codec(dictionary: bytes):
    import zstandard

    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=d), zstandard.ZstdDecompressor(dict_data=d)


def pack_block(width: int, dictionary_hash: bytes, before: int, ids: list[int], counts: list[int], frames: list[bytes]) -> bytes:
    ends = np.cumsum([len(f) for f in frames]).astype("<u4")
    return HEAD.pack(MAGIC, width, dictionary_hash, len(ids), before) + np.array([i or 0 for i in ids], "<i8").tobytes() + np.array(counts, "<u4").tobytes() + ends.tobytes() + np.array([i is None for i in ids], np.uint8).tobytes() + b"".join(frames)


def unpack_block(payload: bytes) -> tuple[int, bytes, int, np.ma.MaskedArray, np.ndarray, list[bytes]]:
    """(bytes of an id, dictionary's hash, tokens before, document ids (null ones masked), token counts, frames)."""
    magic, width, digest, n, before = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEAD.size
    ids, counts, ends = np.frombuffer(payload, "<i8", n, at), np.frombuffer(payload, "<u4", n, at + 8 * n), np.frombuffer(payload, "<u4", n, at + 12 * n).astype(np.int64)
    ids = np.ma.masked_array(ids, np.frombuffer(payload, np.uint8, n, at + 16 * n).astype(bool))
    at += 17 * n
    return width, digest, before, ids, counts, [payload[at + a : at + b] for a, b in zip(np.append(0, ends[:-1]), ends)]


def _samples(docs: DataFrame) -> list[str]:
    """Texts to train on, in the order of a hash of id and text; repeated rows count once."""
    keyed = docs.where("length(text) > 0").select(F.xxhash64("id", "text").alias("h"), "text")
    sizes = {r.h: r.n for r in keyed.select("h", F.length("text").alias("n")).where(F.col("n") <= SAMPLE_CHARS).orderBy("h").limit(SAMPLE).collect()}
    fits = [h for h, upto in zip(sorted(sizes), np.cumsum([sizes[h] for h in sorted(sizes)])) if upto <= SAMPLE_CHARS]
    if not fits:
        return []
    found = keyed.where((F.col("h") <= fits[-1]) & (F.length("text") <= SAMPLE_CHARS)).groupBy("h").agg(F.min("text").alias("text"))
    return [r.text for r in sorted(found.collect(), key=lambda r: r.h)]


def prefix_sums(totals: DataFrame) -> DataFrame:
    """no and `base`, the sum of n over smaller no, of rows (no, n) with distinct no: chunks first, then within each.

    No task gets more than CHUNK rows at a time, whatever the number of rows is."""
    chunks = totals.withColumn("chunk", F.floor(F.col("no") / CHUNK).cast("long"))
    within = F.sum("n").over(Window.partitionBy("chunk").orderBy("no")) - F.col("n")
    chunks = chunks.withColumn("base", within)
    sums = chunks.groupBy("chunk").agg(F.sum("n").cast("long").alias("n")).withColumnRenamed("chunk", "no")
    top = totals.agg(F.max("no")).first()[0]
    if top is None or top < CHUNK:
        return chunks.select("no", F.col("base").cast("long").alias("base"))
    before = prefix_sums(settle(sums, "sums")).select(F.col("no").alias("chunk"), F.col("base").alias("before"))
    return chunks.join(before, "chunk").select("no", (F.col("base") + F.col("before")).cast("long").alias("base"))


def write_store(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int, vocabulary: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Writes the store in the shared folder: (dictionary, blocks, ranges).

    Ids are integers; a null id ranks before all others and has a flag in its block. Null and empty texts are
    end_id alone. Repeated rows are stored one by one; rows with one id are in the order of a hash of their texts. An
    empty table gives no block. Spark deals rows to ranges by id, that hash and the row's place, so that no id, null
    ones neither, is one range however often it comes."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    width = 2 if vocabulary <= 1 << 16 else 4
    kind = np.dtype(f"<u{width}")
    encoder = tokenizer_ids(tokenizer_path, pattern)
    dictionary = train_dictionary([encoder.of(s)[0].astype(kind).tobytes() for t in _samples(docs) for _, s in X.slices(pa.array([t]))])
    digest = hashlib.sha256(dictionary).digest()
    spark = docs.sparkSession
    with workspace(spark):
        shared = settle(spark.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, dictionary binary"), "dictionary", keep=True)
        tail = np.array([end_id], kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            def flush() -> pa.RecordBatch:
                payload = pack_block(width, digest, before, ids, counts, frames)
                values = zip((range_no, block_no, ids[0], ids[-1], len(ids), sum(counts), payload), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))
                return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], ["range_no", "block_no", "first_id", "last_id", "n_docs", "n_tokens", "payload"])

            encoder, (compressor, _) = tokenizer_ids(tokenizer_path, pattern), _codec(dictionary)
            range_no, block_no, before, size = TaskContext.get().partitionId(), 0, 0, 0
            ids, counts, frames = [], [], []
            for batch in batches:
                for at, s in X.slices(batch.column(1)):
                    found, upto = encoder.of(s)
                    found = found.astype(kind)
                    for i, a, b in zip(batch.column(0).slice(at, s.n).to_pylist(), upto[:-1].tolist(), upto[1:].tolist()):
                        frame = compressor.compress(np.append(found[a:b], tail).tobytes())
                        if ids and (len(ids) >= DOCS_PER_BLOCK or size + len(frame) > BYTES_PER_BLOCK):
                            yield flush()
                            block_no, before, size = block_no + 1, before + sum(counts), 0
                            ids, counts, frames = [], [], []
                        ids.append(i)
                        counts.append(b - a + 1)
                        frames.append(frame)
                        size += len(frame)
            if ids:
                yield flush()

        order = ["id", F.xxhash64("text"), F.monotonically_increasing_id()]
        keyed = docs.select("id", "text", *(c.alias(n) for c, n in zip(order[1:], ("h", "place"))))
        first = F.asc_nulls_first("id")
        dealt = keyed.repartitionByRange(partitions_for(docs.count(), DOCS_PER_RANGE), first, "h", "place").sortWithinPartitions(first, "h", "place")
        blocks = settle(dealt.select("id", "text").mapInArrow(run, BLOCKS), "blocks", keep=True)
        totals = settle(blocks.groupBy("range_no").agg(F.sum("n_tokens").alias("n")).select(F.col("range_no").cast("long").alias("no"), "n"), "totals")
        return shared, blocks, settle(prefix_sums(totals).select(F.col("no").cast("int").alias("range_no"), "base"), "ranges", keep=True)


def read_store(shared: DataFrame, blocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every stored document: id, start (tokens of all before it), n_tokens, ids_crc32 (as 32-bit ids).

    To the driver goes the dictionary alone; ranges are broadcast up to BROADCAST_RANGES, else joined by a shuffle."""
    dictionary = bytes(shared.first().dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decompressor = _codec(dictionary)
        digest = hashlib.sha256(dictionary).digest()
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                width, known, before, ids, counts, frames = unpack_block(payload)
                if known != digest:
                    raise ValueError("the block was written with another dictionary")
                start = base + before + np.cumsum(counts, dtype=np.int64) - counts
                length, crc = [], []
                for f in frames:
                    data = np.frombuffer(decompressor.decompress(f), f"<u{width}").astype("<u4")
                    length.append(len(data))
                    crc.append(zlib.crc32(data.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(ids.data, pa.int64(), mask=ids.mask), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    if ranges.count() <= BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    return blocks.join(ranges, "range_no").select("base", "payload").mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def read_document(shared: DataFrame, blocks: DataFrame, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with one id, in the store's order; none if it isn't there.

    Their block's index and their own frames are all that is decompressed."""
    dictionary = bytes(shared.first().dictionary)
    _, decompressor = _codec(dictionary)
    rows = blocks.where((F.coalesce("first_id", F.lit(doc_id)) <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("range_no", "block_no").toLocalIterator()
    out = []
    for width, _, _, ids, _, frames in chain(unpack_block(bytes(r.payload)) for r in rows):
        out += [np.frombuffer(decompressor.decompress(frames[i]), f"<u{width}") for i in np.flatnonzero((ids == doc_id).filled(False))]
    return out
