"""Byte-level BPE encoding and decoding with tiktoken from a local rank file.

Long texts are cut at safe boundaries (see `_pieces`), so that no single call gets a very
long one where it has such places; ids decode through the raw bytes of each token.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.llm import _text as X
from concordia.llm._pieces import halves, once


#: Longer texts (characters) are cut, at safe boundaries only.
LONG = 50_000


def load(rank_path: str, pattern: str):
    """The encoding of a rank file (a line: base64 token, rank), without special tokens."""
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256 (and ids).

    Null and empty texts have no ids. ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the
    bytes that the ids decode to. Repeated rows give repeated results; other columns are not read. An empty table gives
    an empty result."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = once(("tiktoken", rank_path, pattern), lambda: load(rank_path, pattern))

        for batch in batches:
            for at, s in X.slices(batch.column(1)):
                count, digest, decoded, ids = [], [], [], []
                for text in batch.column(1).slice(at, s.n).to_pylist():
                    own = [i for part in halves(text or "", LONG) for i in encoding.encode_ordinary(part)] if text and len(text) > LONG else encoding.encode_ordinary(text or "")
                    count.append(len(own))
                    digest.append(hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(encoding.decode_bytes(own)).hexdigest())
                    if with_ids:
                        ids.append(own)
                columns = [batch.column(0).slice(at, s.n), pa.array(count, pa.int64()), pa.array(digest), pa.array(decoded)]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode(tokens: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """tokens with `decoded`, the raw bytes of its ids; null ids are as none. Ids outside the ranks, or a null among them, fail.

    Repeated rows are decoded one by one; a column named `decoded` is replaced. An empty table stays empty."""
    tokens = tokens.drop(*({"decoded"} - {ids_col}))
    place = tokens.columns.index(ids_col)
    names = [*tokens.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = once(("tiktoken", rank_path, pattern), lambda: load(rank_path, pattern))
        for batch in batches:
            data = [encoding.decode_bytes(x or []) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names)

    return tokens.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema) + ", decoded binary")
