"""The registered queries, with their own parameters, on the smallest tables: against DuckDB, the libraries or brute force."""

import hashlib
import os
import zlib
from array import array
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from concordia.llm import queries
from test_operators import grouped, measured, nearest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "conversations", "embeddings", "labels"):
        path = f"{FOLDER}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall())


def rows(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, con, name):
    got = queries.QUERIES[name](spark, FOLDER)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want) and want


def test_op2(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op2_suffix_repetition")}
    assert got.keys() == docs.keys()
    for i, r in got.items():
        if len(docs[i] or "") < 6000:
            m = measured(docs[i], 5)
            bad = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
            assert r.asDict() == m | {"doc_id": i, "base_failed": bad, "kept": not bad and m["covered_words"] <= 0.3 * m["n_words"] and m["longest_repeat"] <= 100}


def test_op3(spark, con):
    got = {}
    for r in rows(spark, "op3_learned_partitions"):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = nearest(con.execute("SELECT vec_id, embedding FROM embeddings").fetchall(), 20, 20)
    assert got.keys() == want.keys()
    assert all([k for k, _, _ in sorted(f)] == list(range(1, 21)) for f in got.values())
    hits = sum(len({j for _, j in want[q]} & {j for _, j, _ in f}) for q, f in got.items())
    assert hits >= 0.9 * 20 * len(got)
    vectors = {i: np.array(v, float) for i, v in con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()}
    assert all(np.isclose(s, vectors[q] @ vectors[j], atol=1e-12) for q, f in got.items() for _, j, s in f)


def test_op5(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, filled = set(), {}
    for (i, _), e in zip(docs.items(), t.encode_batch([x or "" for x in docs.values()], add_special_tokens=False)):
        ids = [*e.ids, 1]
        for k in range(0, len(ids), 4096):
            want.add((i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(array("I", ids[k : k + 4096]).tobytes())))
    got = rows(spark, "op5_best_fit_packing")
    assert len(got) == len(want) and {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert len(filled) <= 1.05 * sum(r.length for r in got) / 4096 + 1


def test_op7(spark, docs):
    from concordia.llm import byte_bpe

    encoding = byte_bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    want = set()
    for i, text in docs.items():
        ids = encoding.encode_ordinary(text or "")
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert {tuple(r) for r in rows(spark, "op7_byte_bpe")} == want


def test_op8(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows(spark, "op8_minhash_odd_sketch")}
    ids = list(docs)
    want = grouped(list(docs.values()), 3, 85)
    assert [got[i] for i in ids] == [(n, ids[c], k) for n, c, k in want]


def test_op9(spark, docs, con):
    label = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = rows(spark, "op9_line_crf_quality")
    assert {r.doc_id for r in got} == docs.keys() and len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in label]
    good, bad = ([r.score for r in held if label[r.doc_id] == y] for y in (1, 0))
    assert good and bad and np.mean([[g > b for b in bad] for g in good]) >= 0.95


def test_op9_accuracy(spark):
    """On a table with enough labels to learn from."""
    folder = FOLDER.replace("0.001", "0.01")
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in queries.op9_line_crf_quality(spark, folder).where("held_out").collect() if r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held) > 20


def test_op10(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = set(), 0
    for (i, _), e in zip(docs.items(), t.encode_batch([x or "" for x in docs.values()], add_special_tokens=False)):
        ids = [*e.ids, 2]
        want.add((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    assert {tuple(r) for r in rows(spark, "op10_token_store")} == want


def test_pipeline_keeps_what_its_stages_keep(spark, docs):
    packed = {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()}
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    one = {r.doc_id for r in corpus_pipeline.quality_rules(spark, source, FOLDER).collect()}
    assert one == {r.doc_id for r in rows(spark, "op2_suffix_repetition") if r.kept}
    good = {r.doc_id for r in rows(spark, "op9_line_crf_quality") if r.predicted}
    left = sorted(one & good)
    want = grouped([docs[i] for i in left], 5, 80)
    assert packed == {i for i, (_, _, kept) in zip(left, want) if kept}
