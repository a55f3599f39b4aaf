"""Hard negatives, the prefix trie and the parity join against brute force on small fixtures."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordia.llm import _links, hard_negatives, parity_join, prefix_trie
from concordia.llm import learned_partitions, licenses, packing, token_store
from test_operators import grouped, nearest


# Hard negatives

def mined(rows, every, k=5, m=10):
    """By hand: rows (id, vector, label)."""
    good = {(i, tuple(int(np.floor(256 * float(x))) for x in v), l) for i, v, l in rows if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, v, l in good:
        if i % every == 0:
            score = sorted((-sum(a * b for a, b in zip(v, w)), j, n) for j, w, n in good if j != i and len(w) == len(v))
            for s, j, _ in [x for x in score if x[2] == l][:k]:
                near = [x for x in score if x[2] != l and 30 * -s <= 100 * -x[0] <= 90 * -s][:m]
                out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(near, 1)]
    return Counter(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 0) for i, v, l in rows], "vec_id long, embedding array<float>, label int, q string, score int")


def points(n, d, seed, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, d))
    x = (centre[rng.integers(0, 5, n)] + rng.normal(size=(n, d))) / 8
    return [(i, x[i].astype(np.float32).tolist(), int(rng.integers(0, labels))) for i in range(n)]


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", (64, 100))
    monkeypatch.setattr(hard_negatives, "CHUNK", 7)
    monkeypatch.setattr(hard_negatives, "LOWER", 4)
    rows = points(700, 20, 1)
    got = hard_negatives.mine(vectors(spark, rows), every=25)
    assert Counter(map(tuple, got.collect())) == mined(rows, 25)


def test_hard_negatives_awkward(spark):
    rows = points(60, 10, 2)
    rows += [(100 + i, rows[3][1], rows[3][2]) for i in range(40)]  # a hot vector of one label
    rows += [(150 + i, rows[3][1], 9) for i in range(30)] + [rows[0], rows[0]]
    rows += [(None, rows[0][1], 1), (200, None, 1), (201, rows[0][1], None), (202, [None] * 10, 1), (203, [float("nan")] * 10, 1), (204, [float("inf")] * 10, 1)]
    rows += [(210, [0.0] * 10, 1), (211, [0.0] * 10, 2), (212, [1.0, 2.0], 1), (220, [1.0, 2.5], 1), (214, [1.0, 1.0], 2), (230, [], 1), (231, [], 1), (240, [], 2), (-10, rows[5][1], 0), (0, rows[7][1], 1)]
    got = hard_negatives.mine(vectors(spark, rows), every=10)
    assert Counter(map(tuple, got.collect())) == mined(rows, 10)
    assert hard_negatives.mine(vectors(spark, []), every=10).count() == 0


def test_reaching():
    rng = np.random.default_rng(3)
    for d, big in ((0, 1), (1, 5), (7, 100), (40, 100), (64, 10_000_000)):
        q, x = rng.integers(-big, big, (9, d)), rng.integers(-big, big, (300, d))
        want = q.astype(object) @ x.T.astype(object) if d else np.zeros((9, 300), object)
        for least in (np.full(9, -np.inf), np.full(9, 0.0), np.quantile(want.astype(float), [0.5, 0.9, 0.99] * 3)):
            got = Counter((int(i), int(j), int(s)) for a, b, c in hard_negatives.reaching(q, x, least) for i, j, s in zip(a, b, c))
            assert got == Counter((i, j, int(want[i, j])) for i in range(9) for j in range(300) if want[i, j] >= least[i])


# The prefix trie

def by_hand(rows, rebuild=True):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + v[h:] if rebuild else v
    members = defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    ends = {p: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)).encode()).hexdigest() for p, m in members.items()}
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], ends[p]) for p, m in members.items())


def said(rng, convs, longest, words):
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["u", "a", None]), rng.choice(words)))
    return rows


CHAT = "conv_id long, turn long, role string, text string, a int, n int"


@pytest.mark.parametrize("strip, per_range, longest", [(64, 8192, 8), (2, 5, 14)])
def test_trie(spark, strip, per_range, longest):
    rng = random.Random(strip)
    rows = said(rng, range(60), longest, ["x", "é", "", None]) + [(None, 1, "u", "x")] * 3
    rows += [(c, t, "u", "y") for c in range(100, 130) for t in range(3)] + rows[:5]  # a hot conversation, repeated rows
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], CHAT)
    got = prefix_trie.trie(df, F.crc32(F.col("conv").cast("string").cast("binary")) % 9, F.col("conv") - F.col("conv") % 5, strip=strip, per_range=per_range)
    assert Counter(map(tuple, got.collect())) == by_hand(rows)
    got = prefix_trie.trie(df, strip=strip, per_range=per_range)
    assert Counter(map(tuple, got.collect())) == by_hand(rows, False)


def test_trie_of_nothing_and_of_one_long_text(spark):
    assert prefix_trie.trie(spark.createDataFrame([], CHAT)).count() == 0
    rows = [(1, 1, None, None), (2, 1, "", ""), (2, 2, "u", "long " * 100_000)]
    got = prefix_trie.trie(spark.createDataFrame([(*r, 1, 2) for r in rows], CHAT))
    assert Counter(map(tuple, got.collect())) == by_hand(rows, False)
    rows = [(6, 1, "u", "x"), (7, 1, "u", "y")]  # all turns go: turnless conversations are members of the root
    got = prefix_trie.trie(spark.createDataFrame([(*r, 1, 2) for r in rows], CHAT), F.lit(8), F.lit(99))
    assert [tuple(r) for r in got.collect()] == [(6, 0, None, 2, 0, 1, 0, hashlib.sha256(b"6,7").hexdigest())]


def test_ends_of_many(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 10)
    df = spark.range(1000).select(F.lit(1).cast("long").alias("depth"), F.lit(5).cast("long").alias("a"), F.lit(6).cast("long").alias("b"), F.col("id").alias("conv"))
    assert prefix_trie.ends(df).collect()[0].ends_sha256 == hashlib.sha256(",".join(map(str, range(1000))).encode()).hexdigest()


# The parity join

def shingled(rng, n, words=4000):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def changed(rng, words, share):
    return [w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words]


DOCS = "doc_id long, text string, bucket int, id int, band int"


def test_parity_join(spark):
    rng = random.Random(13)
    texts = [None, "", " \t ", "one", "One", "one two", "one two three", "one two three four", "é é é", "a b c d e f g h i j k l m", "A B C D E F G H I J K L M n"]
    for n in (5, 12, 19, 25, 40, 90, 200, 700, 3000):
        base = shingled(rng, n)
        for share in (0, 0.005, 0.01, 0.017, 0.03, 0.1):
            texts.append(" ".join(changed(rng, base, share)))
        texts.append(" ".join(base + shingled(rng, max(1, n // 12))))
        texts.append(" ".join(base[: n - n // 11]))
    common = shingled(rng, 200)
    texts += [" ".join(common + shingled(rng, 60)) for _ in range(60)]  # a passage that many share
    chain = shingled(rng, 150)
    for step in range(40):  # neighbours are alike, ends are not
        chain[step * 3 % 150] = f"n{step}"
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.join_components(docs, sizes=_links.Sizes(4, (1, 3, None), 8)).collect()}
    assert [got[i] for i in range(len(texts))] == [x[:2] for x in grouped(texts, 3, 90)]


def test_parity_join_of_odd_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "q r s t"), (None, "a b c d"), (None, "z z z z"), (2, "q r s t"), (3, None), (None, None)]
    got = parity_join.join_components(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS)).collect()
    assert Counter(map(tuple, got)) == Counter([(1, 2, 1)] * 3 + [(None, 2, 1), (2, 2, 1), (None, 1, None), (3, 0, 3), (None, 0, None)])
    assert parity_join.join_components(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_sets_that_are_alike_share_a_word(percent):
    rng = np.random.default_rng(percent)
    least, words = parity_join.size_bands(percent)
    for size in (1, 2, 9, 10, 11, 37, 120, 1999, 6000):
        for _ in range(20):
            a = np.sort(rng.integers(1, 2**63, size).astype(np.uint64))
            larger = int(rng.integers(size, 100 * size // percent + 1))
            both = -(-percent * (size + larger) // (100 + percent))
            if both > size:
                continue
            b = np.r_[a[:both], rng.integers(1, 2**63, larger - both).astype(np.uint64)]
            band, other = (int(np.searchsorted(least, n, side="right") - 1) for n in (size, larger))
            assert other in (band, band + 1)
            one, two = (parity_join.parity_words(x, np.zeros(len(x), int), words[[band]], np.array([band]))[0] for x in (a, b))
            apart = size + larger - 2 * both
            assert apart <= parity_join.most_different(size, larger, percent) < words[band]
            assert (one == two).any() and int(np.bitwise_count(one ^ two).sum()) <= apart


# Mended in the third round


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 30])
def test_few_vectors_give_all_candidates(spark, n):
    rows = [(i, np.random.default_rng(i).normal(size=6).astype(np.float32).tolist()) for i in range(n)]
    got = learned_partitions.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=3).collect()
    want = nearest(rows, 20, 3)
    assert Counter(r.query_id for r in got) == Counter({q: len(w) for q, w in want.items() if w})
    if n <= 21:
        assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted((q, k, j) for q, w in want.items() for k, (_, j) in enumerate(w, 1))


def test_every_length_is_searched(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3 + i % 2).astype(np.float32).tolist()) for i in range(24)]
    got = learned_partitions.search(spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, part int"), every=3).collect()
    assert Counter(r.query_id for r in got) == Counter({i: 11 for i in range(0, 24, 3)})
    assert all((r.query_id - r.vec_id) % 2 == 0 for r in got)


@pytest.mark.parametrize("ids", ["null", "one"])
def test_pieces_of_one_id_come_to_all_tasks(spark, ids):
    import public_tokenizers

    docs = spark.range(400).select(F.lit(None if ids == "null" else 7).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id") % 5).alias("text"), F.lit(1).alias("sequence_id"))
    got = packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"), per_task=50)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 100 and got.count() == 400
    spots = {(r.sequence_id, r.offset) for r in got.collect()}
    assert len(spots) == 400  # no two pieces have one place
    assert packing.pack(docs.select("doc_id", F.lit(3).alias("length"), "sequence_id").limit(5)).columns == ["doc_id", "length", "sequence_id", "offset"]


def test_the_least_id_is_an_id(spark):
    import public_tokenizers

    docs = spark.createDataFrame([(-(2**63), "a b"), (None, "c"), (None, None), (5, "d e f")], "doc_id long, text string")
    store = token_store.write_store(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2)
    got = [(r.id, r.n_tokens) for r in token_store.read_store(*store).orderBy("start").collect()]
    assert sorted(got[:2], key=str) == [(None, 1), (None, 2)] and [i for i, _ in got[2:]] == [-(2**63), 5]
    assert len(token_store.read_document(store[0], store[1], -(2**63))) == 1 and len(token_store.read_document(store[0], store[1], 5)) == 1


ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ZLIB = "This software is provided 'as-is', without any express or implied\nwarranty.  In no event will the authors be held liable.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not"
NOTICES = [
    (ISC, ["ISC"]), (ISC.replace(" ", "\n * "), ["ISC"]), ("// SPDX-License-Identifier: MIT\nint x;", ["MIT"]), ("/* SPDX-License-Identifier: GPL-2.0-or-later */", ["GPL-2.0-or-later"]), ("# SPDX-License-Identifier: (MIT OR Apache-2.0)", ["MIT", "Apache-2.0"]),
    ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", ["BSL-1.0"]), ("Boost Software License - Version 1.0 - August 17th, 2003", ["BSL-1.0"]), (ZLIB, ["Zlib"]), (ZLIB.upper(), ["Zlib"]),
    ("This program and the accompanying materials\nare made available under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/", ["EPL-2.0"]),
    ("All rights reserved. This program and the accompanying materials\n * are made available under the terms of the Eclipse Public License v1.0\n * which accompanies this distribution, and is available at\n * http://www.eclipse.org/legal/epl-v10.html", ["EPL-1.0"]),
    ("dnl This program is free software; you can redistribute it and/or modify\ndnl it under the terms of the GNU General Public License as published by\ndnl the Free Software Foundation; either version 3 of the License, or\ndnl (at your option) any later version.", ["GPL-3.0-or-later"]),
    ("REM Licensed under the MIT\nREM License.", ["MIT"]), ("a word\n" * 200_000 + "Released under the MIT license.", ["MIT"]), ("the software of this project has no licence", []), (None, []), ("", []),
]


def test_more_licenses(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string, license string")
    got = {r.doc_id: list(r.licenses) for r in licenses.scan_licenses(docs).collect()}
    assert got == {i: names for i, (_, names) in enumerate(NOTICES)}


def test_every_known_sentence_has_a_trigger():
    known = [*licenses.SENTENCES.values(), *licenses.PUBLISHED]
    words = licenses.triggers(known)
    assert len(words) < 12 and all(any(w in s for w in words) for s in known)


def test_very_long_texts(spark):
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    from concordia.llm import byte_bpe, line_crf

    texts = ["x" * 200_000, "word " * 60_000 + "end", "a line of text\n" * 30_000, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = Counter()
    words = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for r in packing.best_fit_packing(docs, P.path("word_bpe_49k.json")).collect():
        pieces[r.doc_id] += r.length
        assert 0 < r.length <= 4096 and r.start == 4096 * r.piece
    assert pieces == {i: len(words.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    store = token_store.write_store(docs, P.path("byte_bpe_50k.json"), P.PATTERN, end_id=2)
    assert {r.id: r.n_tokens for r in token_store.read_store(*store).collect()} == {i: len(whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    ranks = byte_bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    got = {r.doc_id: r for r in byte_bpe.encode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()}
    assert isinstance(ranks, tiktoken.Encoding) and all(got[i].n_tokens == len(ranks.encode_ordinary(t)) and got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts))
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in line_crf.score_documents(docs, line_crf.train(docs, labels)).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and len(scores) == 4
