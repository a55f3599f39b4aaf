"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from concordia.llm import _pieces, byte_bpe, learned_partitions, licenses, line_crf, near_dedup, packing, repetition, snapshots, token_store, url_cascade
from concordia.llm import _text as X
from concordia.llm._cluster import ship

WORD = r"[^\x20\x09-\x0d]+"
ODD = [None, "", " ", "\n", "a\n\n", "\n\na", "a b c a b c a b c", " x\n x\nx\n x\n", "é é\né\n#* a", "one two", "x" * 5000, "word " * 3000]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    made = ["".join(rnd.choice(["a ", "b ", "a\n", "c ", "é ", "\n", "# "]) for _ in range(rnd.randint(0, 60))) for _ in range(80)]
    return ODD + made


def table(spark, texts, **more):
    """doc_id and text, with other columns named as results are."""
    rows = [(i, t, True, "s", 0.5) for i, t in enumerate(texts)]
    return ship(spark).createDataFrame(rows, "doc_id long, text string, kept boolean, score string, rank double").repartition(3)


# op 1


def verdict(url, rules):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = max(((len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("in_ranges", [False, True])
def test_url_cascade(spark, in_ranges, monkeypatch):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("b.org", "", "block")]
    rnd = random.Random(2)
    urls = [None, "", "no scheme", "://", "http://", "http://NET", "HTTP://Example.NET/en/x?y", "http://xnet/", "a://b://c/", "http://a.b.org?x", "http://b.org#/x", "http://example.net/en", "http://.net/", "http://a\nb.net/q"]
    urls += [f"http{rnd.choice(['', 's'])}://{rnd.choice(['', 'www.', 'a.b.'])}{rnd.choice(['example', 'x'])}.{rnd.choice(['net', 'com', 'org', 'NET'])}/{rnd.choice(['en/', 'de/', 'fr/', 'q'])}{rnd.randint(0, 9)}" for _ in range(300)]
    urls += urls[:20]
    pages = ship(spark).createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    if in_ranges:
        monkeypatch.setattr(url_cascade, "MOST_BITS", 40)
        assert url_cascade.ranges_for(2 * len(rules), 10_000) > 2
    got = url_cascade.url_filter(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {(i, *verdict(u, rules)) for i, u in enumerate(urls)}
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_cascade.url_filter(pages, none).collect()} == {"allow"}
    assert url_cascade.url_filter(pages.limit(0), none).count() == 0


def test_rules_of_many_shapes(spark):
    rules = [("a.net", "/" + "x" * n, "block" if n % 2 else "allow") for n in range(700)] + [("a.net", "/xxx", "allow")]
    urls = [f"http://b.a.net/{'x' * n}" for n in (0, 1, 2, 3, 650, 900)] + ["http://a.net", "http://net/x"]
    pages = ship(spark).createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_cascade.url_filter(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    want = {i: verdict(u, rules) for i, u in enumerate(urls)}
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == want | {3: (*want[3][:3], "block")}


def test_cascade_is_exact_on_its_universe(spark):
    ship(spark)
    universe = spark.range(4000).select(*[h.alias(n) for h, n in zip(url_cascade.hashed(F.col("id").cast("string")), ("h1", "h2"))])
    keys = spark.range(0, 4000, 13).select(*[h.alias(n) for h, n in zip(url_cascade.hashed(F.col("id").cast("string")), ("h1", "h2"))])
    levels = url_cascade.build(keys, universe, 4000)
    assert len(levels) > 1
    h = [np.array([r[i] for r in universe.collect()]).view(np.uint64) for i in (0, 1)]
    want = {tuple(r) for r in keys.collect()}
    got = url_cascade.listed(levels, *h)
    assert got.tolist() == [(int(a), int(b)) in want for a, b in zip(*(x.view(np.int64) for x in h))]


# op 2


def measured(text, k):
    words = re.findall(WORD, text or "")
    n = len(words)
    longest = [0] * n
    places = {}
    for i in range(n - k + 1):
        places.setdefault(tuple(words[i : i + k]), []).append(i)
    for same in places.values():
        if len(same) > 200:  # one word again and again: the second place's repeat is the longest
            for i in same:
                longest[i] = n - max(i, 1) if i else n - 1
            continue
        for i in same:
            for j in same:
                length = 0
                while i != j and max(i, j) + length < n and words[i + length] == words[j + length]:
                    length += 1
                longest[i] = max(longest[i], length)
    covered = {p for i, m in enumerate(longest) for p in range(i, i + m)}
    three = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    repeated = {i + j for i in range(n - 2) if three[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "covered_words": len(covered), "longest_repeat": max(longest, default=0)}


def test_repetition(spark, texts):
    docs = table(spark, texts)
    got = {r.doc_id: r.asDict() for r in repetition.repetition_rules(docs, min_words=3).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        m = measured(t, 3)
        bad = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        kept = not bad and m["covered_words"] <= 0.3 * m["n_words"] and m["longest_repeat"] <= 100
        assert got[i] == m | {"doc_id": i, "base_failed": bad, "kept": kept}, t
    plain = repetition.keep_unrepetitive(docs, min_words=3)
    assert plain.columns == docs.columns and {r.doc_id for r in plain.collect()} == {i for i, r in got.items() if r["kept"]}
    assert repetition.repetition_rules(docs.limit(0)).count() == 0


def test_slices_do_not_change_results(texts):
    whole = [repetition.measure(s, 3) for _, s in X.slices(pa.array(texts))]
    small = [repetition.measure(s, 3) for _, s in X.slices(pa.array(texts), 64)]
    for c in repetition.MEASURES:
        assert np.concatenate([m[c] for m in whole]).tolist() == np.concatenate([m[c] for m in small]).tolist()


# op 3


def nearest(rows, k, every):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    rows = list({i: v for i, v in rows}.items())
    return {i: sorted(((-(v * w).sum(), j) for j, w in rows if j != i))[:k] for i, v in rows if i % every == 0}


def test_search_is_exact_on_small_tables_and_ranks_ties_by_id(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0) for i in range(150)] + [(i, [1.0] * 8, 1) for i in range(200, 300)]
    rows += [(400, None, 0), (420, [0.0] * 8, 0), (440, [float("nan")] * 8, 0), (460, [None] + [1.0] * 7, 0), (None, [1.0] * 8, 0), (20, rows[20][1], 0)]
    vectors = ship(spark).createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in learned_partitions.search(vectors, k=7, every=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = nearest([(i, v) for i, v, _ in rows], 7, 10)
    assert got.keys() == want.keys()
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 8))
        assert [f[1] for f in found] == [j for _, j in want[q]]
        assert np.allclose([f[2] for f in found], [-s for s, _ in want[q]], atol=1e-12)
    assert learned_partitions.search(vectors.limit(0)).count() == 0
    assert learned_partitions.search(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_ties_between_different_vectors_go_to_smaller_ids(spark):
    rows = [(i, [float(i >> j & 1) for j in range(8)]) for i in range(1, 256)]
    random.Random(3).shuffle(rows)
    got = {}
    for r in learned_partitions.search(ship(spark).createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = nearest(rows, 20, 20)
    assert got.keys() == want.keys()
    for q, found in got.items():
        assert [(j, s) for _, j, s in sorted(found)] == [(j, -s) for s, j in want[q]]


def test_small_tables_are_routed_too(spark):
    rng = np.random.default_rng(5)
    router, probes = learned_partitions.fit(np.concatenate([rng.normal(size=(40, 8)) + 9 * s for s in (1, -1)])[rng.permutation(80)], 80)
    assert router.w2.shape[1] == 2 and probes == 1


@pytest.mark.parametrize("large", [16_384, 300])
def test_search_recall(spark, large, monkeypatch):
    monkeypatch.setattr(learned_partitions, "LARGE", large)
    monkeypatch.setattr(learned_partitions, "BLOCK", 150)
    monkeypatch.setattr(learned_partitions, "QUERIES", 40)
    monkeypatch.setattr(learned_partitions, "SAMPLE", 6000 if large > 300 else 400)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, 6000)] + 0.4 * rng.normal(size=(6000, 16))).astype(np.float32)
    vectors = ship(spark).createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = learned_partitions.search(vectors, k=20, every=20).select("query_id", "vec_id").collect()
    d = x.astype(float)
    s = d[::20] @ d.T
    s[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    want = {(20 * q, int(j)) for q, row in enumerate(np.argsort(-s, axis=1)[:, :20]) for j in row}
    assert len(found) == 6000 and len({tuple(r) for r in found} & want) >= 0.9 * 6000


def test_parts_are_balanced():
    x = np.random.default_rng(3).normal(size=(500, 6))
    sizes = np.bincount(learned_partitions.balanced_parts(learned_partitions.neighbour_graph(x, 10), 8))
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 3


# op 4


def test_snapshots(spark):
    rnd = random.Random(4)
    talks = {}
    for c in range(60):
        talks[c] = [(t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "", None])) for t in range(rnd.randint(1, 5))]
    for c in range(60, 120):
        old = talks[c - 60]
        talks[c] = [(3 * t, r, x) for t, r, x in old[: rnd.randint(1, len(old))]]
    talks[200] = [(0, "user", "q"), (0, "user", "q")]
    rows = [(c, t, r, x, "clash") for c, ts in talks.items() for t, r, x in ts] + [(None, 0, "user", "lost", "clash")]
    got = {r.conv_id: (r.n_turns, r.rendered) for r in snapshots.render_maximal(ship(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string")).collect()}
    seq = {c: [(r, x) for _, r, x in ts] for c, ts in talks.items()}
    want = {}
    for c, s in seq.items():
        if not any((len(o) > len(s) and o[: len(s)] == s) or (o == s and d < c) for d, o in seq.items()):
            want[c] = (len(s), "".join(f"<|{r or ''}|>\n{x or ''}\n" for r, x in s))
    assert got == want
    assert snapshots.render_maximal(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# op 5

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    texts = [*texts, "hello <|endoftext|> world<|startoftext|>", "<|ENDOFTEXT|>", *thue_morse()]
    docs = table(spark, texts).union(table(spark, texts[:3]))
    rows = packing.best_fit_packing(docs, PATH, capacity=64, per_task=40, with_ids=True).collect()
    want = Counter()
    for i, text in [*enumerate(texts), *enumerate(texts[:3])]:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 64):
            want[i, k // 64, k, len(ids[k : k + 64]), zlib.crc32(array("I", ids[k : k + 64]).tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.best_fit_packing(docs.limit(0), PATH).count() == 0


def test_best_fit_is_tight_and_bounded():
    rnd = random.Random(6)
    lengths = [min(4096, int(rnd.lognormvariate(6, 1.2)) + 1) for _ in range(20_000)]
    fit = packing.BestFit(4096, 256)
    for n in lengths:
        fit.place(n)
        assert fit.open <= 256
    assert fit.made <= 1.02 * sum(lengths) / 4096


# ops 5, 7 and 10: pieces never change ids


def thue_morse(n=1024):
    """A word of a and b in Thue-Morse order and its complement, whose polynomial hashes modulo 2**64 are equal."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return ["".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)]


def awkward():
    rnd = random.Random(7)
    parts = [" ", " ", "слово", "，", "\n", ".", "'", ",a", "é.", "—", "÷", "a", "B", "'s", "1", "é", "\u0301", "\u00a0", "#", "\t", "ß", "中", "\x1f", "\u2003", "Σ", "İ", "<|endoftext|>", "\r\n", "😀"]
    return ["", *("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(2000))]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_keep_ids(name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    texts = [*awkward(), *thue_morse(), "<|endof", "text|>", "a<|endoftext|>", "<|endoftext|><|endoftext|> b", "<|startoftext|>x", "<|EndOfText|>"]
    for special in (True, False):
        t = Tokenizer.from_file(path)
        if not special:
            t.encode_special_tokens = True
        ids = _pieces.tokenizer_ids(path, public_tokenizers.PATTERN, special)
        got = []
        for _, s in X.slices(pa.array(texts), 5000):
            found, upto = ids.of(s)
            got += [found[a:b].tolist() for a, b in zip(upto[:-1], upto[1:])]
        assert got == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_spans_are_told_apart_whatever_their_hashes(monkeypatch):
    texts = [*thue_morse(), *thue_morse(), "a", "b", "", "a" * 65, "a" * 64 + "b", "x" * 9, "x" * 8 + "y"]
    monkeypatch.setattr(X, "mix", lambda x: np.zeros_like(x))  # all hashes of short spans are equal
    (_, s), *_ = X.slices(pa.array(texts))
    first, which = X.distinct(s.data, s.offsets[:-1], s.offsets[1:])
    assert [texts[first[w]] for w in which] == texts and len(first) == len(set(texts))


def test_words_of_one_weak_hash_stay_apart(spark):
    a, b = thue_morse()
    (_, s), *_ = X.slices(pa.array([f"{a}\n{b}"]))
    assert repetition.measure(s)["n_dup_lines"].tolist() == [0]
    got = {r.doc_id: r.kept for r in near_dedup.near_duplicates(table(spark, [a, b, a]), 3, 0.85).collect()}
    assert got == {0: True, 1: True, 2: False}


def test_byte_bpe(spark, texts, monkeypatch):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoding = byte_bpe.load(ranks, public_tokenizers.PATTERN)
    for text in awkward():
        assert [i for part in _pieces.halves(text, 3) for i in encoding.encode_ordinary(part)] == encoding.encode_ordinary(text)
    for text in ("слово да" * 50, "слово да " * 50, "中文字，" * 50, "ab1.c'd" * 50, "१२३ क" * 50):
        assert len(_pieces.halves(text, 20)) > 5
    assert _pieces.halves("中" * 100, 20) == ["中" * 100]  # one match
    long = "na so ist das, " * 8000
    got = byte_bpe.encode(table(spark, [*texts, long]), ranks, public_tokenizers.PATTERN)
    for r in byte_bpe.decode(got, ranks, public_tokenizers.PATTERN).collect():
        text = ([*texts, long][r.doc_id]) or ""
        ids = encoding.encode_ordinary(text)
        assert (r.ids, r.n_tokens, bytes(r.decoded)) == (ids, len(ids), text.encode())
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


# op 6


def test_licenses(spark):
    docs = [None, "", "Words. Released under the MIT License.", "LICENSED under the Apache-License, version 2.0!\nx", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Else. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the software.\nThe software is provided as is, without warranty of any kind.", "The software is provided as is, without warranty of any kind. Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", "He said: released under the MIT license", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."]
    got = {r.doc_id: (r.license, r.licenses) for r in licenses.scan_licenses(table(spark, docs)).collect()}
    assert [got[i][0] for i in range(len(docs))] == [None, None, "MIT", "Apache-2.0", "MIT", None, None, "MIT"]
    assert got[7][1] == ["MIT", "CC-BY-NC-4.0"]


def test_licenses_behind_long_rules(spark):
    docs = ["/" + "*" * 300 + " Released under the MIT License.", "-" * 9000 + "\tReleased" + " " * 5000 + "under the MIT License" + "=" * 700, "Released under the MIT License " + "x" * 400]
    got = {r.doc_id: r.license for r in licenses.scan_licenses(table(spark, docs)).collect()}
    assert [got[i] for i in range(len(docs))] == ["MIT", "MIT", None]


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
BSD2 = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY.
"""
BSD3 = BSD2.replace("""
THIS SOFTWARE""", """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE""")
ISC = """Copyright (c) 2020 Some One <one@example.org>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
LGPL = """    This library is free software; you can redistribute it and/or
    modify it under the terms of the GNU Lesser General Public
    License as published by the Free Software Foundation; either
    version 2.1 of the License, or (at your option) any later version.

    This library is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
    Lesser General Public License for more details.
"""
GPL3_TEXT = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble
"""
CC = "(c) Some One. This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.\n"
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
GPL2 = """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.
"""


def test_licenses_of_published_texts(spark):
    bsd2 = ["bsd-source", "bsd-binary", "bsd-as-is", "bsd-liable"]
    texts = {
        "MIT": (MIT, ["grant", "notice", "as-is", "mit-liable"]), "Apache-2.0": (APACHE, ["apache2-ref", "apache2-comply", "apache2-copy", "apache2-unless", "apache2-see"]),
        "BSD-2-Clause": (BSD2, bsd2), "BSD-3-Clause": (BSD3, [*bsd2[:2], "bsd-endorse", *bsd2[2:]]), "GPL-3.0-or-later": (GPL3, ["gpl-free", "v3-later"]), "GPL-2.0-or-later": (GPL2, ["gpl-free", "v2-later"]),
        "LGPL-2.1-or-later": (LGPL, ["lgpl-free", "v21-later", "gnu-useful", "gnu-no-warranty"]), "ISC": (ISC, ["isc-grant", "isc-as-is", "isc-liable"]), "MPL-2.0": (MPL, ["mpl2-form", "mpl2-copy"]),
        "GPL-3.0": (GPL3_TEXT, ["gpl3-head", "gnu-verbatim"]), "CC-BY-SA-4.0": (CC, ["cc-by-sa-4.0-ref"]),
    }
    forms = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.split("\n")) + " */\nint x;\n", lambda t: "".join(f"# {x}\n" for x in t.split("\n")), lambda t: " ".join(t.split())]
    cases = [(name, f(t)) for f in forms[:4] for name, (t, _) in texts.items()]
    whole = len(cases)
    cases += [(name, " ".join(t[t.index(start) :].split())) for name, t, start in (("MIT", MIT, "Permission"), ("Apache-2.0", APACHE, "Licensed"), ("BSD-2-Clause", BSD2, "Redistribution and"), ("GPL-3.0-or-later", GPL3, "This"), ("GPL-2.0-or-later", GPL2, "This"))]
    cases += [(None, MIT.replace("free of charge", "for a charge")), (None, GPL3.replace("General", "Greater General")), (None, "Permission\n\n" + BSD3.replace("must retain", "must\n\nretain")), ("MIT", "Words without a stop\nReleased under the\nMIT License\nmore words")]
    cases += [("BSD", BSD2[: BSD2.index("THIS SOFTWARE")]), ("GPL", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.")]
    got = {r.doc_id: (r.licenses, r.license, r.sentence_ids) for r in licenses.scan_licenses(table(spark, [t for _, t in cases])).collect()}
    for i, (name, text) in enumerate(cases):
        assert got[i][:2] == ([name] if name else [], name), text
        if i < whole:
            assert got[i][2] == texts[name][1], text
    twice = licenses.scan_licenses(table(spark, [MIT, MIT]).union(table(spark, [MIT]))).collect()
    assert len(twice) == 3 and {r.license for r in twice} == {"MIT"}
    assert licenses.scan_licenses(table(spark, [MIT]).limit(0)).count() == 0


# op 8


def grouped(texts, k, percent):
    sets = []
    for t in texts:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [(len(s), c, c == i) for i, (s, c) in enumerate(zip(sets, label))]


@pytest.mark.parametrize("k, similarity", [(3, 0.85), (5, 0.8)])
def test_near_duplicates(spark, texts, k, similarity, monkeypatch):
    monkeypatch.setattr(near_dedup, "PER_HUB", 4)
    monkeypatch.setattr(near_dedup, "PER_BLOCK", 8)
    monkeypatch.setattr(near_dedup, "PARTNERS", (1, 3, None))
    rnd = random.Random(8)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(120)]
    chain, own = [], list(base)
    for step in range(60):  # a chain whose neighbours are alike and whose ends are not
        own = list(own)
        own[(step * 2) % 120] = f"n{step}"
        chain.append(" ".join(own))
    docs = [*texts, *chain, *chain[:5], chain[0].upper()]
    found = near_dedup.near_duplicates(table(spark, docs), k, similarity)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert [got[i] for i in range(len(docs))] == grouped(docs, k, round(100 * similarity))


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c d"), (None, None), (3, "a b c d"), (3, "x y z w"), (7, "x y z w"), (9, ""), (9, "")]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(1))
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, 3, 0.85).collect())
    assert got == Counter([(None, 3, False), (None, None, True), (3, 3, True), (3, 3, True), (7, 3, False), (9, 9, True), (9, 9, True)])
    kept = near_dedup.keep_one_of_each(docs.where("doc_id is not null"), 3, 0.85)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 9]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_of_each_by_text(spark):
    rows = [(3, "a b c d"), (3, "x y z w"), (7, "x y z w"), (None, "a b c d"), (9, ""), (9, ""), (9, " "), (None, None), (None, None)]
    rows += [(None, "only under null ids")] * 50 + [(None, "e f g h"), (2, "e f g h"), (1, "i j k l"), (1, "i j k l")]
    docs = ship(spark).createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, digest string").repartition(5)
    kept = near_dedup.keep_one_of_each(docs, 3, 0.85, unique_ids=False)
    assert kept.columns == docs.columns
    want = [(3, "a b c d"), (3, "x y z w"), (9, ""), (9, " "), (None, None), (None, "only under null ids"), (2, "e f g h"), (1, "i j k l")]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)
    once = Counter(r.doc_id for r in near_dedup.keep_one_of_each(docs, 3, 0.85).collect())
    assert once == Counter([3, 9, None, None, 2, 1])


def test_texts_under_one_id_do_not_join_groups(spark):
    rnd = random.Random(9)
    a, b = ([f"{c}{rnd.randint(0, 999)}" for _ in range(100)] for c in "ab")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (6, " ".join([*a, "x"])), (8, " ".join([*b, "x"])), (7, " ".join([*a, "x", "y"]))]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string")
    kept = near_dedup.keep_one_of_each(docs, unique_ids=False).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(rows[:2])


@pytest.mark.parametrize("n", [30, 300, 3000, 30_000])
@pytest.mark.parametrize("similarity, passes", [(0.87, True), (0.6, False)])
def test_odd_sketches_separate(n, similarity, passes):
    rng = np.random.default_rng(n)
    for _ in range(20):
        same = int(2 * n * similarity / (1 + similarity))
        a, more = rng.permutation(2**40 + np.arange(4 * n) * 0x5DEECE66D)[: 2 * n].astype(np.uint64).reshape(2, n)
        a, more = X.mix(a), X.mix(more)
        b = np.concatenate([a[:same], more[: n - same]])
        odd = near_dedup.odd_sketches(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, n, 2 * n]))
        far = np.bitwise_count(odd[0] ^ odd[1]).sum()
        assert near_dedup.may_match(far, np.int64(n), np.int64(n), 0.85) == passes


# op 9


@pytest.mark.parametrize("block", [64, 1])
def test_marginals_are_exact(block, monkeypatch):
    from itertools import product

    monkeypatch.setattr(line_crf, "BLOCK", block)
    rng = np.random.default_rng(0)
    good, first, move = rng.normal(size=17), np.array([0, 3, 3, 7, 17]), rng.normal(size=(2, 2))
    p, expected, log_z = line_crf.marginals(good, first, move)
    total, moves = 0.0, np.zeros((2, 2))
    for a, b in ((0, 3), (3, 7), (7, 17)):
        z, acc, pairs = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for ys in product((0, 1), repeat=b - a):
            w = np.exp(sum(good[a + i] * y for i, y in enumerate(ys)) + sum(move[ys[i], ys[i + 1]] for i in range(b - a - 1)))
            z, acc = z + w, acc + w * np.array(ys)
            np.add.at(pairs, (ys[:-1], ys[1:]), w)
        assert np.allclose(p[a:b], acc / z)
        total, moves = total + np.log(z), moves + pairs / z
    assert np.isclose(total, log_z) and np.allclose(moves, expected)


def test_line_features_by_brute_force():
    rnd = random.Random(12)
    texts = ["", "\n", "A b b.\n\nC d!\nA b b.\n", *("".join(rnd.choice(["ab ", "C. ", "x\n", "9 ", "# ", "\n", "é ", "a|b! "]) for _ in range(rnd.randint(0, 40))) for _ in range(30))]
    (_, s), *_ = X.slices(pa.array(texts))
    got, weights = line_crf.lines(s), np.random.default_rng(2).normal(size=3 * line_crf.WIDTH)
    odds, at = got.odds(weights), 0
    for i, text in enumerate(texts):
        words = re.findall(WORD, text)
        three = Counter(tuple(words[j : j + 3]) for j in range(len(words) - 2))
        covered = {j + k for j in range(len(words) - 2) if three[tuple(words[j : j + 3])] > 1 for k in range(3)}
        real = [x for x in re.findall(r"[^\n]*\n|[^\n]+$", text) if re.search(WORD, x)]
        rows, seen = [], 0
        for line in real:
            own = re.findall(WORD, line)
            data = line.encode()
            kind = lambda test: sum(map(test, data))
            counts = [kind(lambda c: 65 <= c <= 90), kind(lambda c: 97 <= c <= 122 or c >= 128), kind(lambda c: 48 <= c <= 57), kind(lambda c: c in b"#*$%&<>"), data.count(b"!"), data.count(b"|")]
            letters = sum(len(w.encode()) for w in own)
            counts.append(letters - sum(counts))
            again = sum(j > 0 and words[j] == words[j - 1] for j in range(seen, seen + len(own)))
            rows.append([1, np.log1p(len(data)) / 5, *(min(1, 4 * c / letters) for c in counts), again / len(own), sum(j in covered for j in range(seen, seen + len(own))) / len(own), letters / len(own) / 10, real.count(line) > 1, "A" <= own[0][0] <= "Z", own[-1][-1] == ".", counts[3] + counts[4] + counts[5] > 0, counts[2] > 0, len(own) < 4])
            seen += len(own)
        assert got.first[i + 1] - got.first[i] == len(rows)
        if rows:
            own = np.array(rows, float)
            assert np.allclose(got.own[at : at + len(rows)], own, atol=1e-6), text
            none = np.zeros((1, own.shape[1]))
            full = np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none])])
            assert np.allclose(odds[at : at + len(rows)], full @ weights, atol=1e-4)
            error = np.random.default_rng(3).normal(size=len(odds))
        at += len(rows)
    step = 1e-3
    for j in (0, 20, 50):
        moved = weights.copy()
        moved[j] += step
        assert np.isclose(got.slope(error)[j], ((got.odds(moved) - odds) / step * error).sum(), atol=0.05)


def test_quality_on_held_out(spark):
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8)))
    good = lambda: "\n".join(" ".join(word() for _ in range(9)) + "." for _ in range(rnd.randint(1, 6)))
    bad = lambda: "\n".join(" ".join(word() + rnd.choice(["###", "$$$", "!!"]) for _ in range(9)) for _ in range(rnd.randint(1, 6)))
    docs = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(400)] + [(500, None, 1), (501, "", 0), (502, "\n \n", 0)]
    labels = ship(spark).createDataFrame([(i, q) for i, _, q in docs], "doc_id long, quality int")
    frame = spark.createDataFrame([(i, t, "x") for i, t, _ in docs], "doc_id long, text string, score string")
    rows = line_crf.score_documents(frame, line_crf.train(frame, labels)).collect()
    assert len(rows) == len(docs)
    label = {i: q for i, _, q in docs}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id < 500]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)
    untrained = line_crf.train(frame, labels.limit(0))
    assert {r.score for r in line_crf.score_documents(frame, untrained).where("doc_id < 500").collect()} == {0.5}


# op 10


def test_token_store(spark, texts, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "DOCS_PER_RANGE", 20)
    monkeypatch.setattr(token_store, "DOCS_PER_BLOCK", 7)
    monkeypatch.setattr(token_store, "CHUNK", 2)
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = [*texts, "hello <|endoftext|> world", *thue_morse()]
    store = token_store.write_store(table(spark, texts), path, public_tokenizers.PATTERN, end_id=2)
    got = {r.id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.read_store(*store).collect()}
    upto = 0
    for i, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert got[i] == (upto, len(ids), zlib.crc32(array("I", ids).tobytes()))
        upto += len(ids)
        if i % 17 == 0:
            assert [x.tolist() for x in token_store.read_document(*store[:2], i)] == [ids]
    empty = token_store.write_store(table(spark, texts).limit(0), path, public_tokenizers.PATTERN, end_id=2)
    assert token_store.read_store(*empty).count() == 0


def test_token_store_with_null_and_repeated_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = ship(spark).createDataFrame([(5, "b"), (None, "a"), (5, "b"), (2, None)], "doc_id long, text string")
    rows = sorted(token_store.read_store(*token_store.write_store(docs, path, public_tokenizers.PATTERN, end_id=2)).collect(), key=lambda r: r.start)
    assert [(r.id, r.start, r.n_tokens) for r in rows] == [(None, 0, 2), (2, 2, 1), (5, 3, 2), (5, 5, 2)]


def test_one_id_of_many_rows_is_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(token_store, "DOCS_PER_RANGE", 50)
    rows = [(7 if i % 3 else None, "same words" if i % 2 else f"words {i}", "clash") for i in range(600)] + [(9, "end", "clash")]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(4)
    shared, blocks, ranges = token_store.write_store(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2)
    assert max(r.n for r in blocks.groupBy("range_no").agg(F.sum("n_docs").alias("n")).collect()) < 300
    got = sorted((r.start, r.n_tokens, r.id) for r in token_store.read_store(shared, blocks, ranges).collect())
    assert len(got) == 601 and [s for s, _, _ in got] == [sum(n for _, n, _ in got[:i]) for i in range(601)]
    assert [i for _, _, i in got] == [None] * 200 + [7] * 400 + [9]
    assert len(token_store.read_document(shared, blocks, 7)) == 400 and token_store.read_document(shared, blocks, 8) == []


def test_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(token_store, "CHUNK", 3)
    totals = spark.range(0, 90, 2).select(F.col("id").alias("no"), (F.col("id") % 7).alias("n"))
    got = {r.no: r.base for r in token_store.prefix_sums(totals).collect()}
    assert got == {i: sum(j % 7 for j in range(0, i, 2)) for i in range(0, 90, 2)}


def test_dictionary_of_few_samples():
    assert token_store.train_dictionary([]) == b"" and token_store.train_dictionary([b"abc"] * 3) == b"abcabcabc"
    c, d = token_store._codec(token_store.train_dictionary([b"a few words here"] * 3))
    assert d.decompress(c.compress(b"a few words here")) == b"a few words here"


# Empty tables, repeated rows and clashing columns


def test_byte_bpe_of_empty_and_repeated_rows(spark):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, ["a b", None]).union(table(spark, ["a b"])).withColumn("n_tokens", F.lit("clash"))
    got = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, r.n_tokens, len(r.ids)) for r in got) == [(0, 2, 2), (0, 2, 2), (1, 0, 0)]
    none = byte_bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN)
    assert none.count() == 0 and byte_bpe.decode(none, ranks, public_tokenizers.PATTERN).count() == 0


def test_quality_of_empty_and_repeated_rows(spark):
    model = line_crf.Model(np.zeros(3 * line_crf.WIDTH), np.zeros((2, 2)), 0.0, 0.0)
    docs = table(spark, ["a line", None, ""]).union(table(spark, ["a line"])).withColumns({"held_out": F.lit("clash"), "predicted": F.lit(7)})
    got = sorted((r.doc_id, r.score, r.predicted) for r in line_crf.score_documents(docs, model).collect())
    assert got == [(0, 0.5, 1), (0, 0.5, 1), (1, 0.0, 0), (2, 0.0, 0)]
    kept = line_crf.keep_good(docs, model)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.held_out, r.predicted) for r in kept.collect()) == [(0, "clash", 7)] * 2
    assert line_crf.score_documents(docs.limit(0), model).count() == line_crf.keep_good(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    assert line_crf.train(docs.limit(0), labels).slope == 0.0


def test_bounds_of_the_line_model(spark):
    """Whole documents within the bound of lines, in the order of a hash."""
    docs = table(spark, ["good words here.\n" * 5, "### $$$ !!!\n" * 7] * 20)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    assert line_crf.train(docs, labels, most_lines=1).slope == 0.0  # no document fits
    assert line_crf.train(docs, labels, most_lines=100).slope != 0.0


def test_repetition_of_one_very_long_text():
    words = [f"w{i}" for i in range(60_000)]
    (_, s), *_ = X.slices(pa.array([" ".join([*words, *words[100:400]])]))
    got = {c: int(v[0]) for c, v in repetition.measure(s).items()}
    assert (got["n_words"], got["covered_words"], got["longest_repeat"], got["n_repeat_words"]) == (60_300, 600, 300, 600)


def test_kept_rows_keep_columns_that_clash(spark):
    rows = [(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (3, "other words", "z")]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, bucket string").withColumns({"label": F.lit(1), "id": F.lit(2), "group": F.lit(3), "_n": F.lit(4)})
    kept = near_dedup.keep_one_of_each(docs, unique_ids=False)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [(1, "a b c d e f", "x", 1, 2, 3, 4), (3, "other words", "z", 1, 2, 3, 4)]
