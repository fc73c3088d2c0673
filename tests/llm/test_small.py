"""Each operator on small tables: nulls, empty texts, ties, repeated rows, clashing names, no rows."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm import (
    ann, common, components, exact_dedup, files, licenses, lm, mixing, near_dedup, packing, token_files, toxicity, warc,
)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ("kept", "score", "row", "place", "mark", "node", "size", "Bucket", "_row_id")],
])
LONG = " ".join(f"word{i % 997} other{i}" for i in range(30_000))
ROWS = [
    (1, "One two three four five six", "a"), (2, "one TWO three four five six", "a"), (3, None, None), (4, "", "b"),
    (5, " \t\n", "b"), (6, "lonely", "c"), (6, "lonely", "c"), (None, "lonely", "c"), (None, None, "c"), (7, LONG, "a"),
    (8, LONG + " more", "a"), (9, "É é naïve", "ä"), (10, "é   x", "ä"), (11, "You are an idiot", "a"),
]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, *["x"] * (len(schema) - len(r))) for r in rows], schema)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS)


def words(text):
    return (text or "").encode().lower().split()


def lower(text):
    return (text or "").encode().lower()


def test_word_hashes_are_those_of_the_words():
    texts = [lower(t) for _, t, _ in ROWS] + [b"x" * 3_000_000 + b" y x", b"a\x0bb\x0cc\x1cd"]
    hashes, begins = common.word_hashes(texts)
    known = {}
    for i, t in enumerate(texts):
        own = hashes[begins[i]:begins[i + 1]]
        assert len(own) == len(t.split())
        for w, h in zip(t.split(), own, strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_exact_dedup(docs):
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs).collect()), key=str)
    best, size = {}, Counter(lower(t) for _, t, _ in ROWS)
    for i, t, _ in ROWS:
        best[lower(t)] = max(best.get(lower(t), -1), -1 if i is None else i)
    want = [
        (i, best[lower(t)] if best[lower(t)] >= 0 else None, size[lower(t)], i == (best[lower(t)] if best[lower(t)] >= 0 else None),
         hashlib.sha256(lower(t)).hexdigest()) for i, t, _ in ROWS
    ]
    assert got == sorted(want, key=str)


def test_runs_merge_to_the_same_groups_at_any_width(spark, monkeypatch):
    table = frame(spark, [(i, f"text {i % 37}", "s") for i in range(500)]).repartition(9)
    monkeypatch.setattr(exact_dedup, "ROWS_PER_CELL", 7)
    groups = exact_dedup.exact_dedup(table).groupBy("keep_id", "group_size").count().collect()
    assert sorted(tuple(r) for r in groups) == sorted(
        (max(range(k, 500, 37)), len(range(k, 500, 37)), len(range(k, 500, 37))) for k in range(37)
    )


def test_rows_that_stay_keep_their_columns(docs):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(lower(r.text) for r in kept.collect()) == Counter({lower(t) for _, t, _ in ROWS})


def naive_components(rows, size):
    sets = []
    for _, t, _ in rows:
        w = words(t)
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common_ = len(sets[i] & sets[j])
            if sets[i] and 100 * common_ >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    ids = [-1 if i is None else i for i, _, _ in rows]
    least = {r: min(ids[k] for k in range(len(rows)) if root[k] == r) for r in root}
    return [(rows[k][0], len(sets[k]), None if least[root[k]] < 0 else least[root[k]]) for k in range(len(rows))]


@pytest.mark.parametrize("size", [2, 5])
def test_near_dedup(docs, size):
    got = near_dedup.near_dedup(docs, words=size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(naive_components(ROWS, size), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_follows_chains_and_cuts_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(40):  # each differs a little more from the first, some too much
        text = [f"v{k}" if i < k // 3 else w for i, w in enumerate(base)]
        rows.append((k, " ".join(text), "s"))
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(frame(spark, rows), words=2).collect()}
    assert got == {i: c for i, _, c in naive_components(rows, 2)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(40, 41), (42, 41), (50, 50)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 42: 40}


def test_mix(docs):
    got = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in ROWS)
    total = sum(len(words(t)) for _, t, _ in ROWS)
    assert math.isclose(sum({(r.source_size, r.target) for r in got} and [
        t for t in {s: next(r.target for r in got if r.source_size == s) for s in {r.source_size for r in got}}.values()
    ]), total)
    for r in got:
        assert r.taken <= 3 * r.size
    again = mixing.mix(docs).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(tuple(r)[:5] for r in again)


def test_targets_stop_at_three_times_a_source(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 700, None: 3}
    found = mixing.targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")).collect()
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    goal, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        for s in full or open_:
            goal[s] = 3.0 * sizes[s] if full else level * weight[s]
        left -= sum(goal[s] for s in full)
        open_ = open_ - full if full else set()
    assert {r.source: pytest.approx(r.target) for r in found} == goal


def test_small_sources_are_taken_to_their_targets(spark):
    sizes = {"a": 20_000, **{f"s{k:02d}": n for k, n in enumerate([1, 2, 7, 30, 100, 400, 700, 1500])}}
    rows = [(i, " ".join(["w"] * min(50, n - at)), s) for s, n in sizes.items() for i, at in enumerate(range(0, n, 50))]
    taken, target = Counter(), {}
    for r in mixing.mix(frame(spark, rows), slot_bits=4).collect():
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert set(target) == set(sizes.values())
    assert all(abs(taken[n] - target[n]) <= 0.5 for n in target)
    assert all(target[n] == 3 * n for n in target if n < 1500)


def test_bounds_are_the_best_there_are():
    import itertools
    rng = np.random.default_rng(3)
    for _ in range(30):
        bins = np.sort(rng.choice(np.arange(1, 40), 7, replace=False))
        counts = rng.integers(1, 9, 7)

        def cost(bounds, bins=bins, counts=counts):
            return sum(n * min(b for b in bounds if b >= x) for x, n in zip(bins, counts, strict=True))

        least = min(cost([*c, bins[-1]]) for k in range(3) for c in itertools.combinations(bins[:-1], k))
        assert cost(packing.best_bounds(bins, counts, 3)) == least


def test_pack(docs):
    got = packing.pack(docs, buckets=3, budget=40).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len(words(t))) for i, t, _ in ROWS)
    assert len({(r.bucket_tokens, r.batch, r.slot) for r in got}) == len(got)
    for r in got:
        assert r.n_tokens <= r.bucket_tokens and r.slot < r.batch_docs == max(1, 40 // max(1, r.bucket_tokens))


def test_score_is_that_of_the_model(docs):
    got = {(r.doc_id, r.n_tokens): r for r in lm.score(docs).collect()}
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _, _ in ROWS]
    tokens = [[*words(t), None] for _, t, _ in ROWS]
    count = Counter(w for h, t in zip(held, tokens, strict=True) if not h for w in t)
    pairs = Counter(p for h, t in zip(held, tokens, strict=True) if not h for p in zip(["<"] + t[:-1], t, strict=True))
    ways = Counter(w for _, w in pairs)
    d, e = (lm._discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]) for c in (pairs, ways))
    total, after = Counter(), {}
    for (v, _), n in pairs.items():
        total[v] += n
        after.setdefault(v, [0, 0, 0])[min(n, 3) - 1] += 1
    left = sum(e[min(n, 3) - 1] for n in ways.values()) / len(pairs)

    def lower_order(w):
        return (ways[w] - (e[min(ways[w], 3) - 1] if ways[w] else 0)) / len(pairs) + left / (len(count) + 1)

    def chance(v, w):
        if not total[v]:
            return lower_order(w)
        n = pairs[v, w]
        back = sum(x * k for x, k in zip(d, after[v], strict=True)) / total[v]
        return (n - (d[min(n, 3) - 1] if n else 0)) / total[v] + back * lower_order(w)

    whole, size = sum(count.values()), len(count)
    for (i, _, _), h, t in zip(ROWS, held, tokens, strict=True):
        r = got[i, len(t)]
        assert (r.held_out, r.train_tokens, r.n_known) == (h, whole, sum(count[w] > 0 for w in t))
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 0.1) / (whole + 0.1 * (size + 1))) for w in t), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(chance(v, w)) for v, w in zip(["<"] + t[:-1], t, strict=True)), rel_tol=1e-9)


def test_a_chain_has_the_marginals_of_all_its_labellings():
    import itertools
    rng = np.random.default_rng(0)
    odds, step, start = rng.uniform(0.1, 4, 6), rng.uniform(0.2, 3, (2, 2)), 0.7
    begins = np.array([0, 4, 4, 5, 6])
    left, right = toxicity.forward_backward(odds, begins, start, step)
    for a, b in zip(begins[:-1], begins[1:], strict=True):
        mass = np.zeros((2, b - a))
        for y in itertools.product([0, 1], repeat=b - a):
            if y:
                p = np.prod([start if y[0] else 1.0] + [odds[a + i] if k else 1.0 for i, k in enumerate(y)]
                            + [step[y[i - 1], y[i]] for i in range(1, len(y))])
                for i, k in enumerate(y):
                    mass[k, i] += p
        assert np.allclose((left * right)[a:b], mass[1] / mass[0])


def test_toxicity_learns_words_and_marks_them(spark):
    rng = np.random.default_rng(1)
    plain = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        text, bad = list(rng.choice(plain, 30)), i % 5 == 0
        if bad:
            text[7] = "Idiot"
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(bad)))
    rows += [(900, None, "s"), (None, "", "s"), (901, "word1 IDIOT! word2 idiot", "s")]
    got = {r.doc_id: r for r in toxicity.toxicity(
        frame(spark, rows), spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")).collect()}
    wrong = [i for i, y in labels if got[i].predicted != y]
    assert len(wrong) <= 4 and got[901].predicted == 1
    assert got[900].score == got[None].score == min(r.score for r in got.values())
    assert [(s.begin, s.end) for s in got[901].spans][-1] == (19, 24)
    none = toxicity.toxicity(frame(spark, rows), spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert all(r.predicted == 0 and 0 <= r.score <= 1 for r in none)


def test_token_files(docs):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    got = sorted((tuple(r) for r in token_files.encode_files(docs, VOCABULARY).collect()), key=lambda r: r[1])
    assert [-1 if r[0] is None else r[0] for r in got] == sorted(-1 if i is None else i for i, _, _ in ROWS)
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t, _ in ROWS}
    want = Counter((i, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for i, t, _ in ROWS)
    assert Counter((i, n, c) for i, _, n, c in got) == want
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]


def test_pieces_have_the_ids_of_the_whole_text(monkeypatch):
    import random
    random.seed(5)
    parts = ["a", "½", "²", "_", "'", ",", "\n\n", " w", "don't", "\u0301", "\u200b", "😀", " ", "  ", "\n", "\t", " b", "'s", "1", "é", " ", "　", ".", "\x1c", "中", "\r\n", "\x85", "<|endoftext|>"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 9))) for _ in range(5000)]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    encoder = token_files.Encoder(VOCABULARY, "<u2")
    raw = [t.encode() for t in texts]
    # Known from one batch to the next, and after all is forgotten.
    got = encoder(raw[:2000]) + encoder(raw[2000:])
    monkeypatch.setattr(token_files, "KNOWN_PIECES", 0)
    assert encoder(raw) == got
    assert encoder([]) == [] and encoder([b""]) == [b"\0\0"]
    assert got == [np.array([*e.ids, 0], "<u2").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_have_the_ids_of_the_plain_call():
    import random
    random.seed(6)
    parts = ["a", " w", "  ", " ", "\n", "\n\n", "don't", "'s", ".", "1", "é", "\t", "<|endof", "text|>", "<|endoftext|>", "<|endoftext|>"]
    texts = ["one<|endoftext|>two", "<|endoftext|>", "", *("".join(random.choices(parts, k=random.randint(0, 9))) for _ in range(5000))]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    got = token_files.encoder(VOCABULARY, "<u2")([t.encode() for t in texts])
    assert got[0] == np.array([505, 50256, 11545, 0], "<u2").tobytes()
    assert got == [np.array([*e.ids, 0], "<u2").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_one_document_is_read_by_its_index_entry(docs, tmp_path):
    written = token_files.write_files(docs, f"file://{tmp_path}/t", VOCABULARY, docs.count()).collect()
    found = [x for r in written for x in token_files.read_file(r.file, wanted={9})]
    assert [f[0] for f in found] == [9]


PAGES = [(i, f"http://x/{i}", f"<p>{i}</p>") for i in range(5)] + [
    (10, "http://x/\r\nä", "é" * 600), (11, None, "é" * 600), (12, "u", "é" * 600), (12, "u", "é" * 600), (None, "u", "é" * 600),
    (13, "u", "é" * 499), (14, "u", "é" * 499), (15, "u", None), (16, "u", ""), (17, "u", "WARC/1.1\r\n\r\n" * 100_000),
]


def test_archive(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, response string")
    got = sorted((tuple(r) for r in warc.archive(pages).collect()), key=str)
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        most = max([-1 if j is None else j for j, _, g in PAGES if (g or "").encode() == raw])
        revisit = len(raw) >= 1000 and i != most
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", most if revisit else None))
    assert got == sorted(want, key=str)


def test_a_record_is_read_from_its_frame(tmp_path):
    name = f"file://{tmp_path}/b.warc.zst"
    with files.written(name) as out:
        bundle = warc.BundleWriter(out)
        for i in range(40):
            bundle.add(warc.record_id(i), warc.record(i, "u", b"%d" % i * 20_000, None))
        bundle.close()
    assert len(bundle.frames) > 2
    (found,) = warc.read_bundle(name, wanted={warc.record_id(33)})
    assert warc.parse(found)[2] == b"33" * 20_000
    import zstandard
    with open(f"{tmp_path}/b.warc.zst", "rb") as raw:  # and by any reader, as one stream
        assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read().count(b"WARC/1.1") == 40


def test_search(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)) * rng.uniform(0.5, 2, (300, 1))
    x[50:90] = x[20]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(400, None, "x"), (420, [0.0] * 8, "x"), (440, [float("nan")] + [1.0] * 7, "x"), (460, [None] + [1.0] * 7, "x"), (None, [1.0] * 8, "x")]
    got = ann.search(spark.createDataFrame([*rows, rows[20]], "vec_id long, embedding array<double>, node string"), probes=64).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(found) == set(range(0, 300, 20))
    for q, listed in found.items():
        scores = (x * x[q]).sum(axis=1)
        best = [int(i) for i in np.lexsort((np.arange(300), -scores)) if i != q][:20]
        assert sorted(listed) == list(zip(range(1, 21), best, strict=True))


@pytest.mark.parametrize("kind", ["one long", "log-normal", "far apart"])
def test_search_finds_the_nearest_of_unequal_length(spark, kind):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "one long":
        x[-1] *= 100
    else:
        x *= np.exp(rng.normal(size=(3000, 1))) if kind == "log-normal" else 10.0 ** rng.choice([-200, 0, 100], (3000, 1))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 20):
        scores = (x * x[q]).sum(axis=1)
        scores[q] = -np.inf
        assert len(found[q]) == 20
        hits += len(found[q] & set(np.argsort(-scores, kind="stable")[:20].tolist()))
    assert hits >= 0.95 * 20 * 150


def test_licences(spark):
    mit = f"{licenses.SENTENCES['mit-grant']}:\n\n{licenses.SENTENCES['mit-notice']}.\n\n{licenses.SENTENCES['as-is']}."
    wrapped = "\n".join(mit[i:i + 60] for i in range(0, len(mit), 60)) if False else mit.replace(" of ", "\nof ")
    texts = {
        1: "Some prose. Licensed under the Apache License, Version 2.0.", 2: "Licensed  under CC BY-NC 4.0.\nReleased under the MIT License.\nx",
        3: wrapped, 4: None, 5: "", 6: "Not licensed under the MIT license at all", 7: "prose without a mark\nThis work is licensed under the GNU "
        "General Public License, version 3.\nprose", 8: "LICENSED UNDER THE MIT LICENSE",
    }
    rows = frame(spark, [(i, t, "s") for i, t in texts.items()])
    got = {r.doc_id: (r.licences, r.n_sentences) for r in licenses.scan(rows).collect()}
    assert got == {
        1: (["Apache-2.0"], 1), 2: (["CC-BY-NC-4.0", "MIT"], 2), 3: (["MIT"], 3), 4: ([], 0), 5: ([], 0), 6: ([], 0),
        7: (["GPL-3.0-only"], 1), 8: (["MIT"], 1),
    }


FREE = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1}

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
NOTICE = """
The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
AS_IS = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software"""
PUBLIC = {  # a notice for each rule, in the order of the rules
    BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""": "BSD-3-Clause",
    BSD: "BSD-2-Clause",
    GRANT + NOTICE + AS_IS: "MIT",
    GRANT + NOTICE: "MIT",
    APACHE: "Apache-2.0",
    FREE.format(";", "; either version 2\nof the License, or (at your option) any later version."): "GPL-2.0-or-later",
    FREE.format(":", ", either version 3 of the License, or\n(at your option) any later version."): "GPL-3.0-or-later",
    APACHE.partition("you may")[0]: "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License. See License.txt in the project root.": "MIT",
    FREE.format(";", "; either version 2\nof the License, or (at your option) any later version.").partition("This program is dis")[0]: "GPL-2.0-or-later",
    FREE.format(":", ", either version 3 of the License, or\n(at your option) any later version.").partition("This program is dis")[0]: "GPL-3.0-or-later",
    FREE.format(":", ", version 3 of the License."): "GPL-3.0-only",
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed": "MPL-2.0",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
    "copyright notice and this permission notice appear in all copies.": "ISC",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
    "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view": "CC-BY-SA-4.0",
    "This work is licensed under CC BY 4.0. To view a copy of this license, visit": "CC-BY-4.0",
    "To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring rights to this software to the public domain\nworldwide.": "CC0-1.0",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
    "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.": "LGPL-2.1-or-later",
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published\n"
    "by the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.": "AGPL-3.0-or-later",
    "// SPDX-License-Identifier: MIT": "MIT",
    "/* SPDX-License-Identifier: Apache-2.0 */": "Apache-2.0",
    "# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
    "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0-only",
    "SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0-or-later",
    "SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
    "Copyright 2020 Somebody. All rights reserved.": "all-rights-reserved",
}


def test_every_rule_matches_the_public_notice():
    recogniser = licenses.Recogniser()
    assert list(PUBLIC.values()) == [r[0] for r in licenses.RULES]
    for (text, licence), (_, rule) in zip(PUBLIC.items(), licenses.RULES, strict=True):
        for notice in (text, "\n".join(f" * {line}" for line in text.split("\n"))):
            names = [n for n, _ in recogniser.sentences(notice)]
            assert [x[0] for x in recogniser.licences(names)] == [licence], notice
            assert names[:len(rule)] == rule


def test_other_known_sentences_may_stand_between_those_of_a_rule():
    recogniser = licenses.Recogniser()

    def found(*names):
        return [x for x, _, _ in recogniser.licences(list(names))]

    assert found("mit-grant", "reserved", "mit-notice") == ["MIT", "all-rights-reserved"]
    assert found("mit-grant", "reserved", "reserved", "mit-notice", "as-is") == ["MIT", "all-rights-reserved", "all-rights-reserved"]
    assert "MIT" not in found("mit-grant", "reserved", "reserved", "reserved", "mit-notice")
    assert found("mit-grant", "mit-grant", "mit-notice", "mit-notice") == ["MIT", "MIT"]
    tight = licenses.Recogniser(rules=[("MIT", ["mit-grant", "mit-notice"], 0)])
    assert tight.licences(["mit-grant", "reserved", "mit-notice"]) == []


@pytest.mark.parametrize("line", [
    "Съешь ещё этих мягких французских булок. ", "! ", "All rights reserved. ", "permission\n", "the\n\n\n", "\u3042\u3002", "a", " ",
])
def test_the_scan_takes_time_in_proportion_to_the_text(line):
    recogniser, text = licenses.Recogniser(), line * (1_000_000 // len(line))
    began = time.process_time()
    found = recogniser.sentences(text + "\nReleased under the MIT License")
    assert time.process_time() - began < 8  # about 1 s a MB where nothing else runs
    assert found[-1][0] == "mit-name" and (len(found) > 1) == line.startswith("All")


def plain_sentences(text):
    """Every run of pieces of the text against every known sentence, the longest first."""
    cut = [p for p in re.split(r"(?<=[.!?;:])\s+|\n", text) if licenses.normalise(p)]
    known, found, i = licenses.Recogniser().known, [], 0
    while i < len(cut):
        for j in range(len(cut), i, -1):
            name = known.get(" ".join(licenses.normalise(p) for p in cut[i:j]))
            if name:
                found.append(name)
                i = j - 1
                break
        i += 1
    return found


def test_the_scan_finds_what_a_plain_comparison_finds(spark, sf_dir):
    notices = list(PUBLIC)
    mixed = [(i, "Intro. Words! ".join(notices[(i + k) % len(notices)] + "\n" for k in range(1 + i % 4))) for i in range(40)]
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r.text) < 4000]
    for table in (mixed, given):
        got = {r.doc_id: r.sentences for r in licenses.scan(spark.createDataFrame(table, "doc_id long, text string")).collect()}
        assert got == {i: plain_sentences(t) for i, t in table}
        assert any(got.values())


def test_a_sentence_may_be_wrapped_over_any_number_of_lines():
    import textwrap
    recogniser, want = licenses.Recogniser(), ["mit-grant", "mit-notice", "as-is"]
    parts = [" ".join(t.split()) for t in (GRANT, NOTICE, AS_IS)]
    for text in [
        (GRANT + NOTICE + AS_IS).replace("\n", "\n\n"), (GRANT + NOTICE + AS_IS).replace("\n", "\n" * 50),
        *["\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in parts) for width in (36, 20, 1)],
    ]:
        assert [n for n, _ in recogniser.sentences(text)] == want
    assert recogniser.sentences("Permission is hereby granted" + "\n" * 100_000) == []


def test_empty_tables_give_no_rows(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for df in [
        exact_dedup.exact_dedup(none), near_dedup.near_dedup(none), mixing.mix(none), packing.pack(none), lm.score(none),
        licenses.scan(none), toxicity.toxicity(none, labels), token_files.encode_files(none, VOCABULARY),
        warc.archive(spark.createDataFrame([], "page_id long, url string, html string")),
        ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ]:
        assert df.count() == 0


def twins(steps):
    """The Thue-Morse word of 2^steps letters and its complement, which many polynomial hashes take for one."""
    word, swap = "a", str.maketrans("ab", "ba")
    for _ in range(steps):
        word += word.translate(swap)
    return word, word.translate(swap)


@pytest.mark.parametrize("steps", [3, 4, 5, 6, 10, 11, 12])
def test_structured_words_have_hashes_of_their_own(steps):
    hashes, _ = common.word_hashes([w.encode() for w in twins(steps)])
    assert len(set(hashes.tolist())) == 2


def test_pieces_that_share_a_hash_have_their_own_ids(monkeypatch):
    texts = [*twins(10), " one two", "two one ", "a b", "b a"]
    want = [np.array([*e.ids, 0], "<u2").tobytes() for e in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    raw = [t.encode() for t in texts]
    assert token_files.Encoder(VOCABULARY, "<u2", added=True)(raw) == want
    monkeypatch.setattr(token_files, "run_hashes", lambda data, first, last: (last - first).astype(np.uint64))
    encoder = token_files.Encoder(VOCABULARY, "<u2", added=True)
    assert encoder(raw) == want and [encoder([t])[0] for t in raw] == want


def test_words_made_to_collide_link_no_texts(spark):
    rows = [(i, w, "s") for i, w in enumerate(w for steps in (10, 11, 12) for w in twins(steps))]
    assert all(r.kept for r in near_dedup.near_dedup(frame(spark, rows), words=2, percent=80).collect())


@pytest.mark.parametrize("n", [1, 12, 30])
def test_search_finds_all_candidates_of_small_tables(spark, n):
    x = np.random.default_rng(4).normal(size=(n, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(table).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    for q in range(0, n, 20):
        scores = (x * x[q]).sum(axis=1)
        best = [int(i) for i in np.lexsort((np.arange(n), -scores)) if i != q][:20]
        assert sorted(found.get(q, [])) == list(zip(range(1, len(best) + 1), best, strict=True))


def test_search_over_components_of_four_bytes_scores_in_double(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert dict(ann.valid(table).dtypes)["vector"] == "array<float>"
    ids, x = map(np.array, zip(*((r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect()), strict=True))
    x, found = x.astype(np.float64), {}
    for r in ann.search(table, probes=64).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    for q, listed in found.items():
        scores = (x * x[ids == q]).sum(axis=1)
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        assert [v for _, v, _ in sorted(listed)] == [int(ids[i]) for i in best]
        assert np.allclose([s for _, _, s in sorted(listed)], scores[best], rtol=0, atol=1e-14)


@pytest.mark.parametrize("block", [ann.BLOCK, 100])
def test_ties_of_unlike_vectors_go_to_the_smaller_id(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERY_BLOCK", block // 4)
    x = np.random.default_rng(5).choice([-1.0, 1.0], (1500, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(table, tables=2, probes=64).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    for q in range(0, 1500, 20):
        scores = x @ x[q]
        best = [int(i) for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        assert sorted(found[q]) == list(zip(range(1, 21), best, strict=True))


def test_packing_pads_to_the_longest_of_a_bucket(spark):
    import itertools
    sizes = [1, 1, 2, 3, 7, 9, 600, 701, 701, 1001, 4003, 4003]
    got = packing.pack(frame(spark, [(i, "w " * n, "s") for i, n in enumerate(sizes)]), buckets=3).collect()
    assert {r.bucket_tokens for r in got} <= set(sizes)
    rest = sorted(set(sizes))
    least = min(sum(min(b for b in (*c, rest[-1]) if b >= n) for n in sizes) for c in itertools.combinations(rest[:-1], 2))
    assert sum(r.bucket_tokens for r in got) == least


def test_texts_of_one_template_are_not_all_toxic(spark):
    text = "dear {} the meeting of the group is on monday in the large room"
    rows = [(i, text.format(f"idiot name{i}" if i % 10 == 0 else f"name{i}"), "s") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(400)], "doc_id long, toxic int")
    rows = [(i, t + " all rights of this page are with the house that made it", s) for i, t, s in rows]
    table = frame(spark, rows)
    taught = {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert toxicity.sample(table, labels, toxicity.Fit()).count() == len(taught)
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(table, labels).collect()}
    assert got == {i: int(i % 10 == 0) for i in range(400)}


def test_toxicity_without_anything_to_tell_texts_apart_marks_none(spark):
    rows = [(i, f"plain words number{i}", "s") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert not any(r.predicted for r in toxicity.toxicity(frame(spark, rows), labels).collect())
    all_ = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    assert not any(r.predicted for r in toxicity.toxicity(frame(spark, rows), all_).collect())


def test_rows_that_differ_beside_id_and_text_all_stay(spark):
    rows = [(None, "one text", "a"), (None, "one text", "b"), (3, "one text", "a"), (3, "one text", "b")]
    table = frame(spark, rows)
    stay = toxicity.drop_toxic(table, spark.createDataFrame([], "doc_id long, toxic int"))
    assert Counter((r.doc_id, r.source) for r in stay.collect()) == Counter((i, s) for i, _, s in rows)
