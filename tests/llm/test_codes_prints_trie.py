"""Vector codes, I-Match fingerprints and the prefix trie on small tables, against brute force."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import imatch, prefix_trie, vector_codes

INF, NAN = float("inf"), float("nan")
VECTORS = "vec_id long, embedding array<float>, label int, code string, error string, `_x` string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", "x") for r in rows], VECTORS)


def naive_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    cuts = [p * width // parts for p in range(parts + 1)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in zip(cuts, cuts[1:], strict=False)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                own[nearest(v[a:b], books[p])[1]].append(v[a:b])
            books[p] = [[sum(c) // len(c) for c in zip(*o, strict=True)] if o else e for o, e in zip(own, books[p], strict=True)]
    out = []
    for i, v, label in kept:
        found = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    text = ",".join(str(x) for book in books for e in book for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [(i, label, code, e, sum(x[3] for x in out if x[1] == label), sha) for i, label, code, e in out]


def some_vectors(n, width, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=width) / math.sqrt(width)).astype(np.float32).tolist(), int(i % 3) if i % 4 else None) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [None] * width, 1), (n + 2, [NAN] + [0.0] * (width - 1), 1), (n + 3, [INF] + [0.0] * (width - 1), 1),
             (n + 4, [0.0] * width, 2), (None, [0.25] * width, 2), (3, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]
    return rows


@pytest.mark.parametrize("n, width", [(120, 16), (5, 16), (60, 11), (40, 3)])
def test_vector_codes(spark, n, width):
    rows = some_vectors(n, width)
    got = vector_codes.encode(vectors(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(naive_codes(rows), key=str)


def test_vector_codes_of_nothing_and_of_other_lengths(spark):
    assert vector_codes.encode(vectors(spark, [])).count() == 0
    assert vector_codes.encode(vectors(spark, [(1, None, 1), (2, [NAN] * 8, 1)])).count() == 0
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [0.5] * 4, 1), (4, [], 1), (5, [1e9] * 8, 1)]
    assert {r.vec_id for r in vector_codes.encode(vectors(spark, rows)).collect()} == {1, 2}


@pytest.mark.parametrize("entries, high", [(16, 50), (130, 6), (1, 4)])
def test_bitmasks_hold_the_nearest_and_ties_go_to_the_lower_index(entries, high):
    rng = np.random.default_rng(entries)
    book = vector_codes.Book(rng.integers(-high, high, (entries, 5)))
    x = rng.integers(-2 * high, 2 * high, (700, 5))
    distance = ((x[:, None, :] - book.entries[None]) ** 2).sum(2)
    best, least = book.nearest(x)
    assert (best == distance.argmin(1)).all() and (least == distance.min(1)).all()
    radius = np.sqrt(least).astype(np.int64) + 1
    found = book.candidates(x, radius)
    box = (np.abs(x[:, None, :] - book.entries[None]) <= radius[:, None, None]).all(2)
    for k in range(entries):
        assert (((found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).astype(bool) == box[:, k]).all()


DOCS = "doc_id long, text string, fingerprint string, code string, `_id` string, term string"
LONG = " ".join(f"word{i % 1013} other{i}" for i in range(20_000))
TEXTS = [
    (5, "One two three, four five six seven eight!"), (7, None), (1, ""), (2, "\n\t .,"), (9, LONG), (4, LONG + " more"), (8, "É ß 日本 𝒳𝒳𝒳𝒳"),
    (11, "one TWO three four five six seven eight"), (None, "no number"), (6, "twice the same"), (6, "twice the same"), (6, "but not here"),
]


def documents(spark, rows):
    return spark.createDataFrame([(*r, "f", "c", "i", "t") for r in rows], DOCS)


def test_edits_and_equal_texts(spark):
    docs = documents(spark, TEXTS)
    got = imatch.compare_edited(docs).collect()
    assert len(got) == len(TEXTS)
    marks = {(r.doc_id, r.text): r.mark for r in docs.select(
        "doc_id", "text", F.xxhash64(F.col("doc_id").isNull(), "text").alias("mark")).collect()}
    in_order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, marks[r]))
    want = []
    for (i, t), (_, u) in zip(in_order, in_order[1:] + in_order[:1], strict=True):
        t, u = t or "", u or ""
        k = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[:len(t) - k] + u[:k]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    prints = {}
    for (i, t), sha in zip(in_order, [w[2] for w in want], strict=True):
        row = next(r for r in got if r.doc_id == i and r.edited_sha256 == sha)
        prints[t or ""] = row.fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert prints[TEXTS[0][1]] == prints[TEXTS[7][1]]     # the same terms
    assert prints[""] == prints["\n\t .,"] != prints["no number"]
    assert next(r for r in got if r.doc_id == 9).near_edited < 1
    assert imatch.compare_edited(documents(spark, [])).count() == 0
    alone = imatch.compare_edited(documents(spark, [(1, "all alone in here")])).first()
    assert alone.near_next == 1.0


def test_fingerprints_find_edited_copies_where_a_third_are_copies_of_one_text(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]

    def text():
        return " ".join(rng.choice(words, 150))

    hot = text()
    rows = [(i, hot if i % 3 == 0 else text()) for i in range(600)]
    got = imatch.compare_edited(documents(spark, rows)).toPandas()
    assert (got.near_edited > 0.2).mean() > 0.95
    assert (got.near_next < 0.1).mean() > 0.95
    assert got[got.doc_id % 3 == 0].fingerprint.nunique() == 1


def test_likeness_counts_equal_subsets(spark):
    def like(a, b):
        return spark.range(1).select(imatch.likeness(F.lit(a), F.lit(b))).first()[0]

    assert like("x:00:00abc,01def:", "x:00:00abc,01def:") == 1.0
    assert like("x:00:00abc,01def:", "y:00:00abc,02def:") == 1 / 3
    assert like("x:00:09fff:00abc", "y:01:00abc,01def:") == 0.5
    assert like("x:00:00abc:", "y:02:00abc:") == 0.0
    assert like("x:00::", "y:00::") == 0.0


CONVERSATIONS = "conv_id long, turn long, role string, text string, depth string, key string, pos string"


def naive_trie(rows):
    def digest(role, text):
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()

    given = {}
    for c, turn, role, text in rows:
        if c is not None:
            given.setdefault(c, []).append(((turn is not None, turn or 0, digest(role or "", text or "")), (role or "", text or "")))
    given = {c: [t for _, t in sorted(ts)] for c, ts in given.items()}
    built = {}
    for c in given:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = given.get(c - c % 5, [])[:h] + given[c][h:]
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        ends = sorted(c for c in members if len(built[c]) == len(path))
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p in below), sum(not any(q[:len(p)] == p and len(q) > len(p) for q in below) for p in below),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "d", "k", "p") for r in rows], CONVERSATIONS)


def some_conversations():
    rng = np.random.default_rng(5)
    rows = []
    for c in list(range(0, 60)) + [201, 203, 999_999_999_999]:
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "hello" if t < 2 else f"é{rng.integers(0, 2)}"))
    rows += [(7, None, None, None), (7, None, "user", ""), (8, 1, "user", "hello"), (8, 1, "user", "hello"), (None, 0, "user", "lost"), (300, 0, "a", "b")]
    return rows


@pytest.mark.parametrize("shard, band", [(256, 512), (7, 3), (1, 1)])
def test_trie(spark, shard, band):
    rows = some_conversations()
    got = prefix_trie.conversation_trie(conversations(spark, rows).repartition(5), shard, band).collect()
    assert sorted(map(tuple, got), key=str) == sorted(naive_trie(rows), key=str)


def test_trie_of_copies_and_of_one_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 900, 5) for t in range(3)]
    rows += [(1001, t, "user", f"turn {t % 7}") for t in range(1500)]
    got = {(r.conv_id, r.depth): r for r in prefix_trie.conversation_trie(conversations(spark, rows), 16, 64).collect()}
    own = 1500 - zlib.crc32(b"1001") % 9
    assert got[0, 0].n_convs == 181 and got[0, 3].n_convs == 180 and got[0, 3].n_children == 0
    assert got[1001, own].n_leaves == 1 and len(got) == 4 + own
    assert prefix_trie.conversation_trie(conversations(spark, [])).count() == 0
    assert prefix_trie.conversation_trie(conversations(spark, [(None, 1, "a", "b")])).count() == 0


def test_end_lists_are_hashed_over_batches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(c, 0, "user", "same") for c in range(0, 500, 5)]
        got = prefix_trie.conversation_trie(conversations(spark, rows), 4, 8).where("depth = 1").first()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert got.ends_sha256 == hashlib.sha256(",".join(map(str, range(0, 500, 5))).encode()).hexdigest()
