"""Interpolated modified Kneser-Ney model: counted by Spark, kept as sorted arrays, mapped by workers.

The model is of order two. Its files, in a folder that all executors share:

- ``words-N``: the hashes of the words of one range of hashes, sorted. A word's id is its place
  in all of them together.
- ``stats-N``: for each of those ids its count, the number of different words before it, and how
  many words follow it once, twice and more often.
- ``pairs-N`` and ``times-N``: the pairs of ids that fall to one shard, sorted, and their counts.

A pair is one 64-bit number, the first id in the high half.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, mix, ready, remainder, whole_text, word_hashes
from tidemark.llm.files import mapped, put
from tidemark.session import shared_dir, stage

HELD_OUT_MOD, HELD_OUT_IS = 10, 0
END = np.uint64(0xE0D)          # the token that ends a text; no word has the hash but by chance
BASE_ADD = 0.1
ROWS_PER_SHARD = 8192
RUN_TOKENS = 2_000_000          # tokens that a task counts before it hands on a run
_HALF = np.uint64(32)
_RUN = "shard long, keys binary, counts binary"


def _pack(keys: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, byte by byte."""
    steps = np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(counts.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack_counts(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1).T).view(np.int64)[:, 0]


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of their counts, of one each if none are given."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _runs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray):
    """A row for each shard: its keys, still sorted, with their counts."""
    order = np.argsort(shard, kind="stable")
    numbers, begins = np.unique(shard[order], return_index=True)
    parts = np.split(order, begins[1:])
    return pa.RecordBatch.from_arrays([
        pa.array(numbers.astype(np.int64)), pa.array([_pack(keys[p]) for p in parts], pa.binary()),
        pa.array([_pack_counts(counts[p]) for p in parts], pa.binary()),
    ], ["shard", "keys", "counts"])


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [_unpack(k) for k in table.column("keys").to_pylist()]
    counts = [_unpack_counts(c) for c in table.column("counts").to_pylist()]
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a hash when all hashes are cut into ``ranges`` equal ones."""
    return ((hashes >> _HALF) * np.uint64(ranges)) >> _HALF


def _pair_shard(pairs: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(pairs) >> _HALF) * np.uint64(shards)) >> _HALF


@dataclass
class Words:
    """The mapped words: finds ids."""
    folder: str
    sizes: list[int]

    def open(self) -> Words:
        self.arrays = [mapped(f"{self.folder}/words-{i}", "<u8") for i in range(len(self.sizes))]
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        return self

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each hash, -1 for a word that is not there."""
        distinct, back = np.unique(hashes, return_inverse=True)
        found = np.full(len(distinct), -1, np.int64)
        cuts = np.searchsorted(_range_of(distinct, len(self.sizes)), np.arange(len(self.sizes) + 1))
        for i, words in enumerate(self.arrays):
            part = distinct[cuts[i]:cuts[i + 1]]
            if len(part) and len(words):
                at = np.minimum(np.searchsorted(words, part), len(words) - 1)
                found[cuts[i]:cuts[i + 1]] = np.where(words[at] == part, at + self.begins[i], -1)
        return found[back]


def _with_ends(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the tokens of all texts, each text with its end, and where each begins."""
    hashes, begins = word_hashes(texts)
    return np.insert(hashes, begins[1:], END), begins + np.arange(len(begins))


def _before(ids: np.ndarray, begins: np.ndarray, start: int) -> np.ndarray:
    """For each token the id before it; ``start`` before the first of a text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[begins[:-1]] = start
    return before


def _flush(held: list[np.ndarray], place):
    keys, counts = _summed(np.concatenate(held))
    return _runs(keys, counts, place(keys))


def _counted(texts: DataFrame, tokens, place) -> DataFrame:
    """Runs of what ``tokens`` makes of the texts, counted, by shard."""
    def count(parts):
        make, held, size = tokens(), [], 0
        for _, batch in batches(parts):
            held.append(make(batch))
            size += len(held[-1])
            if size >= RUN_TOKENS:
                yield _flush(held, place)
                held, size = [], 0
        if size:
            yield _flush(held, place)

    return texts.mapInArrow(count, _RUN)


def _discounts(n: list[int]) -> list[float]:
    """Discounts of counts of 1, 2 and more, from how many counts are 1, 2, 3 and 4.

    Where the formulas have nothing to divide, or leave 0 to the count, the discount is half
    the count, at most 1.5.
    """
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else -1.0 for k in range(3)]
    return [d if 0 < d < k + 1 else (k + 1) / 2 for k, d in enumerate(found)]


@dataclass
class Model:
    """What a worker needs besides the files."""
    folder: str
    ranges: list[int]     # words of each range
    shards: list[int]     # pairs of each shard
    tokens: int           # of the training texts, ends included
    texts: int
    start: tuple          # how many words begin a text once, twice and more often
    pair_discounts: list[float]
    word_discounts: list[float]
    followed: tuple       # words with 1, 2 and more different words before them

    def open(self) -> Model:
        self.words = Words(self.folder, self.ranges).open()
        self.stats = [mapped(f"{self.folder}/stats-{i}", "<i8").reshape(-1, 5) for i in range(len(self.ranges))]
        self.pairs = [mapped(f"{self.folder}/pairs-{i}", "<u8") for i in range(len(self.shards))]
        self.times = [mapped(f"{self.folder}/times-{i}", "<u8") for i in range(len(self.shards))]
        return self

    def _stats(self, ids: np.ndarray) -> np.ndarray:
        """The numbers of each word; zeros for one that is not there."""
        distinct, back = np.unique(ids, return_inverse=True)
        out = np.zeros((len(distinct), 5), np.int64)
        cuts = np.searchsorted(distinct, self.words.begins)
        for i, stats in enumerate(self.stats):
            out[cuts[i]:cuts[i + 1]] = stats[distinct[cuts[i]:cuts[i + 1]] - self.words.begins[i]]
        return out[back]

    def _pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(pairs, return_inverse=True)
        out, shard = np.zeros(len(distinct), np.int64), _pair_shard(distinct, len(self.shards))
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(len(self.shards) + 1, dtype=np.uint64))
        for i in np.flatnonzero(np.diff(cuts)):
            known, times, own = self.pairs[i], self.times[i], order[cuts[i]:cuts[i + 1]]
            if len(known):
                at = np.minimum(np.searchsorted(known, distinct[own]), len(known) - 1)
                out[own] = np.where(known[at] == distinct[own], times[at], 0)
        return out[back]

    def score(self, texts: list[bytes]):
        """Per text: tokens, known tokens, base score, score (both log10)."""
        hashes, begins = _with_ends(texts)
        ids, size = self.words.ids(hashes), sum(self.ranges)
        stats = self._stats(ids)
        count, before = stats[:, 0], stats[:, 1].astype(float)
        base = np.log10((count + BASE_ADD) / (self.tokens + BASE_ADD * (size + 1)))

        # The lower order: in how many ways a word follows, mixed with the even chance.
        ways, one = sum(self.shards), 1.0 / (size + 1)
        if ways:
            spared = np.array([0.0, *self.word_discounts])[np.minimum(stats[:, 1], 3)]
            left = sum(d * n for d, n in zip(self.word_discounts, self.followed, strict=True)) / ways
            lower = (before - spared) / ways + left * one
        else:
            lower = np.full(len(ids), one)

        previous = _before(ids, begins, size)
        context = np.empty((len(ids), 4))  # occurrences; words after it once, twice, more often
        first = previous == size
        context[first] = (self.texts, *self.start)
        context[1:][~first[1:]] = stats[:-1][~first[1:]][:, [0, 2, 3, 4]]
        known = (previous >= 0) & (ids >= 0)
        seen = np.zeros(len(ids), np.int64)
        seen[known] = self._pair_counts((previous[known].astype(np.uint64) << _HALF) | ids[known].astype(np.uint64))
        taken = np.array([0.0, *self.pair_discounts])[np.minimum(seen, 3)]
        total = np.maximum(context[:, 0], 1)
        back_off = (context[:, 1:] @ np.array(self.pair_discounts)) / total
        higher = (seen - taken) / total + back_off * lower
        score = np.log10(np.where(context[:, 0] > 0, higher, lower))
        at = begins[:-1]
        return np.diff(begins), np.add.reduceat(count > 0, at, dtype=np.int64), np.add.reduceat(base, at), np.add.reduceat(score, at)


def train(texts: DataFrame, rows: int) -> Model:
    """Count the texts (a binary column ``text``) and write the model's files.

    Tasks count words, and then pairs, of RUN_TOKENS tokens at a time, and hand on sorted runs
    of distinct keys; a shard merges its runs. Words are cut by ranges of their hash and pairs
    by a hash of the pair, so that a frequent word is no hot shard. Shards grow in number with
    the documents.
    """
    spark = texts.sparkSession
    folder = shared_dir(spark, "model")
    ranges = shards = max(4, -(-rows // ROWS_PER_SHARD))

    def hashes():
        return lambda batch: _with_ends(batch)[0]

    def write_words(key, table):
        words, counts = _merged(table)
        shard = key[0].as_py()
        put(f"{folder}/words-{shard}", words.astype("<u8").tobytes())
        put(f"{folder}/counts-{shard}", counts.astype("<i8").tobytes())
        return pa.table({"shard": [shard], "size": [len(words)], "tokens": [int(counts.sum())]})

    merged = stage(
        _counted(texts, hashes, lambda keys: _range_of(keys, ranges)).groupBy("shard")
        .applyInArrow(write_words, "shard long, size long, tokens long"), "words",
    )
    found = {r.shard: (r["size"], r.tokens) for r in merged.collect()}
    for shard in range(ranges):
        if shard not in found:
            put(f"{folder}/words-{shard}", b"")
            put(f"{folder}/counts-{shard}", b"")
    sizes = [found.get(i, (0, 0))[0] for i in range(ranges)]
    size = sum(sizes)
    if size >= 1 << 32:
        raise ValueError(f"{size} different words; a pair holds two numbers below 2^32")

    def pairs():
        words = Words(folder, sizes).open()

        def make(batch):
            hashes, begins = _with_ends(batch)
            ids = words.ids(hashes)
            return (_before(ids, begins, size).astype(np.uint64) << _HALF) | ids.astype(np.uint64)

        return make

    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def by_range(ids: np.ndarray, columns: np.ndarray, kind: str):
        """A row for each range of words: the ids and what is counted of them."""
        cuts = np.searchsorted(ids, begins)
        return [
            (i, kind, ids[a:b].astype("<i8").tobytes(), np.ascontiguousarray(columns[a:b], "<i8").tobytes())
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a
        ]

    def write_pairs(key, table):
        pairs, counts = _merged(table)
        shard = key[0].as_py()
        put(f"{folder}/pairs-{shard}", pairs.astype("<u8").tobytes())
        put(f"{folder}/times-{shard}", counts.astype("<u8").tobytes())
        first, second = (pairs >> _HALF).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ids, at = np.unique(first, return_index=True)
        often = np.stack([counts == 1, counts == 2, counts > 2], axis=1)
        after = np.add.reduceat(often, at, dtype=np.int64)
        starts = after[ids == size].sum(axis=0) if len(ids) else np.zeros(3, np.int64)
        rows = by_range(ids[ids < size], after[ids < size], "after")
        rows += by_range(*np.unique(second, return_counts=True), "before")
        numbers = [len(pairs), *((counts == k).sum() for k in (1, 2, 3, 4)), *starts]
        rows.append((shard, "shard", np.array(numbers, "<i8").tobytes(), b""))
        return pa.table(dict(zip(["range", "kind", "ids", "numbers"], map(list, zip(*rows, strict=True)), strict=True)))

    pieces = stage(
        _counted(texts, pairs, lambda keys: _pair_shard(keys, shards)).groupBy("shard")
        .applyInArrow(write_pairs, "range long, kind string, ids binary, numbers binary"), "pieces",
    )
    per_shard = {r.range: np.frombuffer(r.ids, "<i8") for r in pieces.where("kind = 'shard'").select("range", "ids").collect()}
    for shard in range(shards):
        if shard not in per_shard:
            put(f"{folder}/pairs-{shard}", b"")
            put(f"{folder}/times-{shard}", b"")
    totals = np.sum([*per_shard.values(), np.zeros(8, np.int64)], axis=0)

    def write_stats(key, table):
        i = key[0].as_py()
        stats = np.zeros((sizes[i], 5), "<i8")
        stats[:, 0] = mapped(f"{folder}/counts-{i}", "<i8")
        for kind, ids, numbers in zip(*(table.column(c).to_pylist() for c in ("kind", "ids", "numbers")), strict=True):
            at, numbers = np.frombuffer(ids, "<i8") - begins[i], np.frombuffer(numbers, "<i8")
            if kind == "before":
                stats[at, 1] += numbers
            else:
                stats[at, 2:] += numbers.reshape(-1, 3)
        put(f"{folder}/stats-{i}", stats.tobytes())
        ways = stats[:, 1]
        return pa.table({"range": [i], **{f"n{k}": [int((ways == k).sum())] for k in (1, 2, 3, 4)}, "more": [int((ways > 2).sum())]})

    written = stage(
        pieces.where("kind <> 'shard'").groupBy("range").applyInArrow(write_stats, "range long, n1 long, n2 long, n3 long, n4 long, more long"),
        "stats",
    ).collect()
    for i in set(range(ranges)) - {r.range for r in written}:
        put(f"{folder}/stats-{i}", b"")
    ways = [sum(r[f"n{k}"] for r in written) for k in (1, 2, 3, 4)]
    return Model(
        folder, sizes, [int(per_shard[i][0]) if i in per_shard else 0 for i in range(shards)],
        tokens=sum(t for _, t in found.values()), texts=_ends(folder, sizes), start=tuple(int(x) for x in totals[5:8]),
        pair_discounts=_discounts([int(x) for x in totals[1:5]]), word_discounts=_discounts(ways),
        followed=(ways[0], ways[1], sum(r.more for r in written)),
    )


def _ends(folder: str, sizes: list[int]) -> int:
    """The number of training texts: how often the end occurs."""
    at = Words(folder, sizes).open().ids(np.array([END]))[0]
    if at < 0:
        return 0
    begins = np.concatenate([[0], np.cumsum(sizes)])
    i = int(np.searchsorted(begins, at, "right")) - 1
    return int(mapped(f"{folder}/counts-{i}", "<i8")[at - begins[i]])


def score(docs: DataFrame, divisor: int = HELD_OUT_MOD, rest: int = HELD_OUT_IS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    A document is held out if crc32 of its id as text leaves ``rest`` modulo ``divisor``; the
    model learns from all others. Tokens are the words, A-Z lower-cased, and one end, so a null
    or empty text has one token. ``base_score`` is a unigram model with 0.1 added to each count,
    ``score`` the log10 probability of the text under the model. A null id counts as the empty
    text. Repeated rows are scored, and learnt from, each. Without training texts every token
    has the same chance. An empty table gives no rows. Other columns are not read.
    """
    ready(docs.sparkSession)
    held_out = remainder(F.col("doc_id"), divisor) == rest
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), whole_text().alias("text"))
    model = train(texts.where(~held_out).select("text"), docs.count())

    def judge(parts):
        opened = model.open()
        for ids, batch in batches(parts):
            tokens, known, base, found = opened.score(batch)
            yield pa.RecordBatch.from_arrays([
                *ids.columns, pa.array(tokens.astype(np.int64)), pa.array(known), pa.array(np.full(len(batch), model.tokens)),
                pa.array(base), pa.array(found), pa.array(10 ** np.minimum(-found / tokens, 300.0)),
            ], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return texts.mapInArrow(
        judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    )
