"""Toxic spans by a linear-chain conditional random field, summed up to document scores."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, marked, ready, remainder, rows_of, shingles, whole_text, word_hashes
from tidemark.session import stage

HELD_OUT_MOD, HELD_OUT_IS = 4, 2
PREFIXES = (3, 4, 5, 6)
KNOWN_WORDS = 300_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cues(word: bytes) -> list[str]:
    """The word, and its beginnings of some lengths."""
    text = word.decode()
    return ["=" + text, *[text[:k] for k in PREFIXES if len(text) > k]]


_WIDTH = 1 + len(PREFIXES)


def forward_backward(odds: np.ndarray, begins: np.ndarray, start: float, step: np.ndarray):
    """Odds of label 1 from the left and from the right, for every token of all texts.

    ``odds`` are those of the token itself, ``step`` the weights of the four pairs of labels.
    Texts go side by side, longest first, one token at a time. The product of both odds is the
    marginal odds of a token.
    """
    sizes = np.diff(begins)
    order = np.argsort(-sizes, kind="stable")
    first, size = begins[:-1][order], sizes[order]
    left, right = np.empty(len(odds)), np.ones(len(odds))
    going = len(size) - np.searchsorted(size[::-1], np.arange(1, (size[0] if len(size) else 0) + 1))
    for t, n in enumerate(going):
        at = first[:n] + t
        if t == 0:
            left[at] = start * odds[at]
        else:
            before = left[at - 1]
            left[at] = odds[at] * (step[0, 1] + before * step[1, 1]) / (step[0, 0] + before * step[1, 0])
    for t in range(len(going) - 1, 0, -1):
        at = first[:going[t]] + t
        after = odds[at] * right[at]
        right[at - 1] = (step[1, 0] + step[1, 1] * after) / (step[0, 0] + step[0, 1] * after)
    return left, right


@dataclass(frozen=True)
class Fit:
    """How the model is fitted, and from which score on a document is predicted toxic."""

    threshold: float = 0.3
    sample_toxic: int = 4000   # labelled documents that the model is fitted on, at most
    sample_clean: int = 8000
    features: int = 4000       # cues of a token that the model may weigh, at most: those in most toxic documents
    least_docs: int = 5        # a cue is in so many toxic documents,
    least_ratio: float = 20.0  # and so much oftener than in clean ones
    rounds: int = 16


@dataclass
class Model:
    cues: dict[str, int]
    weights: np.ndarray       # of each cue, then 0 for none
    bias: float
    start: float              # odds
    step: np.ndarray
    scale: tuple              # of the logistic curve over the log of the sum of squared marginals

    def found(self, word: bytes) -> list[int]:
        return [self.cues[c] for c in cues(word) if c in self.cues]

    def odds(self, at: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(self.bias + self.weights[at].sum(axis=1), -30, 30))

    def score(self, expected: np.ndarray) -> np.ndarray:
        z = self.scale[0] + self.scale[1] * np.log(expected + 1e-4)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class _Odds(dict):
    """Odds of a word, kept for words met before."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.none = model, float(np.exp(model.bias))

    def __missing__(self, word: bytes) -> float:
        if len(self) > KNOWN_WORDS:
            self.clear()
        at = self.model.found(word)
        odds = float(np.exp(np.clip(self.model.bias + self.model.weights[at].sum(), -30, 30))) if at else self.none
        self[word] = odds
        return odds


def _marginals(model: Model, known: _Odds, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    tokens = [t.lower().split() for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    odds = np.fromiter((known[w] for t in tokens for w in t), np.float64, int(begins[-1]))
    left, right = forward_backward(odds, begins, model.start, model.step)
    both = left * right
    return both / (1 + both), begins


def sample(docs: DataFrame, labels: DataFrame, how: Fit) -> DataFrame:
    """half, toxic, weight, text of a bounded sample of the labelled documents that are not held out.

    Those with the lowest hash of their id; ``weight`` is how many labelled documents of its label one
    stands for. Of documents with the same words in the same runs of three one is taken, so that no
    text counts as often as it has copies; a line that texts share makes no copies of them. ``half``
    follows the least run, so that near copies mostly lie in one half.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic")
    ).where(remainder(F.col("doc_id"), HELD_OUT_MOD) != HELD_OUT_IS)
    low = [F.xxhash64("doc_id"), "doc_id"]
    most = {1: how.sample_toxic, 0: how.sample_clean}
    chosen = known.where("toxic = 1").orderBy(*low).limit(most[1]).union(known.where("toxic = 0").orderBy(*low).limit(most[0]))
    there = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    weight = {k: max(1.0, there.get(k, 0) / max(n, 1)) for k, n in most.items()}
    # At most sample_toxic + sample_clean rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")

    def keyed(parts):
        for rest, group in batches(parts):
            hashes, begins = word_hashes(group)
            sets = [shingles(hashes[a:b], 3) for a, b in zip(begins[:-1], begins[1:], strict=True)]
            keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            half = [int(x[0] >> np.uint64(63)) if len(x) else 0 for x in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(half), rest.column(0), rest.column(1), pa.array(group, pa.binary())],
                ["key", "half", "doc_id", "toxic", "text"],
            )

    rows = texts.select("doc_id", "toxic", "text").mapInArrow(keyed, "key binary, half long, doc_id long, toxic int, text binary")
    return rows.groupBy("key").agg(F.min(F.struct("doc_id", "half", "text", "toxic")).alias("one")).select(
        "one.half", "one.toxic", F.when(F.col("one.toxic") == 1, weight[1]).otherwise(weight[0]).alias("weight"), "one.text"
    )


def _choose_cues(rows: DataFrame, toxic: int, clean: int, how: Fit) -> dict[str, int]:
    """The cues that mark toxic documents, by how many of those have them."""
    def count(parts):
        seen: dict[str, list[int]] = {}
        for batch in parts:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for cue in {c for w in set(text.lower().split()) for c in cues(w)}:
                    seen.setdefault(cue, [0, 0])[label] += 1
        if seen:
            yield pa.RecordBatch.from_pydict({"cue": list(seen), "clean": [n[0] for n in seen.values()], "toxic": [n[1] for n in seen.values()]})

    counted = rows.select("toxic", "text").mapInArrow(count, "cue string, clean long, toxic long").groupBy("cue").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    marks = (F.col("toxic") >= how.least_docs) & (F.col("toxic") / max(toxic, 1) > how.least_ratio * (F.col("clean") + 0.5) / max(clean, 1))
    best = counted.where(marks).orderBy(F.desc("toxic"), "cue").limit(how.features).collect()
    return {r.cue: i for i, r in enumerate(best)}


def _gradient(rows: DataFrame, model: Model) -> np.ndarray:
    """Of the log-likelihood: cues, bias, start, and the steps 01, 10 and 11, summed over the partitions."""
    n = len(model.cues)

    def of_part(parts):
        total = np.zeros(n + 5)
        for batch in parts:
            at = [np.frombuffer(x, "<i2").reshape(-1, _WIDTH) for x in batch.column(1).to_pylist()]
            at = [a for a in at if len(a)]
            if not at:
                continue
            labels = np.concatenate([np.full(len(a), y) for a, y in zip(
                [np.frombuffer(x, "<i2").reshape(-1, _WIDTH) for x in batch.column(1).to_pylist()], batch.column(0).to_pylist(), strict=True)])
            begins = np.concatenate([[0], np.cumsum([len(a) for a in at])])
            at = np.concatenate(at)
            # In a toxic document the tokens with a cue are the toxic ones; in others none is.
            y = ((at >= 0).any(axis=1) & (labels == 1)).astype(float)
            odds = model.odds(at)
            left, right = forward_backward(odds, begins, model.start, model.step)
            p = left * right / (1 + left * right)
            rest = y - p
            for c in range(_WIDTH):
                total[:n] += np.bincount(at[:, c][at[:, c] >= 0], rest[at[:, c] >= 0], n)
            total[n] += rest.sum()
            total[n + 1] += rest[begins[:-1]].sum()
            inner = np.ones(len(at), bool)
            inner[begins[:-1]] = False
            now = np.flatnonzero(inner)
            after, before = odds[now] * right[now], left[now - 1]
            weights = np.stack([np.full(len(now), model.step[0, 0]), model.step[0, 1] * after, before * model.step[1, 0], before * after * model.step[1, 1]])
            weights /= weights.sum(axis=0)
            seen = [(1 - y[now - 1]) * y[now], y[now - 1] * (1 - y[now]), y[now - 1] * y[now]]
            total[n + 2:] += [s.sum() - w.sum() for s, w in zip(seen, weights[1:], strict=True)]
        yield pa.RecordBatch.from_pydict({"gradient": [total.tobytes()]})

    sums = rows.select("toxic", "at").mapInArrow(of_part, "gradient binary").collect()
    return np.sum([np.frombuffer(r.gradient) for r in sums] or [np.zeros(n + 5)], axis=0)


def fit(docs: DataFrame, labels: DataFrame, how: Fit) -> Model:
    """Cues, weights and the curve of the score, each from the sample.

    Documents are labelled, tokens are not: a token is taken as toxic if its document is and it
    has a cue. Half of the sample fits the field, by gradients that tasks compute and the driver
    adds up, ``features`` + 5 numbers each; the other half fits the curve, or the whole sample where
    that half is of one label. A text in which the field finds nothing stays below the threshold.
    """
    rows = stage(sample(docs, labels, how), "toxic_sample")
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    chosen = _choose_cues(rows, counts.get(1, 0), counts.get(0, 0), how)
    n = len(chosen)
    model = Model(chosen, np.zeros(n + 1), -6.0, 0.01, np.ones((2, 2)), (0.0, 1.0))

    def places(parts):
        for batch in parts:
            found = []
            for text in batch.column(1).to_pylist():
                words = text.lower().split()
                at = np.full((len(words), _WIDTH), -1, "<i2")
                for i, w in enumerate(words):
                    own = model.found(w)
                    at[i, :len(own)] = own
                found.append(at.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)], ["toxic", "at", "half"])

    placed = stage(rows.select("toxic", "text", "half").mapInArrow(places, "toxic int, at binary, half long"), "toxic_tokens")
    halves = rows.groupBy("half").agg(F.count_distinct("toxic").alias("labels")).where("labels = 2").count()
    first = placed.where("half = 0") if halves == 2 else placed
    # Steps that grow while a slope keeps its sign and shrink when it turns.
    theta = np.concatenate([np.zeros(n), [-6.0, np.log(0.01), 0.0, 0.0, 0.0]])
    pace, last = np.full(n + 5, 0.5), np.zeros(n + 5)
    for _ in range(how.rounds if n and counts.get(0) else 0):
        slope = _gradient(first, model) - 0.05 * theta
        turn = np.sign(slope * last)
        pace = np.clip(np.where(turn > 0, pace * 1.3, np.where(turn < 0, pace * 0.5, pace)), 1e-3, 2.0)
        theta = np.clip(theta + np.sign(slope) * pace, -12, 12)
        last = slope
        model = Model(chosen, np.append(theta[:n], 0.0), float(theta[n]), float(np.exp(theta[n + 1])),
                      np.exp(np.array([[0.0, theta[n + 2]], [theta[n + 3], theta[n + 4]]])), model.scale)
    # The curve: a logistic regression of the label on the log of that sum.
    second = (rows.where("half = 1") if halves == 2 else rows).select("toxic", "weight", "text")

    def expected(parts):
        known = _Odds(model)
        for batch in parts:
            p, begins = _marginals(model, known, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_sums(p, begins))], ["toxic", "weight", "expected"])

    seen = second.mapInArrow(expected, "toxic int, weight double, expected double").collect() if n else []
    w = np.array([r.weight for r in seen])
    x, y = np.log(np.array([r.expected for r in seen]) + 1e-4), np.array([r.toxic for r in seen], float)
    nothing = float(np.log(how.threshold / (2 - how.threshold)))  # where half the threshold lies
    if len(set(y)) < 2:
        rate = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1) if counts.get(1) else 0.0
        model.scale = (min(np.log(rate / (1 - rate)), nothing) if rate else -60.0, 0.0)
        return model
    z, design = np.zeros(2), np.stack([np.ones(len(x)), x], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ z, -30, 30)))
        hessian = design.T @ (design * (w * (p * (1 - p) + 1e-6))[:, None]) + 0.1 * np.eye(2)
        z = z + np.linalg.solve(hessian, design.T @ (w * (y - p)) - 0.1 * z)
    slope = max(float(z[1]), 0.0)
    model.scale = (min(float(z[0]), nothing - slope * float(np.log(1e-4))), slope)
    return model


def _sums(p: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Per text the sum of the squared marginals: many faint ones do not add up to a toxic token."""
    return np.diff(np.concatenate([[0.0], np.cumsum(p * p)])[begins])


def _spans(text: bytes, p: np.ndarray) -> list[dict]:
    """Runs of tokens that are likelier toxic than not, as offsets of characters."""
    spans, places = [], [m.span() for m in _WORD.finditer(text)]
    for i in np.flatnonzero(p > 0.5):
        begin, end = places[i]
        if spans and spans[-1][2] == i - 1:
            spans[-1][1:] = [end, i, max(spans[-1][3], p[i])]
        else:
            spans.append([begin, end, i, p[i]])
    return [{"begin": len(text[:a].decode()), "end": len(text[:b].decode()), "marginal": float(m)} for a, b, _, m in spans]


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))


def _judged(docs: DataFrame, labels: DataFrame, how: Fit) -> DataFrame:
    ready(docs.sparkSession)
    model = fit(docs, labels, how)

    def judge(parts):
        known = _Odds(model)
        for rest, texts in batches(parts):
            p, begins = _marginals(model, known, texts)
            sums = _sums(p, begins)
            score = model.score(sums)
            spans = [_spans(t, p[a:b]) if (p[a:b] > 0.5).any() else [] for t, a, b in zip(texts, begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(score), pa.array((score >= how.threshold).astype(np.int32)), pa.array(spans, _SPANS)],
                ["doc_id", "mark", "held_out", "score", "predicted", "spans"],
            )

    return marked(docs).select(
        "doc_id", "mark", (remainder(F.col("doc_id"), HELD_OUT_MOD) == HELD_OUT_IS).alias("held_out"), whole_text().alias("text")
    ).mapInArrow(
        judge, "doc_id long, mark long, held_out boolean, score double, predicted int, spans array<struct<begin:long,end:long,marginal:double>>"
    )


def toxicity(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans.

    The field gives each token the chance of being toxic, from its cues and its neighbours.
    ``score``, between 0 and 1, grows with the sum of the squared marginals of the
    whole text; ``predicted`` is 1 from the threshold on; ``spans`` are the offsets of the characters of
    the tokens likelier toxic than not. Only the text is looked at.

    A document is held out if crc32 of its id as text leaves HELD_OUT_IS modulo HELD_OUT_MOD; a
    null id counts as the empty text. Labels of held-out documents, null labels and null ids
    teach nothing; of several labels of one id the largest counts. Null and empty texts have no
    toxic token and get the lowest score. Without toxic labels every score is near 0; with no
    cue, or labels of one kind only, it is the share of toxic documents in the sample, or half the
    threshold if that is less. Repeated rows are scored each. An
    empty table gives no rows. Other columns are not read.
    """
    return _judged(docs, labels, how).drop("mark")


def drop_toxic(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, whole."""
    clean = _judged(docs, labels, how).where("predicted = 0").groupBy("doc_id", "mark").agg(F.count(F.lit(1)).cast("int").alias("times"))
    return rows_of(docs, clean, times="times")
