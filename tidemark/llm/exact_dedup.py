"""Exact duplicates by a tree-merge of sorted digest runs."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, marked, ready, rows_of, whole_text
from tidemark.session import stage

ROUNDS = 2  # exchanges; after them every digest lies in one cell
ROWS_PER_CELL = 20_000
ROWS_PER_RUN = 200_000
_KEY = 40  # bytes of a SHA-256 and of the length of the text
_NO_ID = -(1 << 63)
_RUN = "cell long, keys binary, ids binary, counts binary"
_RUN_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_DIGESTED = "doc_id long, mark long, digest binary, bytes long"


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and mark, SHA-256 of the text with A-Z lower-cased, its length in bytes."""
    def digest(parts):
        for rest, texts in batches(parts):
            lowered = [t.lower() for t in texts]  # of bytes: A-Z only
            yield pa.RecordBatch.from_arrays([
                *rest.columns,
                pa.array([hashlib.sha256(t).digest() for t in lowered], pa.binary()),
                pa.array(list(map(len, lowered)), pa.int64()),
            ], ["doc_id", "mark", "digest", "bytes"])

    return marked(docs).select("doc_id", "mark", whole_text().alias("text")).mapInArrow(digest, _DIGESTED)


def _merge(keys: list[bytes], ids: list[bytes], counts: list[bytes]):
    """Sorted runs to one: per key the largest id and the sum of the counts."""
    key = np.frombuffer(b"".join(keys), f"S{_KEY}")
    order = np.argsort(key, kind="stable")  # a merge sort that goes by the runs it finds
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    largest = np.maximum.reduceat(np.frombuffer(b"".join(ids), np.int64)[order], first)
    total = np.add.reduceat(np.frombuffer(b"".join(counts), np.int64)[order], first)
    return key[first], largest, total


def _digit(keys: np.ndarray, width: int, level: int) -> np.ndarray:
    """The level-th digit, in base ``width``, of where a digest belongs."""
    return (keys.view(np.uint8).reshape(-1, _KEY)[:, :8].copy().view(np.uint64)[:, 0] // np.uint64(width**level)) % np.uint64(width)


def _sent(merged, width: int, level: int, cell_of) -> pa.RecordBatch:
    """A merged run cut by its digits: a row for each cell that takes a part."""
    key, largest, total = merged
    digit, rows = _digit(key, width, level), []
    for d in np.unique(digit):
        part = digit == d
        rows.append((cell_of(int(d)), key[part].tobytes(), largest[part].tobytes(), total[part].tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RUN_TYPES, strict=True)], ["cell", "keys", "ids", "counts"]
    )


def merge_runs(digested: DataFrame, rows: int) -> DataFrame:
    """Groups of equal digests: digest, bytes, keep_id, group_size.

    A run is a sorted array of digests, with the largest doc_id and the number of rows of each.
    The tree is a butterfly: ``width ** ROUNDS`` cells, numbered by ROUNDS digits. A run starts
    at the task that read its rows. Round ``r`` sends the parts of a run to the cells whose
    first ``r`` digits are the digest's and whose other digits are the sender's; a cell merges
    what it takes from ``width`` senders into one run, keeping one entry of each digest. Copies
    collapse at every level, so however hot a text is, a cell takes one entry of it from each
    run, and the cells are as even as the digests. A lost task is its round done again.
    """
    width = max(2, round((rows / ROWS_PER_CELL) ** (1 / ROUNDS)) + 1)
    low = width ** (ROUNDS - 1)

    def read(parts):
        sender = TaskContext.get().partitionId() % low
        keys, ids, held = [], [], 0

        def run():
            merged = _merge(keys, ids, [np.ones(held, np.int64).tobytes()])
            return _sent(merged, width, 0, lambda d: d * low + sender)

        for batch in parts:
            digest, size, doc_id = batch.columns
            keys += [d + s.to_bytes(8, "big") for d, s in zip(digest.to_pylist(), size.to_pylist(), strict=True)]
            ids.append(doc_id.to_numpy().tobytes())
            held += len(doc_id)
            if held >= ROWS_PER_RUN:
                yield run()
                keys, ids, held = [], [], 0
        if held:
            yield run()

    def merge(level):
        def one_cell(key, table):
            cell, merged = key[0].as_py(), _merge(*(table.column(c).to_pylist() for c in ("keys", "ids", "counts")))
            if level == ROUNDS:
                k, largest, total = merged
                raw = k.view(np.uint8).reshape(-1, _KEY)
                return pa.table({
                    "digest": pa.array([r.tobytes() for r in raw[:, :32]], pa.binary()),
                    "bytes": raw[:, 32:].copy().view(">i8")[:, 0].astype(np.int64), "keep_id": largest, "group_size": total,
                })
            unit = width ** (ROUNDS - 1 - level)  # of the digit that this round's exchange settles
            settled = cell - cell % (unit * width)
            return pa.Table.from_batches([_sent(merged, width, level, lambda d: settled + d * unit + cell % unit)])

        return one_cell

    entries = digested.select("digest", "bytes", F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"))
    runs = entries.mapInArrow(read, _RUN)
    for level in range(1, ROUNDS):
        runs = runs.groupBy("cell").applyInArrow(merge(level), _RUN)
    merged = runs.groupBy("cell").applyInArrow(merge(ROUNDS), "digest binary, bytes long, keep_id long, group_size long")
    return merged.withColumn("keep_id", F.nullif("keep_id", F.lit(_NO_ID)))


def _decided(docs: DataFrame) -> DataFrame:
    ready(docs.sparkSession)
    digested = stage(digests(docs), "digests")
    groups = merge_runs(digested, digested.count())
    return digested.join(groups, ["digest", "bytes"]).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is the empty one. Equal
    means equal SHA-256 and equal length. Of equal texts the row with the largest doc_id stays.
    Several rows of that very doc_id are all marked kept, as they cannot be told apart; a null
    doc_id counts as the smallest, and a group of nulls alone is kept. Other columns are not
    read. An empty table gives no rows.
    """
    return _decided(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, whole, one of each group of equal texts."""
    kept = _decided(docs).where("kept").groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("row"))
    return rows_of(docs, kept.select("row.*"), once=True)


ORACLE_SQL = """
WITH d AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
