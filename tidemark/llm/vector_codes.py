"""Vector codes: parts of vectors replaced by the index of the nearest entry of a codebook.

The nearest entry is found by slicing and intersecting bitmasks. For every dimension of a part
the entries' coordinates are sorted, with a mask of the entries up to each place. The distance to
one entry that is near in the widest dimension is the initial radius: no nearest entry can
differ by more in any dimension. The radius selects a range per dimension, the difference of two
prefix masks gives the range's entries, and the masks of all dimensions, words of 64 bits, are
intersected. What is left are the exact candidates, and only they are measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

# Squares of differences up to twice this size, summed over 128 dimensions, fit 62 bits.
MOST = 1 << 26

_U = np.uint64


class Book:
    """The entries of one part, ready to be searched."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.ascontiguousarray(entries, np.int64)
        n, width = self.entries.shape
        self.words = -(-n // 64)
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, order, 0)
        bits = np.zeros((n, self.words), _U)
        bits[np.arange(n), np.arange(n) // 64] = _U(1) << (np.arange(n) % 64).astype(_U)
        # prefix[d, i] has the bits of the i smallest coordinates of dimension d.
        self.prefix = np.zeros((width, n + 1, self.words), _U)
        for d in range(width):
            self.prefix[d, 1:] = np.bitwise_or.accumulate(bits[order[:, d]], axis=0)
        self.widest = int(np.argmax(np.ptp(self.entries, axis=0))) if width else 0
        self.order = order

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that differ from a part by no more than its radius in any dimension."""
        found = np.broadcast_to(self.prefix[0, -1], (len(parts), self.words)).copy()
        for d in range(parts.shape[1]):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            found &= self.prefix[d, high] ^ self.prefix[d, low]
        return found

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each part's nearest entry, the lower one of ties, and the squared distance."""
        if not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        line, d = self.sorted[:, self.widest], self.widest
        place = np.searchsorted(line, parts[:, d])
        left, right = np.maximum(place - 1, 0), np.minimum(place, len(line) - 1)
        closer = np.where(parts[:, d] - line[left] <= line[right] - parts[:, d], left, right)
        least = ((parts - self.entries[self.order[closer, d]]) ** 2).sum(1)
        radius = np.sqrt(least.astype(np.float64)).astype(np.int64) + 1
        found = self.candidates(parts, radius)
        best, least = np.zeros(len(parts), np.int64), np.full(len(parts), np.iinfo(np.int64).max)
        for k in range(len(self.entries)):
            at = np.flatnonzero(found[:, k // 64] >> _U(k % 64) & _U(1))
            distance = ((parts[at] - self.entries[k]) ** 2).sum(1)
            less = distance < least[at]
            best[at[less]], least[at[less]] = k, distance[less]
        return best, least


def bounds(width: int, parts: int) -> list[int]:
    """Where parts begin and end: equal parts, or as equal as the width allows."""
    return [p * width // parts for p in range(parts + 1)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), width).astype(np.int64)


def whole_vectors(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """Rows whose components are all finite numbers, as integers ``floor(scale * x)`` in ``_x``."""
    x = F.transform(F.col(f"`{vector}`"), lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    finite = F.forall(F.col(f"`{vector}`"), lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    held = F.forall("_x", lambda v: v.between(-MOST, MOST))
    kept = vectors.where(finite).withColumn("_x", x)
    return kept.withColumn("_x", F.when(held, F.col("_x").cast("array<int>")))


def _assigned(rows: DataFrame, books: list[np.ndarray], cuts: list[int], rest: list[str]) -> DataFrame:
    """The columns ``rest``, with the code and the error of each vector."""
    width = cuts[-1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Book(b) for b in books]
        for batch in batches:
            x = _matrix(batch.column("_x"), width)
            codes, error = np.zeros((len(x), len(ready)), np.uint8), np.zeros(len(x), np.int64)
            for p, book in enumerate(ready):
                codes[:, p], distance = book.nearest(x[:, cuts[p]:cuts[p + 1]])
                error += distance
            named = [row.tobytes().hex() for row in codes]
            columns = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(named, pa.string()), pa.array(error)], [*rest, "code", "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*rest).schema)
    return rows.select(*rest, "_x").mapInArrow(assign, f"{fields}, code string, error long")


def _moved(rows: DataFrame, books: list[np.ndarray], cuts: list[int]) -> list[np.ndarray]:
    """Each entry replaced by the componentwise floor of the mean of its parts; unused entries stay.

    A task gives one row of sums for each entry that it uses. The sums come to the driver,
    which holds the codebooks: their size is set by parameters.
    """
    width = cuts[-1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Book(b) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            x = _matrix(batch.column("_x"), width)
            for p, book in enumerate(ready):
                part = x[:, cuts[p]:cuts[p + 1]]
                best, _ = book.nearest(part)
                np.add.at(total[p], best, part)
                count[p] += np.bincount(best, minlength=len(book.entries))
        used = [(p, k, int(count[p][k]), total[p][k].tolist()) for p in range(len(books)) for k in np.flatnonzero(count[p]).tolist()]
        yield pa.RecordBatch.from_pylist(
            [{"part": p, "entry": k, "n": n, "sums": s} for p, k, n, s in used],
            pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]),
        )

    partial = rows.select("_x").mapInArrow(sums, "part int, entry int, n long, sums array<long>")
    longest = max(b - a for a, b in zip(cuts, cuts[1:], strict=False))
    each = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(longest)]
    moved = [b.copy() for b in books]
    for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():
        for i in range(moved[row.part].shape[1]):
            moved[row.part][row.entry, i] = row[f"s{i}"] // row.n
    return moved


def train_codebooks(rows: DataFrame, cuts: list[int], order: str, entries: int, rounds: int) -> list[np.ndarray]:
    """A codebook for each part: the parts of the first vectors, moved to the mean of their own ``rounds`` times."""
    first = rows.orderBy(F.col(f"`{order}`").asc_nulls_last(), "_x").select("_x").limit(entries).collect()
    start = np.array([r[0] for r in first], np.int64).reshape(len(first), cuts[-1])
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    for _ in range(rounds):
        books = _moved(rows, books, cuts)
    return books


def encode(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8,
    entries: int = 16, rounds: int = 6, scale: int = 4096,
) -> DataFrame:
    """key, label, code, error, label_error and codebooks_sha256 for every vector that takes part.

    Components become integers ``floor(scale * x)`` and all sums are exact, so reruns agree to
    the digit. Vectors that are null or hold a null or non-finite component take no part, nor do
    those with a component of which the integer passes 2^26 in size (at the scale given, 16,384),
    nor those whose length is not the commonest (of ties the longer). Rows without a key come last
    when the codebook is begun; rows of one key are ordered by their components. Repeated rows
    count as often as they are there. With fewer vectors than entries the codebook has as many
    entries as vectors. A width that the parts do not divide gives parts of two lengths; a part
    without components has code 0 and error 0. No vectors give no rows. Other columns are not read.

    ``entries`` is at most 256. The integers are staged once and read ``rounds + 1`` times; a round
    shuffles one row for each task and used entry. The sums by label are joined back, null labels
    as one group, and are partially added up first, so that a hot label is a few rows; a sum
    beyond 63 bits is null.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has a byte for each part: ask for 1 to 256 entries")
    named = vectors.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{label}`").alias(label), vector)
    whole = whole_vectors(named, vector, scale).where("_x IS NOT NULL").select(key, label, "_x", F.size("_x").alias("_width"))
    kept = stage(whole, "whole_vectors")
    widths = kept.groupBy("_width").count().orderBy(F.desc("count"), F.desc("_width")).first()
    width = widths[0] if widths else 0
    rows, cuts = kept.where(F.col("_width") == width), bounds(width, parts)
    books = train_codebooks(rows, cuts, key, entries, rounds) if widths else []
    text = ",".join(str(v) for book in books for entry in book for v in entry.tolist())
    coded = stage(_assigned(rows, books, cuts, [key, label]), "codes")
    by_label = coded.groupBy(F.col(label).alias("_label")).agg(F.try_sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col(label).eqNullSafe(F.col("_label")))
    return joined.select(key, label, "code", "error", "label_error", F.sha2(F.lit(text).cast("binary"), 256).alias("codebooks_sha256"))


def _oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in SQL: every part measured against every entry of its codebook, round by round."""
    ctes = [f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS x
      FROM embeddings WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true))""",
        f"""cut AS MATERIALIZED (SELECT vec_id, label, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] AS part
      FROM kept, range({parts}) r(p))""",
        f"""book0 AS MATERIALIZED (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS BIGINT) AS k, part AS entry
      FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""]
    for r in range(rounds + 1):
        ctes.append(f"""best{r} AS MATERIALIZED (SELECT c.vec_id, c.label, c.p, c.part, min((d, k)) AS b FROM (
        SELECT c.vec_id, c.label, c.p, c.part, b.k, CAST(list_sum(list_transform(list_zip(c.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM cut c JOIN book{r} b ON c.p = b.p) c GROUP BY ALL)""")
        if r < rounds:
            ctes.append(f"""mean{r} AS MATERIALIZED (SELECT p, k, list(v ORDER BY i) AS entry FROM (
          SELECT p, b[2] AS k, i, CAST(floor(sum(part[i]) / count(*)) AS BIGINT) AS v, sum(part[i]) AS s, count(*) AS n
          FROM best{r}, (SELECT unnest(range(1, 1 + (SELECT max(len(part)) FROM cut))) AS i) GROUP BY p, b[2], i) GROUP BY p, k)""")
            ctes.append(f"""book{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(m.entry, b.entry) AS entry FROM book{r} b LEFT JOIN mean{r} m USING (p, k))""")
    return f"""WITH {', '.join(ctes)}, sha AS (
      SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, k)) AS h FROM book{rounds}),
    coded AS (SELECT vec_id, label, string_agg(printf('%02x', b[2]), '' ORDER BY p) AS code, CAST(sum(b[1]) AS BIGINT) AS error FROM best{rounds} GROUP BY ALL)
    SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM sha) AS codebooks_sha256 FROM coded"""


ORACLE_SQL = _oracle_sql()
