"""What the corpus operators share: session settings, words and their hashes, ranks, batches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stage, tune

# A word is a run of anything but the six ASCII blanks; bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of an Arrow batch. Long documents make a batch large, so batches are short.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
ROWS_PER_SLICE = 2000
MAX_SLICE_BITS = 20

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_SEED = 0x5EED
LANES = 4  # of eight bytes; longer words take a slower hash
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def ready(spark: SparkSession) -> SparkSession:
    """The library's settings and those for Arrow batches, where the session has no own."""
    tune(spark)
    started_with = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for name, value in BATCH_SETTINGS.items():
        if name not in started_with:
            spark.conf.set(name, value)
    return spark


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and a mark. Rows of one doc_id and mark are copies of one another."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), "text", F.xxhash64(doc_id.isNull(), F.col("text")).alias("mark"))


def rows_of(docs: DataFrame, chosen: DataFrame, once: bool = False, times: str | None = None) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names by doc_id and mark, all columns as they are.

    Of copies one, if ``once``; or as many as the column ``times`` of ``chosen`` says, dealt evenly over
    the copies. Copies that differ in other columns lie in the order of a hash of all their columns.
    """
    doc_id, lowest = F.col("doc_id").cast("long"), F.lit(-(1 << 63))
    keys = {"_row_id": F.coalesce(doc_id, lowest), "_row_mark": F.xxhash64(doc_id.isNull(), F.col("text"))}
    extra = [F.col(times).alias("_row_times")] if times else []
    names = chosen.select(F.coalesce("doc_id", lowest).alias("_row_id"), F.col("mark").alias("_row_mark"), *extra)
    found = docs.withColumns(keys).join(names, list(keys), "inner" if times else "left_semi")
    if once or times:
        copies = Window.partitionBy(*keys)
        hashed = [F.col(f"`{f.name}`") for f in docs.schema if not re.search("map|variant", f.dataType.simpleString())]
        found = found.withColumn("_row_copy", F.row_number().over(copies.orderBy(F.xxhash64(*hashed))))
        if once:
            found = found.where("_row_copy = 1")
    if times:
        found = found.withColumn("_row_copies", F.count(F.lit(1)).over(copies)).withColumn(
            "_row_times", F.expr("CAST(_row_times div _row_copies + int(_row_copy <= _row_times % _row_copies) AS int)")
        ).where("_row_times > 0").withColumn("_row_copy", F.explode(F.sequence(F.lit(1), "_row_times")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def whole_text(name: str = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def spread(*columns: Column) -> Column:
    """A hash of 0 to 2^62-1, for an order that has nothing to do with the data."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def slice_bits(rows: int) -> int:
    """Bits of the spread hash that cut ``rows`` rows into slices of about ROWS_PER_SLICE."""
    return min(MAX_SLICE_BITS, max(4, int(rows // ROWS_PER_SLICE).bit_length()))


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, name: str, bits: int) -> DataFrame:
    """The sum of ``value`` over the rows of a group that come before, in the order of ``order``.

    ``order[0]`` is a ``spread`` hash; its first ``bits`` bits cut each group into even slices,
    so that a hot group is many windows. A row's sum is that of the lower slices plus that of
    the rows before it in its own. ``by`` may not hold nulls.
    """
    sliced = df.withColumn("_slice", F.shiftright(F.col(order[0]), 62 - bits))
    totals = sliced.groupBy(*by, "_slice").agg(F.sum(value).alias("_total"))
    lower = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_slice", F.coalesce(F.sum("_total").over(lower), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.withColumn("_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = before.join(offsets, [*by, "_slice"])
    return joined.withColumn(name, (F.col("_offset") + F.col("_before")).cast("long")).drop("_slice", "_offset", "_before")


def in_slices(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with a column ``_slice``: a number that rises from range to range of ``order``.

    Ranges are cut from a sample, and a key with very many rows is cut by the later columns of
    ``order``; rows equal in all of them lie in one slice. The slices are written to a table, so that
    all that is made of them sees the same ones. Give it narrow rows.
    """
    return stage(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), name)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def run_hashes(bytes_: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of bytes from ``starts`` to ``ends``.

    A run of up to LANES lanes of eight bytes begins with its length, and each lane is mixed in by a
    bijection that spreads every bit, so that no run is a Python object; of one length and up to eight
    bytes no two share a hash. Longer runs, of which there are few to the megabyte, take BLAKE2b.
    """
    sizes = ends - starts
    hashes = mix(sizes.astype(np.uint64) * _U(_ODD) + _U(_SEED))
    padded = np.concatenate([bytes_, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the eight bytes from any place on
    short = sizes <= 8 * LANES
    for k in range(LANES):
        at = np.flatnonzero(short & (sizes > 8 * k))
        if not len(at):
            break
        lane = lanes[starts[at] + 8 * k] & _FIRST_BYTES[np.minimum(sizes[at] - 8 * k, 8)]
        hashes[at] = mix(hashes[at] ^ lane)
    for i in np.flatnonzero(~short).tolist():
        digest = hashlib.blake2b(bytes_[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lower-cased, and where each text begins.

    Text ``i`` has the hashes ``h[begins[i]:begins[i + 1]]``.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bytes_ = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    solid = np.concatenate([[False], ~_BLANK[bytes_]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    return run_hashes(bytes_, starts, ends), np.searchsorted(starts, at)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; of fewer words, the one run there is."""
    if not len(words):
        return words
    size = min(size, len(words))
    runs = words[:len(words) - size + 1] + _U(size)
    for k in range(1, size):
        runs = mix(runs * _U(_ODD) + words[k:len(words) - size + 1 + k])
    return np.unique(runs)


def batches(iterator: Iterator[pa.RecordBatch], text: str = "text", most: int = 2 << 20):
    """Slices of the batches with at most ``most`` bytes of text, or of one row.

    Gives the slice without the text, and the texts as bytes.
    """
    for batch in iterator:
        texts = batch.column(batch.schema.get_field_index(text))
        rest = batch.drop_columns([text])
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)) \
            if pa.types.is_binary(texts.type) else np.fromiter((len(x.as_py()) for x in texts), np.int64, len(texts))
        ends, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < len(texts):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
            yield rest.slice(first, last - first), texts.slice(first, last - first).to_pylist()
            first = last
