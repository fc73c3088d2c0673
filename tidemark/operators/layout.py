"""Writing tables and laying out their files.

Partitioned writes go through the rebalance hint: AQE brings the rows of a partition value
together, merges small values into one task and splits a hot one over several, each near the
advisory size. Without it every task would open a file in every folder it has rows for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import COMPRESSION, SHUFFLE_BYTES_PER_TASK, shuffle_partitions
from tidemark.sources.tables import one_row, scan_folders, scan_table, table_bytes

# Bounds the size of a file where rows are narrow and compress well.
MAX_RECORDS_PER_FILE = 20_000_000


def write_overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and read it back. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path, compression=COMPRESSION)
    return scan_table(df.sparkSession, path, df.schema)


def write_layers(frames: dict[str, DataFrame], first: str, second: str) -> dict[str, DataFrame]:
    """Write the same frames below two roots.

    The second copy is made from the files of the first, so each frame is computed once.
    """
    copies = {}
    for name, df in frames.items():
        landed = write_overwrite(df, f"{first}/{name}")
        copies[name] = write_overwrite(landed, f"{second}/{name}")
    return copies


def write_partitioned(df: DataFrame, path: str, by: str, cluster_by: str | None = None) -> DataFrame:
    """Replace the table at ``path``, one folder per value of ``by``, few files in each.

    ``cluster_by`` sorts the rows within each file, for readers that skip row groups.
    """
    placed = df.hint("rebalance", by)
    if cluster_by:
        placed = placed.sortWithinPartitions(f"`{by}`", f"`{cluster_by}`")
    (
        placed.write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(by)
        .parquet(path, compression=COMPRESSION)
    )
    return scan_table(df.sparkSession, path, df.schema).select(*[f"`{c}`" for c in df.columns])


def replace_folders(df: DataFrame, path: str, by: str, emptied: list[str]) -> DataFrame:
    """Replace the folders of the values of ``by`` that ``df`` holds, and leave all others alone.

    ``df`` reads nothing below ``path``. The values in ``emptied`` have no rows any more and lose
    their folders. The same call again, as after a failure, gives the same folders. Values are plain
    text that folder names need not escape.
    """
    (
        df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(by).parquet(path, compression=COMPRESSION)
    )
    return remove_folders(df, path, by, emptied)


def folder_files(spark: SparkSession, path: str, by: str, values: list[str]) -> dict[str, set[str]]:
    """The names of the files in the folder of each value of ``by`` below ``path``. Only folders are listed.

    No two writes give a file one name. Values are plain text, as for ``replace_folders``.
    """
    names = {}
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={value}")
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names[value] = {f.getPath().getName() for f in system.listStatus(folder)} if system.exists(folder) else set()
    return names


def remove_folders(df: DataFrame, path: str, by: str, emptied: list[str]) -> DataFrame:
    """The table at ``path``, with the columns of ``df``, once the values in ``emptied`` have lost their folders."""
    spark = df.sparkSession
    for value in emptied:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return scan_table(spark, path, df.schema).select(*[f"`{c}`" for c in df.columns])


def cluster_layout(
    spark: SparkSession, source: str, target: str, by: str, files: int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Rewrite a table so that each file covers its own range of ``by``, sorted within.

    Readers then skip files and row groups by their min and max. The row id as second range
    column lets the rows of one hot value fall into several files; it is the same on every
    attempt of a task, since the rows come straight from files. Without ``files`` there are
    enough ranges for the bytes of the table, and AQE merges small neighbours up to the advisory
    size. ``schema`` pins the types of partition columns.
    """
    if not files:
        wanted = -(-table_bytes(spark, source) // SHUFFLE_BYTES_PER_TASK)
        files = wanted if wanted > shuffle_partitions(spark) else None
    spread = [F.col(f"`{by}`"), F.col("_row")]
    ranged = scan_table(spark, source, schema).withColumn("_row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(files, *spread) if files else ranged.repartitionByRange(*spread)
    return write_overwrite(ranged.sortWithinPartitions(f"`{by}`").drop("_row"), target)


RANK_BITS = 6  # of each column in the curve: 64 ranges


def _place(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values; of text, of its first six bytes."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    return c.cast("double")


def _known(df: DataFrame, name: str) -> Column:
    """The place, null for NaN, which only fractions can be."""
    place = _place(df, name)
    return F.when(~F.isnan(place), place) if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else place


def curve(df: DataFrame, by: list[str], bits: int = RANK_BITS) -> Column:
    """A number that is close for rows that are close in all columns of ``by``.

    Each column is cut into 2^bits ranges of about as many rows, by quantiles from one pass that
    bring a fixed number of bounds to the driver; the bits of the ranges' numbers are dealt out in
    turn, the highest first. Nulls, and NaN with them, lie in the first range.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    known = {name: _known(df, name) for name in by}
    quantiles = one_row(df.agg(*[F.percentile_approx(known[name], shares, 10_000).alias(f"_{i}") for i, name in enumerate(by)]))
    spread = F.lit(0).cast("long")
    for i, name in enumerate(by):
        bounds = F.array(*[F.lit(float(q)) for q in sorted(set(quantiles[i] or []))]).cast("array<double>")
        dealt = F.array(*[F.lit(_dealt(rank, bits, len(by), i)).cast("long") for rank in range(1 << bits)])
        spread = spread + F.get(dealt, _rank(bounds, known[name], bits))
    return spread


def _dealt(rank: int, bits: int, columns: int, i: int) -> int:
    """The number in the curve that has only the bits of the ``i``-th column's rank."""
    return sum((rank >> bit & 1) << (bit * columns + columns - 1 - i) for bit in range(bits))


def _rank(bounds: Column, place: Column, bits: int) -> Column:
    """How many of the sorted bounds, fewer than 2^bits, lie below the place: 0 for null, found by halving."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])

    def below(known: Column) -> Column:  # beyond the last bound get gives null, which is not below
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < known, at + step).otherwise(at))

    # The place is bound to a name first: each halving would work it out again.
    return F.get(F.transform(F.array(place), below), F.lit(0))


def cluster_layout_columns(
    spark: SparkSession, source: str, target: str, by: list[str], files: int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Rewrite a table so that each file covers a small range of every column of ``by``.

    Readers that filter on any of them skip files by their min and max, which with ``cluster_layout`` only
    those do that filter on its one column. Files are as many, and hot values split, as there. Up to
    ten columns; each more halves what the others skip.
    """
    if not 1 <= len(by) <= 63 // RANK_BITS:
        raise ValueError(f"1 to {63 // RANK_BITS} columns, not {len(by)}")
    if not files:
        wanted = -(-table_bytes(spark, source) // SHUFFLE_BYTES_PER_TASK)
        files = wanted if wanted > shuffle_partitions(spark) else None
    table = scan_table(spark, source, schema)
    placed = table.withColumns({"_curve": curve(table, by), "_row": F.monotonically_increasing_id()})
    spread = [F.col("_curve"), F.col("_row")]
    ranged = placed.repartitionByRange(files, *spread) if files else placed.repartitionByRange(*spread)
    return write_overwrite(ranged.sortWithinPartitions("_curve").drop("_curve", "_row"), target)


def compact_files(
    spark: SparkSession, source: str, target: str, by: str | None = None, cluster_by: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rewrite the many files of a table as few. The source stays as it is.

    The target must be a new folder: readers of plain files would see both copies otherwise.
    ``schema`` pins the types of partition columns. Without it ``by`` stays the text that its
    folders are named with.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError(f"{target} already exists: it is the table itself, which an attempt that fails would lose")
    table = scan_folders(spark, source, by) if by and schema is None else scan_table(spark, source, schema)
    if by:
        return write_partitioned(table, target, by, cluster_by)
    table.hint("rebalance").write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(target, compression=COMPRESSION)
    return scan_table(spark, target, table.schema)


def snapshot_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Freeze ``df`` as an external catalog table whose files lie at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
