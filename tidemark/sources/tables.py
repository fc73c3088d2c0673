"""Columnar tables by path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table; with ``schema`` no file is opened to find it and partition types are pinned."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def table_bytes(spark: SparkSession, paths: str | list[str]) -> int:
    """The size of all files below the paths. Only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.agg(F.sum("length")).first()[0] or 0


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; no rows before a first load has written it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


MOST_VALUES = 100_000


def one_row(df: DataFrame):
    """The row of an aggregate over all rows."""
    return df.first()


def few_values(df: DataFrame, most: int = MOST_VALUES) -> list:
    """The different values of a frame of one column, sorted, without null: months, days or buckets.

    They come to the driver, so more than ``most`` are refused.
    """
    values = df.distinct().limit(most + 1)
    found = values.agg(F.sort_array(F.collect_set(df.columns[0]))).first()[0]
    if len(found) > most:
        raise ValueError(f"more than {most} different values of {df.columns[0]}")
    return found


def scan_folders(spark: SparkSession, path: str, by: str) -> DataFrame:
    """A table with the folder names of ``by`` kept as text, so that ``01`` and ``1`` stay apart."""
    schema = spark.read.parquet(path).schema
    text = T.StructField(by, T.StringType())
    return scan_table(spark, path, T.StructType([text if f.name == by else f for f in schema]))


def scan_partition_folder(
    spark: SparkSession, path: str, partition: dict[str, str], schema: T.StructType | None = None
) -> DataFrame:
    """Read the folders of one partition value only, and keep the partition column.

    The predicate becomes a partition filter, so that other folders are not opened. ``schema``
    pins the type of the partition columns, which Spark otherwise guesses from the folder names.
    """
    wanted: Column = F.lit(True)
    for name, value in partition.items():
        wanted = wanted & (F.col(name) == value)
    return scan_table(spark, path, schema).where(wanted)


def merge_schema(*versions: DataFrame) -> DataFrame:
    """Rows of all versions of a table; a column that one lacks is null there."""
    merged, *rest = versions
    for version in rest:
        merged = merged.unionByName(version, allowMissingColumns=True)
    return merged


# Number types that hold every value of those before them in their row.
WIDER = [
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()],
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()],
    [T.FloatType(), T.DoubleType()],
    [T.DateType(), T.TimestampNTZType()],
]


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrower of the types that hold all values of both; None if there is none."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return next((row[max(row.index(a), row.index(b))] for row in WIDER if a in row and b in row), None)


def merge_versions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The versions of a table that lie at ``paths`` as one, in one scan.

    A column that a version lacks is null there. Where a column became wider, as from int to
    long or from float to double, it has the widest type, which the reader converts to; a column whose
    types have none that holds both is refused, not cut. Columns keep the order in which they came.
    One file's schema is read for each version.
    """
    merged: dict[str, T.DataType] = {}
    for path in paths:
        for field in spark.read.parquet(path).schema:
            known = merged.get(field.name, field.dataType)
            merged[field.name] = wider(known, field.dataType)
            if merged[field.name] is None:
                raise ValueError(f"{field.name} is {field.dataType.simpleString()} in {path}, {known.simpleString()} before")
    return spark.read.schema(T.StructType([T.StructField(name, kind) for name, kind in merged.items()])).parquet(*paths)
