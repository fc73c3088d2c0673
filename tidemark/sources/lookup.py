"""Small lookup tables exported from a document store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.csv import CSV_FORMAT

STORE_ID = "_id"


def scan_lookup(spark: SparkSession, path: str, columns: list[str], file_format: str = "csv") -> DataFrame:
    """Read a lookup of text columns, without the id the store adds.

    The reader drops a byte order mark before the first header. No broadcast is forced: the
    planner broadcasts the lookup while its size is below the threshold, and joins by key
    beyond it.
    """
    if file_format == "json":
        rows = spark.read.schema(", ".join(f"`{c}` string" for c in [STORE_ID, *columns])).json(path)
    else:
        rows = spark.read.options(**CSV_FORMAT, header=True).csv(path)
    return rows.drop(STORE_ID).select(*columns)
