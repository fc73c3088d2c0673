"""Checks on finished tables: samples, counts, column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 100


def select_star_sample(df: DataFrame, order: list[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows by a total order."""
    return df.orderBy(*order).limit(rows)


def table_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def table_column_count(df: DataFrame) -> DataFrame:
    """Number of columns, with the number of rows they were found on."""
    return df.agg(
        F.lit(len(df.columns)).cast("long").alias("total_columns"), F.count(F.lit(1)).alias("total_rows")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count, smallest and largest value of every column, in one pass over the table."""
    measures = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        profile = F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(c.isNull()).alias("null_count"),
            F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
        )
        measures.append(profile)
    return df.agg(F.array(*measures).alias("profile")).select(F.inline("profile"))
