"""Database tables over JDBC: partitioned reads, batched writes.

Connection properties (user, driver) come from the caller; nothing is stored here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INSERT_BATCH = 500

# Column types of the payments table.
PAYMENT_COLUMN_TYPES = (
    "order_id VARCHAR(50), payment_sequential INT, payment_type VARCHAR(20), "
    "payment_installments INT, payment_value DOUBLE"
)


def split_bounds(spark: SparkSession, url: str, table: str, column: str, properties: dict[str, str]) -> tuple[int, int]:
    """Smallest and largest value of the split column, asked of the database."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    lo, hi = spark.read.jdbc(url, query, properties=properties).first()
    return (0, 1) if lo is None else (int(lo), int(hi))


def scan_jdbc(
    spark: SparkSession, url: str, table: str, column: str, partitions: int, properties: dict[str, str]
) -> DataFrame:
    """Read one table through ``partitions`` connections, split evenly over an integer column."""
    lo, hi = split_bounds(spark, url, table, column, properties)
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lo, upperBound=max(hi, lo + 1), numPartitions=partitions,
        properties=properties,
    )


def write_jdbc_batched(
    df: DataFrame, url: str, table: str, properties: dict[str, str],
    column_types: str = PAYMENT_COLUMN_TYPES, connections: int = 8,
) -> None:
    """Drop and create the table, then insert in batches of 500 rows.

    ``connections`` limits how many tasks write at a time.
    """
    df.write.options(
        batchsize=INSERT_BATCH, createTableColumnTypes=column_types, numPartitions=connections
    ).jdbc(url, table, mode="overwrite", properties=properties)
