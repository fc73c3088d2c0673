"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acceptance.oracle import sql
from tidemark.session import SHUFFLED_OF_STORED, tune
from tidemark.sources.tables import table_bytes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``, with the SQL that must give the same rows."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Shuffles start with partitions for the size of the tables.
            return fn(tune(spark, SHUFFLED_OF_STORED * table_bytes(spark, sf_dir)), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = sql(oracle)
        return fn

    return register
