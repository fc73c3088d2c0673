"""Batch loads that take only what is new."""

from __future__ import annotations

import datetime

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.clean import dedupe_by_key
from tidemark.operators.keys import same_key
from tidemark.session import stage
from tidemark.sources.tables import table_or_empty

DAY = "_day"


def read_mark(spark: SparkSession, marks: str) -> datetime.datetime | None:
    """The stored high-water mark: the largest of all that loads have recorded."""
    schema = T.StructType([T.StructField("mark", T.TimestampNTZType())])
    return table_or_empty(spark, marks, schema).agg(F.max("mark")).first()[0]


def _without_key(key: list[str]):
    return reduce(or_, [F.col(k).isNull() for k in key])


def new_rows(feed: DataFrame, seen: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows of ``feed`` that ``seen`` lacks: of a key the first by ``order``, unless the key is known.

    A row that lacks a part of its key has nothing that names it: such rows are compared whole.
    """
    named = dedupe_by_key(feed.where(~_without_key(key)), key, order)
    named = named.alias("f").join(seen.select(*key).alias("s"), same_key("f", "s", key), "left_anti")
    whole = feed.where(_without_key(key)).dropDuplicates()
    nameless = seen.where(_without_key(key)).alias("s")
    return named.unionByName(whole.alias("f").join(nameless, same_key("f", "s", feed.columns), "left_anti"))


def incremental_load(
    feed: DataFrame, target: str, marks: str, ts: str, key: list[str], lateness: datetime.timedelta = datetime.timedelta(0),
    keys: str | None = None,
) -> DataFrame:
    """Append the rows of ``feed`` from the mark on, and those without a time, to ``target``, then record the new mark.

    Rows up to ``lateness`` older than the mark are looked at again. Keys the target already
    has are left out, so a load that is repeated, or that broke off before it recorded its
    mark, adds nothing twice; a row without a key is left out if the target has the whole row.
    The target is partitioned by day: only its last days are opened for that. A key sent again with
    a time of another day is therefore only noticed within these days, unless ``keys`` names a table
    where the keys of all days are kept.
    """
    spark = feed.sparkSession
    time_type = feed.schema[ts].dataType
    stored = T.StructType([*feed.schema.fields, T.StructField(DAY, T.DateType())])
    mark = read_mark(spark, marks)
    seen = table_or_empty(spark, target, stored)
    if mark is not None:
        since = mark - lateness
        # A row at the mark may come late; keys keep the others from being added twice. Rows
        # without a time are looked at on every load, against those of the day without a date.
        newer = (F.col(ts) >= F.lit(since.isoformat(" ")).cast(time_type)) | F.col(ts).isNull()
        feed = feed.where(newer)
        seen = seen.where(((F.col(DAY) >= F.lit(since.date())) | F.col(DAY).isNull()) & newer)
    fresh = new_rows(feed, seen, key, [ts])
    if keys:
        known = table_or_empty(spark, keys, T.StructType([feed.schema[k] for k in key]))
        fresh = stage(fresh.alias("f").join(known.alias("s"), same_key("f", "s", key), "left_anti"), "fresh")
    fresh.withColumn(DAY, F.to_date(ts)).hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(target)
    if keys:  # after the rows: until then the target's last days know them
        fresh.where(~_without_key(key)).select(*key).write.mode("append").parquet(keys)

    after = spark.read.schema(stored).parquet(target)
    last_days = after if mark is None else after.where(F.col(DAY) >= F.lit(mark.date()))
    last_days.agg(F.max(ts).cast("timestamp_ntz").alias("mark")).write.mode("append").parquet(marks)
    return after.drop(DAY)
