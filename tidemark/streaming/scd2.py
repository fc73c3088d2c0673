"""History of slowly changing attributes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.layout import replace_folders
from tidemark.session import stage
from tidemark.sources.tables import few_values, table_or_empty

BUCKET = "_bucket"
BUCKETS = 256


def scd2_merge(
    changes: DataFrame, key: list[str], day: str, attributes: list[str], sequence: list[str] | None = None
) -> DataFrame:
    """Type-2 history from a feed of attribute values: valid_from, valid_to, is_current.

    A row that repeats the values before it opens no version. ``valid_to`` is the day the
    next version starts; it is null for the current one. Where a key has several rows on a
    day, the last wins: by the time in ``day``, then by the columns ``sequence``, and only
    among rows equal in both by the greatest values. The feed is reduced to one row per key
    and day before the shuffle, so that a key has no more rows than there are days.
    """
    values = F.struct(*attributes).alias("values")
    last = F.max(F.struct(F.col(day).alias("at"), *[F.col(c).alias(f"by_{c}") for c in sequence or []], values))
    daily = changes.groupBy(*key, F.col(day).cast("date").alias("valid_from")).agg(last["values"].alias("_now"))
    by_day = Window.partitionBy(*key).orderBy("valid_from")
    versions = daily.withColumn("_before", F.lag("_now").over(by_day)).where(~F.col("_now").eqNullSafe(F.col("_before")))
    valid_to = F.lead("valid_from").over(by_day)
    return versions.select(
        *key, *[F.col(f"_now.{a}").alias(a) for a in attributes], "valid_from",
        valid_to.alias("valid_to"), valid_to.isNull().alias("is_current"),
    )


def scd2_update(
    history: DataFrame, changes: DataFrame, key: list[str], day: str, attributes: list[str],
    sequence: list[str] | None = None,
) -> DataFrame:
    """The stored history with new changes merged in: what ``scd2_merge`` gives for all rows.

    Only the keys that changes name are versioned anew; all other versions pass through. A
    change replaces the stored version of its day. A change of an earlier day is placed where
    it belongs, but a repeat that the history has left out cannot open a version behind it.
    """
    named = changes.select(*key).distinct()
    same = reduce(and_, [F.col(f"h.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key])
    stored = history.alias("h")
    opened = stored.join(named.alias("n"), same, "left_semi")
    first, last = F.lit(0).alias("_new"), F.lit(1).alias("_new")
    # One row for each key and day of the changes, the last; then the stored ones join in.
    order = F.struct(F.col(day).alias("at"), *[F.col(c).alias(f"by_{c}") for c in sequence or []], F.struct(*attributes).alias("values"))
    newest = changes.groupBy(*key, F.col(day).cast("date").alias("valid_from")).agg(F.max(order)["values"].alias("_now")).select(
        *key, "valid_from", last, *[F.col(f"_now.{a}").alias(a) for a in attributes]
    )
    both = opened.select(*key, "valid_from", first, *attributes).unionByName(newest)
    again = scd2_merge(both, key, "valid_from", attributes, sequence=["_new"])
    return stored.join(named.alias("n"), same, "left_anti").unionByName(again)


def _bucket(key: list[str], buckets: int) -> Column:
    """A key's folder. The number of buckets is part of its name, so that two cannot be mixed."""
    return F.concat(F.lit(f"{buckets}-"), F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string"))


def scd2_merge_into(
    path: str, changes: DataFrame, key: list[str], day: str, attributes: list[str], sequence: list[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merge changes into the history stored at ``path`` and return it: ``scd2_update`` in place.

    The history lies in buckets of keys, and only those of changed keys are read and rewritten;
    files of the others stay. Changes that are merged again, as after a failure, change nothing.
    A table keeps the number of buckets that it was begun with: choose it so that a bucket is some
    files' worth, and far more than the keys of a usual load. Loads of one table follow each other; a frame read
    before a load is not to be used after it.
    """
    spark = changes.sparkSession
    fields = {f.name: f for f in changes.schema}
    schema = T.StructType([
        *[fields[c] for c in [*key, *attributes]], T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType()),
        T.StructField("is_current", T.BooleanType()), T.StructField(BUCKET, T.StringType()),
    ])
    stored = table_or_empty(spark, path, schema)
    begun = few_values(stored.select(BUCKET).where(~F.col(BUCKET).startswith(f"{buckets}-")))
    if begun:
        raise ValueError(f"{path} has {begun[0].split('-')[0]} buckets, not {buckets}")
    named = stage(changes.select(*key, day, *attributes, *(sequence or [])), "changes")
    touched = few_values(named.select(_bucket(key, buckets).alias(BUCKET)))
    history = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = scd2_update(history, named, key, day, attributes, sequence).withColumn(BUCKET, _bucket(key, buckets))
    return replace_folders(stage(merged, "history"), path, BUCKET, []).drop(BUCKET)
