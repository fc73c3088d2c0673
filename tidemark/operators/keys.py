"""Surrogate keys and the checks that go with them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import COMPRESSION, shuffle_partitions, stage
from tidemark.sources.tables import one_row, table_or_empty

BUCKET_DIGITS = 4            # 16^4 = 65,536 buckets of rows at least
COPIES_PER_TASK = 1_000_000  # copies of one row that one task writes out
HOT_BUCKET_ROWS = 50_000     # rows of one bucket that a task sorts, copies among them
UNKNOWN_KEY = -1


def row_text(df: DataFrame, columns: list[str]) -> Column:
    """The given columns as one text, written the same way on every platform.

    Fractions count to six places. Rows that differ beyond get one text, and so one digest;
    they are told apart by their columns.
    """
    parts = []
    for name in columns:
        c = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            c = F.rint(c * 1_000_000).try_cast("long")
        parts.append(F.coalesce(c.cast("string"), F.lit("~")))
    return F.concat_ws("|", *parts)


def _digits(df: DataFrame) -> int:
    """Digits that make at least as many buckets as shuffles have partitions."""
    return max(BUCKET_DIGITS, len(f"{shuffle_partitions(df.sparkSession) - 1:x}"))


def surrogate_key(
    df: DataFrame, name: str, key: list[str] | None = None, copies_per_task: int = COPIES_PER_TASK,
    bucket_digits: int | None = None, stored: bool = False,
) -> DataFrame:
    """Number the rows 0, 1, 2 … in the order of the MD5 digest of their content.

    The numbers depend on the data alone: not on files, partitions or runs. ``key`` names
    columns known to identify a row; without it the whole row counts, and exact copies get
    consecutive numbers.

    How it is spread. The first digits of the digest are the bucket. Digests are uniform, so
    buckets are even whatever the data looks like, and no sampling pass is needed. A row's
    number is the rows in lower buckets plus its place within its bucket. Where a row has very many
    copies, all copies are counted, partially before the shuffle, and written out again at the end; a
    row with more than ``copies_per_task`` copies is written out by several tasks. The number of buckets
    follows that of the shuffle partitions. No limit changes a number.

    Not lazy: the frame is computed once and staged; a first pass over that table counts the rows of
    each bucket. Where no bucket has more than ``HOT_BUCKET_ROWS``, no row has very many copies: then the
    rows, copies and all, are shuffled once, and without their digests, which are computed again behind it.
    ``stored`` says that the frame only selects from files that stay as they are: it is read twice then and
    not staged, and digests are shuffled, so that they are not worked out a third time.
    """
    columns = [f"`{c}`" for c in df.columns]
    rows = df if key else _plain_zeros(df)
    staged = rows if stored else stage(rows, name, COMPRESSION)
    text = F.md5(row_text(staged, key or df.columns))
    bucket = F.conv(F.substring(text, 1, bucket_digits or _digits(df)), 16, 10).cast("long")
    totals = stage(
        staged.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows")), f"{name}_buckets", COMPRESSION
    )
    lower = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_offset"))

    # The joins below work on the partitioning and order that the windows leave behind.
    place = Window.partitionBy("_bucket").orderBy("_digest", *columns)
    most = one_row(totals.agg(F.max("_rows")))[0] or 0
    if key or most <= min(copies_per_task, HOT_BUCKET_ROWS):
        placed, digest = staged.withColumn("_bucket", bucket), F.unhex(text)
        if stored:
            together = placed.withColumn("_digest", digest).repartition("_bucket")
        else:
            together = placed.repartition("_bucket").withColumn("_digest", digest)
        numbered = together.withColumn("_place", F.row_number().over(place)).join(offsets, "_bucket")
        return numbered.select((F.col("_offset") + F.col("_place") - 1).alias(name), *columns)

    groups = staged.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    counted = stage(groups.withColumn("_digest", F.unhex(text)), f"{name}_copies", COMPRESSION)
    before = F.coalesce(F.sum("_copies").over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = counted.withColumn("_bucket", bucket).withColumn("_before", before).join(offsets, "_bucket").withColumn(
        "_start", F.col("_offset") + F.col("_before")
    )
    large = F.col("_copies") > copies_per_task
    end = F.col("_start") + F.col("_copies") - 1
    small = numbered.where(~large).select(F.explode(F.sequence("_start", end)).alias(name), *columns)

    first = F.col("_start") + F.col("_chunk") * copies_per_task
    chunks = numbered.where(large).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {copies_per_task}")))
    )
    spread = chunks.repartition("_digest", "_chunk").select(
        F.explode(F.sequence(first, F.least(first + copies_per_task - 1, end))).alias(name), *columns
    )
    return small.unionByName(spread)


def _plain_zeros(df: DataFrame) -> DataFrame:
    """Negative zeros as zeros, as grouping makes them: the two are copies of one row."""
    fractions = [f for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({f.name: (F.col(f"`{f.name}`") + F.lit(0.0)).cast(f.dataType) for f in fractions})


def same_key(left: str, right: str, key: list[str]) -> Column:
    """Equality of the key columns of two aliased frames; null equals null."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key])


def key_map(keys: DataFrame, name: str, path: str) -> DataFrame:
    """The stored numbers of ``keys`` and of all keys before: the key's columns and ``name``.

    A key that an earlier load has numbered keeps its number; new ones are numbered after the
    largest, in the order of their digests, and added to the table at ``path``. So the numbers are
    0, 1, 2 … without gaps, and a load that is repeated changes none. A load that broke off while
    its numbers were being published may leave a gap, but gives no number twice. Loads of one
    map must follow each other. Only the columns of the key are read and shuffled.
    """
    spark, key = keys.sparkSession, keys.columns
    schema = T.StructType([*keys.schema.fields, T.StructField(name, T.LongType())])
    known = table_or_empty(spark, path, schema)
    fresh = keys.distinct().alias("k").join(known.alias("m"), same_key("k", "m", key), "left_anti")
    after = one_row(known.agg(F.coalesce(F.max(name) + 1, F.lit(0).cast("long"))))[0]
    numbered = surrogate_key(fresh, name, key=key)
    numbered.select(*[f"`{k}`" for k in key], (F.col(name) + after).alias(name)).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def stable_key(df: DataFrame, name: str, key: list[str], path: str) -> DataFrame:
    """Number rows by the stored map at ``path``, first, so that a key has one number in all loads.

    Rows of one key share its number. Not lazy: see ``key_map``.
    """
    numbers = key_map(df.select(*[f"`{k}`" for k in key]), name, path)
    columns = [F.col(f"d.`{c}`") for c in df.columns]
    return df.alias("d").join(numbers.alias("m"), same_key("d", "m", key)).select(F.col(f"m.{name}"), *columns)


def surrogate_key_lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str, natural_key: str, dim_sk: str, alias: str,
    columns: list[str] | None = None,
) -> DataFrame:
    """Replace a natural key of the fact by the dimension's key, -1 where it is not there.

    A natural key that occurs twice in the dimension maps to its lowest key, so that the
    fact keeps its grain. ``columns`` are those of the dimension's row with that key, null where
    there is none. They are joined by key to the mapping, which has a row per natural key, so that
    the fact is shuffled once at most. With them it is not lazy: the mapping is staged, which gives the
    planner its size, as the estimate of a join would not.
    """
    columns = columns or []
    mapping = dim.groupBy(F.col(natural_key).alias(fact_key)).agg(F.min(dim_sk).alias("_sk"))
    if columns:
        mapping = stage(mapping.join(dim.select(F.col(dim_sk).alias("_sk"), *columns), "_sk"), alias)
    found = F.coalesce(F.col("_sk"), F.lit(UNKNOWN_KEY).cast("long"))
    replaced = [found.alias(alias) if c == fact_key else F.col(c) for c in fact.columns]
    return fact.join(mapping, fact_key, "left").select(*replaced, *columns)


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, natural_key: str) -> DataFrame:
    """Keys of the fact that the dimension lacks, each with the number of fact rows.

    Both sides are reduced to one row per key first: the join sees no hot key.
    """
    used = fact.where(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("fact_rows"))
    known = dim.select(F.col(natural_key).alias(fact_key)).distinct()
    return used.join(known, fact_key, "left_anti")
