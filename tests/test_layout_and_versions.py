"""Clustering by several columns, and versions of a table whose columns grew wider."""

from __future__ import annotations

import datetime
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators import layout
from tidemark.session import shared_dir
from tidemark.sources import tables


def read_by(spark, path, name, low, high):
    """The share of files whose range of a column meets low to high."""
    files = glob.glob(f"{path.removeprefix('file://')}/*.parquet")
    spans = [spark.read.parquet(f).agg(F.min(name), F.max(name)).first() for f in files]
    return sum(a is not None and a <= high and b >= low for a, b in spans) / len(files)


def test_files_are_skipped_by_every_column_of_the_curve(spark):
    source, both, one = (shared_dir(spark, n) for n in ("source", "both", "one"))
    table = spark.range(20_000, numPartitions=4).select(
        (F.xxhash64("id") % 1000).cast("int").alias("n"), F.date_add(F.lit("2020-01-01").cast("date"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(700))).cast("int")).alias("day"),
        F.hex("id").alias("text"), F.when(F.col("id") % 10 > 0, F.col("id") * 1.5).alias("x"))
    table.write.parquet(source)
    got = layout.cluster_layout_columns(spark, source, both, ["n", "day"], files=16)
    assert rows(got) == rows(table)
    layout.cluster_layout(spark, source, one, "n", files=16)
    day = (datetime.date(2020, 6, 1), datetime.date(2020, 6, 20))
    assert read_by(spark, both, "n", 100, 150) <= 0.5 and read_by(spark, both, "day", *day) <= 0.5
    assert read_by(spark, one, "day", *day) == 1.0


def test_the_curve_orders_each_column_and_takes_nulls_nan_and_text(spark):
    df = spark.createDataFrame(
        [(i, float(i % 7), f"é{i:03d}", datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=i)) for i in range(200)]
        + [(None, None, None, None), (5, float("nan"), "", None)], "n int, x double, s string, t timestamp")
    for name in df.columns:
        placed = df.select(name, layout.curve(df, [name]).alias("z")).where(F.col(name).isNotNull()).orderBy(name).collect()
        assert [r.z for r in placed if r[0] == r[0]] == sorted(r.z for r in placed if r[0] == r[0])
        assert len({r.z for r in placed}) > (5 if name == "x" else 30)
    assert df.select(layout.curve(df, df.columns).alias("z")).where("z IS NULL").count() == 0
    empty = df.limit(0)
    assert empty.select(layout.curve(empty, ["n", "s"])).count() == 0
    with pytest.raises(ValueError, match="1 to 10 columns"):
        layout.cluster_layout_columns(spark, "a", "b", ["n"] * 11)


I, L, F4, F8 = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()


@pytest.mark.parametrize("a, b, want", [
    (I, L, L), (L, I, L), (F4, F8, F8), (T.ShortType(), F8, F8), (L, F8, None), (I, F4, None), (T.StringType(), I, None),
    (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)),
    (T.DecimalType(38, 2), T.DecimalType(38, 4), None),
])
def test_the_wider_type_holds_both(a, b, want):
    assert tables.wider(a, b) == want


def test_versions_read_as_one(spark):
    root = shared_dir(spark, "versions")
    spark.sql("SELECT 1 a, CAST(1.5 AS FLOAT) b, DATE '2020-01-01' d").write.parquet(f"{root}/1")
    spark.sql("SELECT 1L << 40 a, 0.1D b, 'new' c").write.parquet(f"{root}/2")
    spark.sql("SELECT TIMESTAMP_NTZ '2020-01-01 01:00:00' d, CAST(2 AS SMALLINT) a").write.parquet(f"{root}/3")
    got = tables.merge_versions(spark, [f"{root}/{i}" for i in (1, 2, 3)])
    assert got.dtypes == [("a", "bigint"), ("b", "double"), ("d", "timestamp_ntz"), ("c", "string")]
    day = datetime.datetime(2020, 1, 1)
    assert {tuple(r) for r in got.collect()} == {(1, 1.5, day, None), (1 << 40, 0.1, None, "new"), (2, None, day.replace(hour=1), None)}
    spark.sql("SELECT 'text' a").write.parquet(f"{root}/4")
    with pytest.raises(ValueError, match="a is string in"):
        tables.merge_versions(spark, [f"{root}/3", f"{root}/4"])
