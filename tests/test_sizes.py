"""Work per task that does not grow with the tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from acceptance import queries_io, registry
from tidemark import session
from tidemark.operators import layout


@pytest.fixture
def initial(spark):
    """The number of partitions that shuffles start with; as it was before, afterwards."""
    spark.conf.unset(session.INITIAL_PARTITIONS)
    yield lambda: session.shuffle_partitions(spark)
    spark.conf.unset(session.INITIAL_PARTITIONS)


def test_shuffles_start_with_partitions_for_the_size(spark, initial):
    session.tune(spark, 10)
    few = initial()
    session.tune(spark, 1000 * session.SHUFFLE_BYTES_PER_TASK)
    assert (initial(), few) == (1000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    session.tune(spark, 10)  # a smaller table after a larger one
    assert initial() == 1000


def test_queries_are_sized_for_their_tables(spark, initial, tmp_path, monkeypatch):
    spark.range(5000).select(F.hex(F.xxhash64("id")).alias("t")).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(session, "SHUFFLE_BYTES_PER_TASK", 1000)
    monkeypatch.setattr(registry, "QUERIES", {})
    monkeypatch.setattr(registry, "ORACLE", {})
    registry.query("q")(lambda spark, d: initial())
    assert registry.QUERIES["q"](spark, str(tmp_path)) > 100


def test_the_rank_is_the_number_of_bounds_below(spark):
    bounds = [1.0, 2.5, 2.75, 9.0, 1e300, float("inf")]
    places = [None, float("-inf"), 0.0, 1.0, 1.5, 2.5, 2.6, 2.75, 3.0, 9.0, 10.0, float("inf")]
    df = spark.createDataFrame([(p,) for p in places], "p double")
    for some in (bounds, [1.0], []):
        found = df.select("p", layout._rank(F.array(*[F.lit(b) for b in some]).cast("array<double>"), F.col("p"), 6).alias("r"))
        assert all(r.r == sum(b < r.p for b in some if r.p is not None) for r in found.collect())
    plan = df.select(layout.curve(df, ["p"]))._jdf.queryExecution().analyzed().toString()
    assert plan.count("lambda") < 40  # the column is ranked once, not for each bit


def test_scattered_files_follow_the_size(spark, tmp_path, monkeypatch):
    import glob

    sales = spark.range(400).select((F.col("id") % 2).cast("string").alias("year_month"), "id")
    sales.write.parquet(f"{tmp_path}/in/lineitem.parquet")
    monkeypatch.setattr(queries_io, "monthly_sales", lambda spark, d: sales)
    monkeypatch.setattr(queries_io, "SHUFFLE_BYTES_PER_TASK", 400)
    monkeypatch.setattr(queries_io, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    assert queries_io.compact_files(spark, f"{tmp_path}/in").count() == 400
    assert len(glob.glob(f"{tmp_path}/scattered/year_month=1/*.parquet")) > 4
    assert len(glob.glob(f"{tmp_path}/compact/year_month=1/*.parquet")) == 1
