from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import keys
from tidemark.session import stage


def _numbers(df, name="sk"):
    return sorted(r[0] for r in df.select(name).collect())


def test_key_is_dense_and_keeps_every_copy(spark):
    df = spark.createDataFrame([(i % 7, "a", None if i % 3 else 1.5) for i in range(500)], "a int, b string, c double")
    keyed = keys.surrogate_key(df, "sk")
    assert _numbers(keyed) == list(range(500))
    assert rows(keyed.drop("sk")) == rows(df)


def test_key_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10).cast("string").alias("s"))
    once = rows(keys.surrogate_key(df.repartition(1), "sk"))
    again = rows(keys.surrogate_key(df.repartition(7, "s"), "sk"))
    assert once == again


def test_copies_beyond_one_task_are_split_and_all_written(spark):
    # A third of all rows are one row.
    df = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("a"))
    keyed = keys.surrogate_key(df, "sk", copies_per_task=70)
    assert _numbers(keyed) == list(range(900))
    assert rows(keyed.drop("sk")) == rows(df)
    copies = _numbers(keyed.where("a = 0"))
    assert copies == list(range(copies[0], copies[0] + 300))  # one run
    assert rows(keyed) == rows(keys.surrogate_key(df.repartition(5), "sk", copies_per_task=70))


@pytest.mark.parametrize("limits", [{"copies_per_task": 4}, {"copies_per_task": 1}, {"bucket_digits": 1}, {"bucket_digits": 6}])
def test_numbers_do_not_depend_on_limits(spark, limits):
    df = spark.range(60).select((F.col("id") % 3 * F.col("id") % 7).alias("a"), F.lit("x").alias("b"))
    assert rows(keys.surrogate_key(df, "sk", **limits)) == rows(keys.surrogate_key(df, "sk"))


def test_rows_with_one_text_are_told_apart(spark):
    # Null and the mark that stands for it; a difference beyond six places.
    df = spark.createDataFrame([("~", 0.1), (None, 0.1), ("~", 0.1 + 1e-9)], "a string, b double")
    once = rows(keys.surrogate_key(df.repartition(1), "sk"))
    assert [r[0] for r in once] == [0, 1, 2]
    assert once == rows(keys.surrogate_key(df.repartition(3), "sk"))


def test_rows_are_moved_once_and_without_digests(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, name, *rest: staged.append(df) or stage(df, name, *rest))
    df = spark.range(300).select(F.col("id") % 200, F.lit("x").alias("b"))
    keyed = keys.surrogate_key(df, "sk")
    assert _numbers(keyed) == list(range(300))
    assert [s.columns for s in staged] == [df.columns, ["_bucket", "_rows"]]
    before, plan = (f._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1] for f in (staged[0], keyed))
    assert "Exchange" not in before  # what is staged has not been grouped
    moved = [line for line in plan.splitlines() if "Exchange" in line and "_bucket" in line]
    assert sum("REPARTITION_BY_COL" in line for line in moved) == 1  # the rows; the others are totals of buckets


@pytest.mark.parametrize("most", [0, 5, 50_000])
def test_numbers_do_not_depend_on_how_copies_are_counted(spark, monkeypatch, most):
    values = [(i % 5, c) for i in range(40) for c in (0.0, -0.0, float("nan"), 1e-9, 2.5, None)]
    df = spark.createDataFrame(values, "a int, `c d` double")
    text = F.col("`c d`").cast("string").alias("c")
    zeros = df.withColumn("c d", F.col("`c d`") + 0.0)
    monkeypatch.setattr(keys, "HOT_BUCKET_ROWS", most)
    keyed = keys.surrogate_key(df, "sk")
    assert _numbers(keyed) == list(range(240))
    assert rows(keyed.select("a", text)) == rows(zeros.select("a", text))
    runs = keyed.groupBy("a", "c d").agg(F.min("sk").alias("low"), F.max("sk").alias("high"), F.count("*").alias("n"))
    assert runs.where("high - low + 1 <> n").isEmpty()  # copies have consecutive numbers
    monkeypatch.setattr(keys, "HOT_BUCKET_ROWS", 0)
    counted = keys.surrogate_key(df, "sk")
    assert rows(keyed.select("sk", "a", text)) == rows(counted.select("sk", "a", text))


def test_column_names_with_blanks(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "`Delay Time` int, b string")
    assert _numbers(keys.surrogate_key(df, "sk")) == [0, 1]


@pytest.mark.parametrize("dim_rows", [[("a", 5)], [("a", 5), ("a", 9)]])
def test_lookup_keeps_the_grain_and_marks_unknown_keys(spark, dim_rows):
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    dim = spark.createDataFrame(dim_rows, "natural string, sk long")
    got = keys.surrogate_key_lookup(fact, dim, "k", "natural", "sk", "k_sk")
    assert rows(got) == rows(spark.createDataFrame([(5, 1), (5, 2), (-1, 3), (-1, 4)], "k_sk long, v int"))


def test_orphans_are_counted_once_per_key(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("a",)], "natural string")
    assert rows(keys.orphan_keys(fact, dim, "k", "natural")) == [("b", 2)]


@pytest.mark.parametrize("most", [0, 50_000])
def test_rows_of_stored_files_are_numbered_without_a_copy_of_them(spark, monkeypatch, most):
    values = [(i % 50, c) for i in range(120) for c in (0.0, -0.0, float("nan"), None)]
    df = spark.createDataFrame(values, "a int, c double")
    stored, text = stage(df, "rows"), F.col("c").cast("string").alias("c")
    staged = []
    monkeypatch.setattr(keys, "HOT_BUCKET_ROWS", most)
    want = rows(keys.surrogate_key(df, "sk").select("sk", "a", text))
    monkeypatch.setattr(keys, "stage", lambda df, name, *rest: staged.append(name) or stage(df, name, *rest))
    assert rows(keys.surrogate_key(stored, "sk", stored=True).select("sk", "a", text)) == want
    assert staged == ["sk_buckets"] + ["sk_copies"] * (most == 0)
