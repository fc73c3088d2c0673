"""What the plans must look like to hold at scale."""

from __future__ import annotations

import contextlib
import pathlib
import re

from pyspark.sql import functions as F

from acceptance.frames import frames
from tidemark.operators import clean, joins
from tidemark.plans import facts, kpis

ONE_ROW = {
    ".first(": {"incremental.py", "jdbc.py", "tables.py"}, "isEmpty": {"joins.py"}, "toLocalIterator": {"manifest.py"},
}
LIBRARY = pathlib.Path(__file__).parent.parent / "tidemark"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_library_keeps_data_off_the_driver():
    for source in set(LIBRARY.rglob("*.py")) - set(LIBRARY.glob("llm/*.py")):  # those have their own tests
        text = source.read_text()
        for banned in ["collect(", "toPandas", "toArrow", "localCheckpoint", ".rdd", "F.udf", "crossJoin", "F.broadcast"]:
            assert banned not in text, f"{banned} in {source.name}"
        # Reads of one row or of the entries of a manifest.
        for banned, allowed in ONE_ROW.items():
            assert banned not in text or source.name in allowed, f"{banned} in {source.name}"


def test_ranked_rows_are_cut_before_the_shuffle(spark, sf_dir):
    items, products, geolocation = frames(spark, sf_dir, "f_items", "f_products", "f_geolocation")
    for df in [
        kpis.top_products(items, products),
        clean.dedupe_by_key(geolocation, ["geolocation_latitude", "geolocation_longitude"]),
    ]:
        text = plan(df)
        assert re.search(r"WindowGroupLimit .* Partial", text)
        assert re.search(r"WindowGroupLimit .* Final", text)


def test_scans_read_only_the_columns_needed(spark, sf_dir):
    entities = frames(spark, sf_dir, "f_orders", "f_items", "f_payments", "f_reviews")
    text = facts.sales_monthly(*entities)._jdf.queryExecution().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(s == "l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_tax:double" for s in schemas)
    assert not any("o_orderpriority" in s or "l_comment" in s or "l_quantity" in s for s in schemas)


def test_joins_by_order_share_one_shuffle_each_way(spark, sf_dir):
    entities = frames(spark, sf_dir, "f_orders", "f_items", "f_payments", "f_reviews")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        fact = facts.sales_rows(*entities)
        # Four tables, each shuffled once by the order id; nothing is shuffled again above,
        # not even to count the copies of a row.
        for df in [fact, fact.groupBy(*fact.columns).count()]:
            assert plan(df).count("Exchange hashpartitioning(order_id") == 4
            assert plan(df).count("Exchange") == 4
        monthly = plan(facts.sales_monthly(*entities))
        assert monthly.count("Exchange hashpartitioning(order_id") == 4
        assert monthly.count("Exchange") == 5


def test_a_hot_order_is_split_on_either_side(spark, tmp_path):
    # A third of the items are of one order; they lie in many files.
    items = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("order_id"), F.sha2(F.col("id").cast("string"), 256)
    )
    items.write.parquet(f"{tmp_path}/items")
    items = spark.read.parquet(f"{tmp_path}/items")
    orders = spark.range(60_000).select(F.col("id").alias("order_id"), F.col("id").alias("customer_id"))
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        for joined, split in [
            (joins.orders_with_items(orders, items), True),
            (items.join(orders, "order_id", "left"), True),
            (orders.join(items, "order_id", "left"), False),
            (joins.left_join(orders, items, "order_id", hot_rows=1000), True),
        ]:
            used = joined.agg(F.sum(F.hash(*joined.columns).cast("long")))
            used.collect()
            assert ("skew=true" in plan(used)) == split


def test_windows_without_partition_run_over_reduced_rows(spark, sf_dir):
    orders, items, payments, reviews = frames(spark, sf_dir, "f_orders", "f_items", "f_payments", "f_reviews")
    for df in [kpis.mom_trend(orders, items), kpis.payment_mix(payments), kpis.review_distribution(reviews)]:
        text = plan(df)
        assert text.index("Window") < text.index("HashAggregate")
        assert "SinglePartition" in text
    assert "SinglePartition" not in plan(kpis.new_vs_repeat(orders))
    assert "Window" not in plan(kpis.retention(orders))


def test_row_steps_do_not_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    for step in [
        clean.drop_header_row(df.select(*[F.col(c).cast("string") for c in df.columns])),
        clean.flag_bad_rows(df.select(F.col("o_orderstatus")), {"o_orderstatus": "int"}),
        clean.drop_all_null_rows(df),
    ]:
        assert "Exchange" not in plan(step)
