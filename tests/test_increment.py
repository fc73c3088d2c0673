"""Loads that follow each other: numbers that stay, months that are left alone, members that come late."""

from __future__ import annotations

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from acceptance.queries_increment import _loads
from acceptance.queries_model import silver_tables
from tests.conftest import rows
from tidemark.operators import keys
from tidemark.plans import facts, increment
from tidemark.session import shared_dir, stage
from tidemark.streaming import events
from tidemark.streaming.incremental import incremental_load


def test_numbers_stay_and_new_ones_follow(spark):
    path = shared_dir(spark, "keys")

    def numbered(values):
        return {tuple(r)[:-1]: r.sk for r in keys.key_map(spark.createDataFrame(values, "a string, b int"), "sk", path).collect()}

    first = numbered([(f"k{i}", i % 3) for i in range(20)] + [(None, 1), (None, None), (None, None)])
    assert sorted(first.values()) == list(range(22))
    second = numbered([("new", 1), (None, 2), ("k3", 0), (None, None)])
    assert {k: v for k, v in second.items() if k in first} == first
    assert sorted(second.values()) == list(range(24))
    assert numbered([("new", 1)]) == second
    assert numbered([]) == second


def test_rows_get_the_number_of_their_key(spark):
    path = shared_dir(spark, "keys")
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "a string, n int")
    first = keys.stable_key(df, "sk", ["a"], path)
    assert first.columns == ["sk", "a", "n"]
    got = {r.n: r.sk for r in first.collect()}
    assert got[1] == got[2] != got[3]
    later = {r.n: r.sk for r in keys.stable_key(df.union(spark.createDataFrame([("y", 4)], df.schema)), "sk", ["a"], path).collect()}
    assert {n: later[n] for n in got} == got and later[4] == 2


def test_a_feed_without_keys_is_neither_lost_nor_doubled(spark):
    target, marks = shared_dir(spark, "rows"), shared_dir(spark, "marks")
    day = datetime.datetime(2024, 1, 1)
    feed = spark.createDataFrame([(None, day, "a"), (None, day, "b"), (None, None, "c"), (1, day, "d"), (1, day, "e")],
                                 "id long, ts timestamp_ntz, x string")
    for _ in range(3):
        loaded = incremental_load(feed, target, marks, "ts", ["id"])
    assert sorted(r.x for r in loaded.collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("kept, want", [(True, 2), (False, 3)])
def test_keys_of_older_days_are_known_where_they_are_kept(spark, kept, want):
    target, marks, known = (shared_dir(spark, n) for n in ("rows", "marks", "known"))
    for i, day in ((1, 1), (2, 5), (1, 10)):
        feed = spark.createDataFrame([(i, datetime.datetime(2024, 1, day))], "id long, ts timestamp_ntz")
        loaded = incremental_load(feed, target, marks, "ts", ["id"], keys=known if kept else None)
    assert loaded.count() == want


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file://')}/**/*.parquet", recursive=True)}


FACT = ["order_id", "customer_id", "product_id", "seller_id", "order_status", "purchase_date", "sales_amount", "payment_amount", "payment_type", "review_score"]


def rebuilt(tables):
    """The fact rows of a single run over all that the loads brought."""
    sales = facts.sales_rows(tables["orders"], tables["order_items"], tables["order_payments"], tables["order_reviews"])
    named = sales.withColumnsRenamed({"customer_sk": "customer_id", "product_sk": "product_id", "seller_sk": "seller_id"})
    return rows(named.select(*FACT))


def test_star_by_loads(spark, sf_dir):
    root = shared_dir(spark, "star")
    whole = silver_tables(spark, sf_dir)
    first, second = _loads(spark, sf_dir)
    before = increment.load_star(spark, first, root, 1)
    early_customers = {r.natural_customer_key: r for r in before["dim_customer"].collect()}
    early_fact = {r.order_id: r.customer_sk for r in before["fact_sales"].select("order_id", "customer_sk").collect()}
    assert any(r.is_inferred and k is not None for k, r in early_customers.items())
    after = increment.load_star(spark, second, root, 2)
    customers = {r.natural_customer_key: r for r in after["dim_customer"].collect()}
    # Every number is still that of its customer, also of those whose row came late.
    assert {k: r.customer_sk for k, r in early_customers.items()} == {k: customers[k].customer_sk for k in early_customers}
    assert sorted(r.customer_sk for r in customers.values()) == list(range(-1, len(customers) - 1))
    assert not any(r.is_inferred for k, r in customers.items() if k is not None)
    assert all(v == customers[k].customer_sk for k, v in {
        r.customer_id: early_fact[r.order_id] for r in after["fact_sales"].select("order_id", "customer_id").collect() if r.order_id in early_fact
    }.items())
    assert rows(after["fact_sales"].select(*FACT)) == rebuilt(whole)

    # A corrected order moves to a month of its own and back; a review comes for another one.
    order = after["fact_sales"].orderBy("purchase_date", "order_id").first().order_id
    nothing = {name: df.limit(0) for name, df in whole.items()}
    moved = whole["orders"].where(F.col("order_id") == order).withColumn("order_purchase_date", F.lit("2031-05-05").cast("date"))
    kept = {t: files(f"{root}/gold/{t}") for t in ("fact_sales", "fact_sales_agg")}
    third = increment.load_star(spark, {**nothing, "orders": moved}, root, 3)
    assert third["fact_sales"].where("sales_month = '2031-5'").select("order_id").distinct().collect() == [(order,)]
    assert third["fact_sales"].where(F.col("order_id") == order).select("purchase_date").distinct().count() == 1
    for table, old in kept.items():
        now = files(f"{root}/gold/{table}")
        rewritten = {f.split("sales_month=")[1].split("/")[0] for f in set(old) ^ set(now)}
        assert len(rewritten) == 2 and "2031-5" in rewritten
        assert all(now[f] == old[f] for f in set(old) & set(now))
    back = increment.load_star(spark, {**nothing, "orders": whole["orders"].where(F.col("order_id") == order)}, root, 4)
    assert not glob.glob(f"{root.removeprefix('file://')}/gold/*/sales_month=2031-5")
    assert rows(back["fact_sales"].select(*FACT)) == rebuilt(whole)
    mart = facts.agg_sales_monthly(back["fact_sales"])
    assert rows(back["fact_sales_agg"].drop(increment.MONTH).select(*mart.columns)) == rows(mart)


def test_a_new_translation_reaches_older_products(spark, sf_dir):
    root = shared_dir(spark, "star")
    whole = silver_tables(spark, sf_dir)
    nothing = {name: df.limit(0) for name, df in whole.items()}
    first = increment.load_star(spark, {**nothing, "products": whole["products"]}, root, 1)
    assert first["dim_product"].where("category_english IS NOT NULL").count() == 0
    second = increment.load_star(spark, {**nothing, "category_translation": whole["category_translation"]}, root, 2)
    joined = whole["products"].join(whole["category_translation"], "product_category_name").where("product_category_name_english IS NOT NULL")
    assert second["dim_product"].where("category_english IS NOT NULL").count() == joined.count() > 0
    numbers = [{r.natural_product_key: r.product_sk for r in t["dim_product"].collect()} for t in (first, second)]
    assert numbers[0] == numbers[1]
    assert second["fact_sales"].count() == 0


def test_late_rows_are_kept_aside_and_a_batch_written_again_changes_nothing(spark):
    root = shared_dir(spark, "kept")

    def batch(*found):
        rows_ = [(i, None if d is None else datetime.datetime(2024, 1, d), t) for i, d, t in found]
        return spark.createDataFrame(rows_, "event_id long, ts timestamp, event_type string")

    batches = [batch((1, 5, "a"), (1, 5, "a"), (2, 6, "a"), (None, 5, "n"), (3, None, "z")), batch((4, 20, "a"), (2, 6, "a"), (5, 1, "b")),
               batch((6, 18, "late"), (7, 19, "edge"), (4, 20, "a")), batch()]
    for number in (0, 1, 1, 2, 3, 2):  # two of them again, the last out of turn
        events.keep_batch(batches[number], number, root, "1 day")
    got = {(r.day and r.day.day, r.event_type): (r.events, r.late) for r in events.kept_and_late(spark, root, batches[0].schema).collect()}
    assert got == {(5, "a"): (1, 0), (5, "n"): (1, 0), (6, "a"): (1, 0), (None, "z"): (1, 0), (20, "a"): (1, 0), (1, "b"): (0, 1),
                   (18, "late"): (0, 1), (19, "edge"): (1, 0)}


def test_the_rows_of_a_month_are_written_once(spark, sf_dir, monkeypatch):
    root = shared_dir(spark, "star")
    staged = []
    monkeypatch.setattr(increment, "stage", lambda df, name: staged.append((name, df.columns)) or stage(df, name))
    feeds = silver_tables(spark, sf_dir)
    loaded = increment.load_star(spark, feeds, root, 1)
    assert [name for name, _ in staged] == ["touched_orders"]  # neither items nor fact rows are staged
    assert len(staged[0][1]) < len(feeds["orders"].columns)
    assert rows(loaded["fact_sales"].select(*FACT)) == rebuilt(feeds)


def test_a_month_left_with_an_order_without_items_loses_its_folder(spark, sf_dir):
    root = shared_dir(spark, "star")
    whole = silver_tables(spark, sf_dir)
    nothing = {name: df.limit(0) for name, df in whole.items()}
    some = whole["orders"].join(whole["order_items"].select("order_id"), "order_id", "left_semi").orderBy("order_id").limit(2)
    first, second = (r.order_id for r in some.orderBy("order_id").collect())
    here, there = (F.lit(d).cast("date") for d in ("2031-05-05", "2032-06-06"))

    def sent(order, day):
        return whole["orders"].where(F.col("order_id") == order).withColumn("order_purchase_date", day)

    items = whole["order_items"].where(F.col("order_id") == first)
    old = increment.load_star(spark, {**nothing, "orders": sent(first, here).union(sent(second, here)), "order_items": items}, root, 1)
    assert {r.sales_month for r in old["fact_sales"].collect()} == {"2031-5"}
    new = increment.load_star(spark, {**nothing, "orders": sent(first, there)}, root, 2)
    for table in ("fact_sales", "fact_sales_agg"):
        assert {r.sales_month for r in new[table].collect()} == {"2032-6"}
    # An order of a month that only another one's payment touches keeps its rows.
    late = increment.load_star(spark, {**nothing, "orders": sent(second, there), "order_items": whole["order_items"].where(
        F.col("order_id") == second)}, root, 3)
    assert {r.order_id for r in late["fact_sales"].collect()} == {first, second}
    assert not glob.glob(f"{root.removeprefix('file://')}/gold/*/sales_month=2031-5")


def _some_orders(spark, sf_dir, *days):
    """Cleaned tables with only so many orders that have items, at the days given, and those items."""
    whole = silver_tables(spark, sf_dir)
    nothing = {name: df.limit(0) for name, df in whole.items()}
    some = whole["orders"].join(whole["order_items"].select("order_id"), "order_id", "left_semi").orderBy("order_id").limit(len(days))
    found = [r.order_id for r in some.orderBy("order_id").collect()]
    day = F.element_at(F.create_map(*[F.lit(x) for pair in zip(found, days) for x in pair]), F.col("order_id")).cast("date")
    orders = whole["orders"].where(F.col("order_id").isin(found)).withColumn("order_purchase_date", day)
    return whole, nothing, orders, whole["order_items"].where(F.col("order_id").isin(found)), found


def test_folders_are_told_apart_by_their_files_and_not_read_again(spark, sf_dir, monkeypatch):
    root = shared_dir(spark, "star")
    read = []
    few = increment.few_values
    monkeypatch.setattr(increment, "few_values", lambda df: read.append(df.columns) or few(df))
    whole, nothing, orders, items, found = _some_orders(spark, sf_dir, "2031-05-05", "2031-06-06")
    increment.load_star(spark, {**nothing, "orders": orders, "order_items": items}, root, 1)
    moved = orders.where(F.col("order_id") == found[0]).withColumn("order_purchase_date", F.lit("2031-06-07").cast("date"))
    for again in range(2):  # the second as after a failure, when the emptied folder of the fact is gone, and that of the mart is back
        loaded = increment.load_star(spark, {**nothing, "orders": moved}, root, 2)
        for table in ("fact_sales", "fact_sales_agg"):
            assert {r.sales_month for r in loaded[table].select("sales_month").distinct().collect()} == {"2031-6"}
        spark.range(1).write.mode("overwrite").parquet(f"{root}/gold/fact_sales_agg/sales_month=2031-5")
    assert read == [["sales_month"]] * 3  # the touched months of each load, and nothing of the fact
    increment.load_star(spark, {**nothing, "orders": moved}, root, 2)
    assert not glob.glob(f"{root.removeprefix('file://')}/gold/*/sales_month=2031-5")


@pytest.mark.parametrize("narrowing", [0, 10**9])
def test_parts_are_sought_out_first_only_where_most_are_dropped(spark, sf_dir, monkeypatch, narrowing):
    monkeypatch.setattr(increment, "NARROWING", narrowing)
    root, plans = shared_dir(spark, "star"), []
    made = increment.replace_folders
    monkeypatch.setattr(increment, "replace_folders", lambda df, *rest: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or made(df, *rest))
    whole, nothing, orders, items, found = _some_orders(spark, sf_dir, "2031-05-05", "2032-06-06", "2033-07-07")
    payments = whole["order_payments"].where(F.col("order_id").isin(found))
    increment.load_star(spark, {**nothing, "orders": orders, "order_items": items, "order_payments": payments}, root, 1)
    last = increment.load_star(spark, {**nothing, "orders": orders.where(F.col("order_id") == found[0])}, root, 2)
    assert rows(last["fact_sales"].select(*FACT)) == rebuilt({**nothing, "orders": orders, "order_items": items, "order_payments": payments})
    assert ["LeftSemi" in plan for plan in plans[::2]] == [narrowing == 0] * 2
