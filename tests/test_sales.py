from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from acceptance.frames import frames
from tests.conftest import rows
from tidemark.operators import joins
from tidemark.plans import facts, kpis
from tidemark.session import side_by_side, stage

ENTITIES = ["f_orders", "f_items", "f_payments", "f_reviews"]


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """The entities with a third of the items, payments and reviews in one order."""
    orders, items, payments, reviews = frames(spark, sf_dir, *ENTITIES)
    hot = lambda df, n: df.withColumn(
        "order_id", F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("order_id"))
    ).where(f"order_id <> 1 OR pmod(hash(*), {n}) = 0")
    return orders, hot(items, 1), hot(payments, 50), hot(reviews, 50)


def test_left_join_with_hot_keys_equals_left_join(spark, sf_dir):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, l string")
    right = spark.createDataFrame(
        [(1, i) for i in range(9)] + [(2, 0), (4, 0), (None, 1), (None, 2)], "k int, r int"
    )
    want = rows(left.join(right, "k", "left"))
    for hot_rows in [0, 3, 100]:
        assert rows(joins.left_join(left, right, "k", hot_rows)) == want


def test_monthly_sums_without_fan_out_equal_those_of_the_fact(spark, skewed):
    direct = facts.sales_monthly(*skewed)
    from_fact = facts.agg_sales_monthly(facts.sales_rows(*skewed)).select(direct.columns)
    assert rows(direct) == rows(from_fact)


def test_fact_fans_out_and_measures_do_not(spark, sf_dir):
    orders, items, payments, reviews = frames(spark, sf_dir, *ENTITIES)
    revenue = items.agg(F.sum(F.col("price").cast("decimal(18,2)"))).first()[0]
    trend = kpis.mom_trend(orders, items).agg(F.sum(F.col("gross_revenue").cast("decimal(18,2)"))).first()[0]
    fanned = facts.agg_sales_monthly(facts.sales_rows(orders, items, payments, reviews))
    assert trend == revenue
    assert fanned.agg(F.sum(F.col("total_sales").cast("decimal(18,2)"))).first()[0] > revenue


def test_unpaid_and_undelivered_orders(spark):
    orders = spark.createDataFrame(
        [(1, 7, "P", None, None)],
        "order_id long, customer_id long, order_status string, order_purchase_date date, "
        "order_delivered_customer_date date",
    )
    items = spark.createDataFrame([(1, 2, 3, 9.99, 0.5)], "order_id long, product_id long, seller_id long, "
                                  "price double, freight_value double")
    payments = spark.createDataFrame([], "order_id long, payment_value double, payment_type string")
    reviews = spark.createDataFrame([], "order_id long, review_score int")
    row = facts.sales_rows(orders, items, payments, reviews, missing_review="Unknown").first()
    assert (row.payment_amount, row.payment_type, row.review_score) == (None, "Unknown", 0)
    assert (str(row.delivery_date), row.review_sentiment) == ("1900-01-01", "Unknown")


def test_cents_are_exact(spark):
    from tidemark.functions.money import total

    df = spark.range(1_000_000).select((F.col("id") % 1000 / 100).alias("x"))
    assert df.select(total(F.col("x"))).first()[0] == 4995000.0


def test_star_takes_columns_of_its_dimensions_without_moving_the_fact_again(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "P", None, None), ("o2", "c9", "P", None, None), ("o3", None, "P", None, None)],
        "order_id string, customer_id string, order_status string, order_purchase_date date, "
        "order_delivered_customer_date date",
    )
    items = spark.createDataFrame(
        [("o1", "p1", "s1", 1.0, 0.5), ("o1", "p2", None, 2.0, 0.5), ("o2", "p1", "s1", 3.0, 0.5), ("o3", "p1", "s1", 4.0, 0.5)],
        "order_id string, product_id string, seller_id string, price double, freight_value double",
    )
    payments = spark.createDataFrame(
        [("o1", 1.0, "cash"), ("o1", 2.0, "cash")], "order_id string, payment_value double, payment_type string"
    )
    reviews = spark.createDataFrame([], "order_id string, review_score int")
    # Some natural keys come twice; the row with the lowest key counts, with its nulls.
    dimensions = {
        "dim_customer": spark.createDataFrame(
            [("c1", 5, "later"), ("c1", 2, "first"), ("Unknown", 3, "none")],
            "natural_customer_key string, customer_sk long, customer_city string",
        ),
        "dim_product": spark.createDataFrame(
            [("p1", 8, "later"), ("p1", 1, None)], "natural_product_key string, product_sk long, category string"
        ),
        "dim_seller": spark.createDataFrame(
            [("s1", 0, "SP"), ("Unknown", 1, "RJ")], "natural_seller_key string, seller_sk long, seller_state string"
        ),
    }
    entities, columns = [orders, items, payments, reviews], {
        "dim_customer": ["customer_city"], "dim_product": ["category"], "dim_seller": ["seller_state"],
    }
    shown = ["order_id", "sales_amount", "payment_amount", *[c for n, [d] in columns.items() for c in (n.replace("dim_", "") + "_sk", d)]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = facts.fact_sales_star(*entities, dimensions, columns=columns)
        plan = star._jdf.queryExecution().executedPlan().toString()
        got = rows(star.select(*shown))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_key = facts.fact_sales_star(*entities, dimensions)
    for name, [column] in columns.items():
        sk = name.replace("dim_", "") + "_sk"
        by_key = by_key.join(dimensions[name].select(sk, column), sk, "left")
    assert got == rows(by_key.select(*shown))
    assert got == [
        ("o1", 1.0, 1.0, 2, "first", 1, None, 0, "SP"), ("o1", 1.0, 2.0, 2, "first", 1, None, 0, "SP"),
        ("o1", 2.0, 1.0, 2, "first", -1, None, -1, None), ("o1", 2.0, 2.0, 2, "first", -1, None, -1, None),
        ("o2", 3.0, None, -1, None, 1, None, 0, "SP"), ("o3", 4.0, None, -1, None, 1, None, 0, "SP"),
    ]
    # Orders move by customer, items by product and seller, and all four by order; nothing after that.
    moved = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert sorted(moved) == sorted(["order_id"] * 4 + [e + "_sk" for e in ["customer", "product", "seller"]] * 2)


def test_the_numbered_fact_takes_over_the_rows_of_the_stored_star(spark):
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c9"), ("o3", None)], "order_id string, customer_id string").selectExpr(
        "*", "'delivered' AS order_status", "DATE '2020-01-02' AS order_purchase_date", "CAST(NULL AS DATE) AS order_delivered_customer_date")
    items = spark.createDataFrame(
        [("o1", "p1", "s1", 1.0, 0.5), ("o1", "p1", "s1", 1.0, 0.5), ("o2", "p9", None, 3.0, 0.0), ("o3", None, "s1", 4.0, None)],
        "order_id string, product_id string, seller_id string, price double, freight_value double")
    payments = spark.createDataFrame([("o1", 1.0, "boleto"), ("o1", 2.0, "voucher")], "order_id string, payment_value double, payment_type string")
    reviews = spark.createDataFrame([("o2", 4)], "order_id string, review_score int")
    entities = [orders, items, payments, reviews]
    dimensions = {f"dim_{e}": spark.createDataFrame([(f"{e[0]}1", 7), (f"{e[0]}1", 8)], f"natural_{e}_key string, {e}_sk long")
                  for e in ["customer", "product", "seller"]}
    star = stage(facts.fact_sales_star(*entities, dimensions), "star")
    fact = facts.fact_sales(*entities, star=star)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "order_purchase_date" not in plan  # nothing of the entities is read
    joined = facts.fact_sales(*entities)
    assert fact.schema == joined.schema and rows(fact) == rows(joined) and fact.count() == 6


def test_steps_side_by_side_keep_their_order_and_their_error(spark):
    def failing():
        raise ValueError("third")

    counts = [lambda n=n: spark.range(n).count() for n in (5, 3, 8)]
    assert side_by_side(counts, 2) == [5, 3, 8]
    with pytest.raises(ValueError, match="third"):
        side_by_side([*counts, failing])
