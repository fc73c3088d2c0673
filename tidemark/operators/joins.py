"""Joins of the sales entities. All are equi-joins.

No broadcast is forced. The planner broadcasts a side whose size, estimated or measured at
run time, is below ``spark.sql.autoBroadcastJoinThreshold``; else it sorts and merges by key
and AQE splits a hot key. Joins that follow each other on ``order_id`` share one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

HOT_ROWS = 5_000_000  # rows of one key that a task can still take in


def left_join(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join whose right side may have very many rows of one key.

    AQE splits a hot key of an inner join on both sides, of a left join on the left side only.
    So keys that are hot on the right are joined inner, which for them is the same: they have
    a match. Not lazy: one narrow pass counts the keys; where none is hot, this is the plain left
    join.
    """
    counts = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.where(F.col("_rows") > hot_rows).select(key)
    if hot.isEmpty():
        return left.join(right, key, "left")
    hot = stage(hot, "hot_keys")
    others = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), key, "left")
    return others.unionByName(left.join(hot, key, "left_semi").join(right.join(hot, key, "left_semi"), key))


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items, "order_id", "inner")


def with_payments_and_reviews(lines: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """A line is repeated for every payment and review of its order."""
    return left_join(left_join(lines, payments, "order_id"), reviews, "order_id")


def with_category_translation(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(translation, "product_category_name", "left")


def wide_orders(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, items: DataFrame,
    products: DataFrame, sellers: DataFrame,
) -> DataFrame:
    """Orders with everything known about them, one row per payment and item.

    Products and sellers hang on the item, and are joined to it before payments repeat it.
    """
    with_customers = orders.join(customers, "customer_id", "left")
    described = items.join(products, "product_id", "left").join(sellers, "seller_id", "left")
    return left_join(left_join(with_customers, payments, "order_id"), described, "order_id")


def orders_customers_payments(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Paid orders of known customers."""
    return (
        orders.join(customers.select("customer_id"), "customer_id")
        .join(payments, "order_id")
        .select("order_id", "customer_id", "order_purchase_date", "payment_type", "payment_value")
    )
