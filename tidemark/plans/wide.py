"""One wide table of orders, for readers who want no joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import delivery_days
from tidemark.operators.clean import dedupe_full_row, drop_all_null_rows
from tidemark.operators.joins import wide_orders, with_category_translation


def orders_with_delay(orders: DataFrame) -> DataFrame:
    cleaned = drop_all_null_rows(dedupe_full_row(orders))
    return cleaned.withColumns(delivery_days(
        F.col("order_purchase_date"), F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    ))


def fact_orders_wide(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, items: DataFrame,
    products: DataFrame, sellers: DataFrame, translation: DataFrame,
) -> DataFrame:
    """Orders with delays, customer, payments, items, products and sellers, left-joined."""
    return wide_orders(
        orders_with_delay(orders), customers, payments, items,
        with_category_translation(products, translation), sellers,
    )
