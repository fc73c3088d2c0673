"""Cleaned tables to dimensions: defaults for nulls, a surrogate key, the columns to keep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.operators.clean import dedupe_by_key, fill_nulls, rename_columns
from tidemark.operators.joins import with_category_translation
from tidemark.operators.keys import surrogate_key

# The columns of the dimensions and the text for what is not known.
UNKNOWN = "Unknown"

# Numbers the rows of a frame under a name, first.
Number = Callable[[DataFrame, str], DataFrame]


def dim_customer(customers: DataFrame, number: Number = surrogate_key) -> DataFrame:
    rows = rename_columns(customers, {"customer_id": "natural_customer_key"}).select(
        "natural_customer_key", "customer_unique_id", "customer_zip_code", "customer_city", "customer_state",
        "customer_full_address",
    )
    filled = fill_nulls(rows, {
        "natural_customer_key": UNKNOWN, "customer_unique_id": UNKNOWN, "customer_zip_code": 0,
        "customer_city": UNKNOWN, "customer_state": UNKNOWN, "customer_full_address": UNKNOWN,
    })
    return number(filled, "customer_sk")


def dim_product(products: DataFrame, translation: DataFrame, number: Number = surrogate_key) -> DataFrame:
    """``category_english`` stays null where the category has no translation."""
    sizes = [
        "product_weight_grams", "product_length_centimeter", "product_height_centimeter", "product_width_centimeter",
    ]
    filled = fill_nulls(
        products, {"product_id": UNKNOWN, "product_category_name": UNKNOWN, **dict.fromkeys(sizes, 0)}
    )
    rows = rename_columns(with_category_translation(filled, translation), {
        "product_id": "natural_product_key",
        "product_category_name": "category",
        "product_category_name_english": "category_english",
    })
    return number(rows.select("natural_product_key", "category", "category_english", *sizes), "product_sk")


def dim_seller(sellers: DataFrame, number: Number = surrogate_key) -> DataFrame:
    rows = rename_columns(sellers, {"seller_id": "natural_seller_key"}).select(
        "natural_seller_key", "seller_zip_code", "seller_city", "seller_state"
    )
    filled = fill_nulls(rows, {
        "natural_seller_key": UNKNOWN, "seller_zip_code": 0, "seller_city": UNKNOWN, "seller_state": UNKNOWN,
    })
    return number(filled, "seller_sk")


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """One row per coordinate pair: the lowest by zip, city and state."""
    place = ["latitude", "longitude"]
    rows = rename_columns(geolocation, {
        "geolocation_zip_code": "zip_code",
        "geolocation_latitude": "latitude",
        "geolocation_longitude": "longitude",
        "geolocation_city": "city",
        "geolocation_state": "state",
    }).select("zip_code", "latitude", "longitude", "city", "state")
    single = fill_nulls(dedupe_by_key(rows, place), {
        "zip_code": 0, "latitude": 0.0, "longitude": 0.0, "city": UNKNOWN, "state": UNKNOWN,
    })
    return surrogate_key(single, "geolocation_sk", key=place)


def dim_order_items(items: DataFrame, number: Number = surrogate_key) -> DataFrame:
    filled = fill_nulls(items, {
        "order_id": UNKNOWN, "order_item_id": 0, "product_id": UNKNOWN, "seller_id": UNKNOWN,
        "price": 0.0, "freight_value": 0.0,
    })
    return number(filled.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
        "order_year", "order_month", "order_day", "order_weekday",
    ), "order_item_sk")


def dim_order_payments(payments: DataFrame, number: Number = surrogate_key) -> DataFrame:
    filled = fill_nulls(payments, {
        "order_id": UNKNOWN, "payment_sequential": 0, "payment_type": UNKNOWN, "payment_installments": 0,
        "payment_value": 0.0,
    })
    return number(filled.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    ), "payment_sk")


def dim_order_reviews(reviews: DataFrame, number: Number = surrogate_key) -> DataFrame:
    filled = fill_nulls(reviews, {
        "review_id": UNKNOWN, "order_id": UNKNOWN, "review_score": 0, "review_comment_title": UNKNOWN,
        "review_comment_message": UNKNOWN,
    })
    return number(filled.select(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
        "order_review_year", "order_review_month", "order_review_day",
        "review_answer_year", "review_answer_month", "review_answer_day",
    ), "review_sk")


def dim_orders(orders: DataFrame, number: Number = surrogate_key) -> DataFrame:
    """Dates that are missing stay null, and so do their parts."""
    events = ["purchase", "approved", "delivered_carrier", "delivered_customer", "estimated_delivery"]
    rows = rename_columns(orders, {"order_id": "natural_order_key"}).select(
        "natural_order_key", "customer_id", "order_status",
        *[f"order_{e}_date" for e in events],
        *[f"order_{e}_{part}" for e in events for part in ["year", "month", "day"]],
    )
    filled = fill_nulls(rows, {"natural_order_key": UNKNOWN, "customer_id": UNKNOWN, "order_status": UNKNOWN})
    return number(filled, "order_sk")
