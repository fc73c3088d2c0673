"""Explicit schemas of the raw entities and of their cleaned tables.

Raw columns are found by header name, never by position: two swapped id columns of one type
would otherwise pass unnoticed.
"""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    source: str          # header in the raw file
    name: str            # column of the cleaned table
    type: str = "string"
    default: Any = None  # fills nulls; must be valid for the type
    strip: bool = False  # keep letters, digits and blanks only


def _text(source: str, name: str | None = None, strip: bool = False) -> Field:
    return Field(source, name or source, "string", "Unknown", strip)


def _int(source: str, name: str | None = None) -> Field:
    return Field(source, name or source, "int", 0)


def _double(source: str, name: str | None = None) -> Field:
    return Field(source, name or source, "double", 0.0)


def _date(source: str, name: str | None = None) -> Field:
    return Field(source, name or source, "date")


# Headers of the raw files and column names of the cleaned tables.
CUSTOMERS = [
    _text("customer_unique_id", strip=True),
    _text("customer_id"),
    _int("customer_zip_code_prefix", "customer_zip_code"),
    _text("customer_city"),
    _text("customer_state"),
]
GEOLOCATION = [
    _int("geolocation_zip_code_prefix", "geolocation_zip_code"),
    _double("geolocation_lat", "geolocation_latitude"),
    _double("geolocation_lng", "geolocation_longitude"),
    _text("geolocation_city"),
    _text("geolocation_state"),
]
ORDER_ITEMS = [
    _text("order_id", strip=True),
    _int("order_item_id"),
    _text("product_id", strip=True),
    _text("seller_id", strip=True),
    _date("shipping_limit_date"),
    _double("price"),
    _double("freight_value"),
]
ORDER_PAYMENTS = [
    _text("order_id", strip=True),
    _int("payment_sequential"),
    _text("payment_type", strip=True),
    _int("payment_installments"),
    _double("payment_value"),
]
ORDER_REVIEWS = [
    _text("review_id", strip=True),
    _text("order_id", strip=True),
    _int("review_score"),
    _text("review_comment_title", strip=True),
    _text("review_comment_message", strip=True),
    _date("review_creation_date"),
    _date("review_answer_timestamp"),
]
ORDERS = [
    _text("order_id"),
    _text("customer_id"),
    _text("order_status"),
    _date("order_purchase_timestamp", "order_purchase_date"),
    _date("order_approved_at", "order_approved_date"),
    _date("order_delivered_carrier_date"),
    _date("order_delivered_customer_date"),
    _date("order_estimated_delivery_date"),
]
PRODUCTS = [
    _text("product_id"),
    _text("product_category_name"),
    _int("product_name_lenght", "product_name_length"),
    _int("product_description_lenght", "product_description_length"),
    _int("product_photos_qty", "product_photos_quantity"),
    _int("product_weight_g", "product_weight_grams"),
    _int("product_length_cm", "product_length_centimeter"),
    _int("product_height_cm", "product_height_centimeter"),
    _int("product_width_cm", "product_width_centimeter"),
]
SELLERS = [
    _text("seller_id"),
    _int("seller_zip_code_prefix", "seller_zip_code"),
    _text("seller_city"),
    _text("seller_state"),
]
CATEGORY_TRANSLATION = [
    _text("product_category_name"),
    _text("product_category_name_english"),
]

ENTITIES: dict[str, list[Field]] = {
    "customers": CUSTOMERS,
    "geolocation": GEOLOCATION,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "orders": ORDERS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "category_translation": CATEGORY_TRANSLATION,
}


def raw_schema(fields: list[Field]) -> T.StructType:
    """All columns as text, under their header names."""
    return T.StructType([T.StructField(f.source, T.StringType()) for f in fields])
