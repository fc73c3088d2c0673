"""Raw entities to cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.dates import date_parts
from tidemark.functions.text import collapse_special_runs, full_address
from tidemark.operators.clean import clean_fields, flag_bad_rows
from tidemark.operators.layout import write_overwrite


def customers(raw: DataFrame) -> DataFrame:
    address = full_address(F.col("customer_city"), F.col("customer_state"), F.col("customer_zip_code"))
    return clean_fields(raw, schemas.CUSTOMERS).withColumn("customer_full_address", address)


def geolocation(raw: DataFrame) -> DataFrame:
    address = full_address(F.col("geolocation_city"), F.col("geolocation_state"), F.col("geolocation_zip_code"))
    return clean_fields(raw, schemas.GEOLOCATION).withColumn("geolocation_full_address", address)


def order_items(raw: DataFrame) -> DataFrame:
    return clean_fields(raw, schemas.ORDER_ITEMS).withColumns({
        "order_id": collapse_special_runs(F.col("order_id")),
        **date_parts(F.col("shipping_limit_date"), "order", weekday=True),
    })


def order_payments(raw: DataFrame) -> DataFrame:
    return clean_fields(raw, schemas.ORDER_PAYMENTS)


def order_reviews(raw: DataFrame) -> DataFrame:
    return clean_fields(raw, schemas.ORDER_REVIEWS).withColumns({
        **date_parts(F.col("review_creation_date"), "order_review"),
        **date_parts(F.col("review_answer_timestamp"), "review_answer"),
    })


def orders(raw: DataFrame) -> DataFrame:
    parts = {}
    for event in ["purchase", "approved", "delivered_carrier", "delivered_customer", "estimated_delivery"]:
        parts |= date_parts(F.col(f"order_{event}_date"), f"order_{event}")
    return clean_fields(raw, schemas.ORDERS).withColumns(parts)


def products(raw: DataFrame) -> DataFrame:
    return clean_fields(raw, schemas.PRODUCTS)


def sellers(raw: DataFrame) -> DataFrame:
    return clean_fields(raw, schemas.SELLERS)


def category_translation(raw: DataFrame) -> DataFrame:
    return clean_fields(raw, schemas.CATEGORY_TRANSLATION)


BUILDERS = {
    "customers": customers,
    "geolocation": geolocation,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "orders": orders,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
}


def build(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: BUILDERS[name](df) for name, df in raw.items()}


def quarantine(raw: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The rows whose values can all be read; the others are written below ``root`` as they came.

    Those have the names of the unreadable columns in ``bad_columns``. A missing value is no
    unreadable one. A row goes to exactly one of the two.
    """
    accepted = {}
    for name, df in raw.items():
        types = {f.source: f.type for f in schemas.ENTITIES[name] if f.type != "string"}
        flagged = flag_bad_rows(df, types)
        write_overwrite(flagged.where("bad_columns <> ''"), f"{root}/{name}")
        accepted[name] = flagged.where("bad_columns = ''").drop("bad_columns")
    return accepted


def write(raw: dict[str, DataFrame], root: str, rejected: str | None = None) -> dict[str, DataFrame]:
    """Clean every entity and write it below ``root``.

    With ``rejected``, rows with unreadable values go below that folder instead; without it
    they stay, with the defaults of their columns.
    """
    raw = quarantine(raw, rejected) if rejected else raw
    return {name: write_overwrite(df, f"{root}/{name}") for name, df in build(raw).items()}
