"""Projections, casts, nulls, text, dates, cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.frames import frame, frames
from acceptance.oracle import VIEWS, date, number, parts, strip, whole
from acceptance.registry import query
from tidemark.functions import dates, rules, text
from tidemark.operators import clean, quality
from tidemark.plans import silver
from tidemark.sources.tables import merge_schema

DIRTY_TYPES = {
    "payment_sequential": "int", "payment_installments": "int", "payment_value": "double",
}
DIRTY_CAST = f"""
    SELECT order_id, {whole('payment_sequential')} AS payment_sequential, payment_type,
      {whole('payment_installments')} AS payment_installments, {number('payment_value')} AS payment_value
    FROM {{f_dirty}}"""
DIRTY_FLAG = f"""
    concat_ws(',',
      CASE WHEN payment_sequential IS NOT NULL AND ({whole('payment_sequential')}) IS NULL
        THEN 'payment_sequential' END,
      CASE WHEN payment_installments IS NOT NULL AND ({whole('payment_installments')}) IS NULL
        THEN 'payment_installments' END,
      CASE WHEN payment_value IS NOT NULL AND {number('payment_value')} IS NULL THEN 'payment_value' END)"""


@query("rename_columns", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status, "
       "o_totalprice, o_orderdate, o_orderpriority FROM orders")
def rename_columns(spark, d):
    names = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "order_status", "absent": "x"}
    return clean.rename_columns(frame(spark, d, "orders"), names)


@query("cast_columns", DIRTY_CAST)
def cast_columns(spark, d):
    return clean.cast_columns(frame(spark, d, "f_dirty"), DIRTY_TYPES)


@query("ingest_type_conversion", """
    SELECT order_id, try_cast(trunc(try_cast(payment_sequential AS DOUBLE)) AS INTEGER) AS payment_sequential,
      payment_type, try_cast(trunc(try_cast(trim(payment_installments) AS DOUBLE)) AS INTEGER) AS payment_installments,
      try_cast(payment_value AS DOUBLE) AS payment_value
    FROM {f_dirty}""")
def ingest_type_conversion(spark, d):
    target = T.StructType([
        T.StructField("order_id", T.StringType()), T.StructField("payment_sequential", T.IntegerType()),
        T.StructField("payment_type", T.StringType()), T.StructField("payment_installments", T.IntegerType()),
        T.StructField("payment_value", T.DoubleType()),
    ])
    return clean.ingest_type_conversion(frame(spark, d, "f_dirty"), target)


@query("reject_bad_rows", f"""
    SELECT *, CASE WHEN bad_columns = '' THEN 'accepted' ELSE 'rejected' END AS outcome FROM (
      SELECT order_id, payment_type, payment_installments, payment_value, {DIRTY_FLAG} AS bad_columns FROM {{f_dirty}})
    """.replace("payment_installments, payment_value,",
                f"CASE WHEN {DIRTY_FLAG} = '' THEN CAST({whole('payment_installments')} AS VARCHAR) "
                "ELSE payment_installments END AS payment_installments,"))
def reject_bad_rows(spark, d):
    accepted, rejected = clean.reject_bad_rows(frame(spark, d, "f_dirty"), DIRTY_TYPES)
    columns = ["order_id", "payment_type", F.col("payment_installments").cast("string"), "bad_columns", "outcome"]
    good = accepted.withColumns({"bad_columns": F.lit(""), "outcome": F.lit("accepted")}).select(*columns)
    return good.unionByName(rejected.withColumn("outcome", F.lit("rejected")).select(*columns))


@query("reject_bad_rows_whole", f"""
    SELECT *, {DIRTY_FLAG} AS bad_columns FROM {{f_dirty}} WHERE {DIRTY_FLAG} <> ''
    UNION ALL SELECT order_id, CAST(payment_sequential AS VARCHAR), payment_type, CAST(payment_installments AS VARCHAR),
      CAST(CAST(payment_value AS DECIMAL(18,2)) AS VARCHAR), '' FROM ({DIRTY_CAST.replace('{f_dirty}', f"(SELECT * FROM {{f_dirty}} WHERE {DIRTY_FLAG} = '')")})""")
def reject_bad_rows_whole(spark, d):
    """Every column of the rows on either side, accepted values as they were read."""
    accepted, rejected = clean.reject_bad_rows(frame(spark, d, "f_dirty"), DIRTY_TYPES)
    texts = {c: F.col(c).cast("string") for c in ("payment_sequential", "payment_installments")}
    texts["payment_value"] = F.col("payment_value").cast("decimal(18,2)").cast("string")
    return accepted.withColumns(texts).withColumn("bad_columns", F.lit("")).unionByName(rejected)


@query("fill_nulls", f"""
    SELECT coalesce(order_id, 'Unknown') AS order_id, coalesce(payment_sequential, 0) AS payment_sequential,
      coalesce(payment_type, 'Unknown') AS payment_type, coalesce(payment_installments, 0) AS payment_installments,
      coalesce(payment_value, 0.0::DOUBLE) AS payment_value
    FROM ({DIRTY_CAST})""")
def fill_nulls(spark, d):
    cast = clean.cast_columns(frame(spark, d, "f_dirty"), DIRTY_TYPES)
    return clean.fill_nulls(cast, {
        "order_id": "Unknown", "payment_sequential": 0, "payment_type": "Unknown", "payment_installments": 0,
        "payment_value": 0.0,
    })


@query("drop_all_null_rows", """
    SELECT * FROM {f_dirty} WHERE NOT (order_id IS NULL AND payment_sequential IS NULL AND payment_type IS NULL
      AND payment_installments IS NULL AND payment_value IS NULL)""")
def drop_all_null_rows(spark, d):
    return clean.drop_all_null_rows(frame(spark, d, "f_dirty"))


@query("dedupe_full_row", "SELECT DISTINCT * FROM {f_dirty}")
def dedupe_full_row(spark, d):
    return clean.dedupe_full_row(frame(spark, d, "f_dirty"))


@query("dedupe_by_key", """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY geolocation_latitude, geolocation_longitude
        ORDER BY geolocation_zip_code, geolocation_city, geolocation_state) AS rn FROM {f_geolocation})
    WHERE rn = 1""")
def dedupe_by_key(spark, d):
    return clean.dedupe_by_key(frame(spark, d, "f_geolocation"), ["geolocation_latitude", "geolocation_longitude"])


@query("drop_duplicate_columns", """
    SELECT i.*, o.customer_id, o.order_status FROM {f_items} i JOIN {f_orders} o ON i.order_id = o.order_id""")
def drop_duplicate_columns(spark, d):
    items, orders = frames(spark, d, "f_items", "f_orders")
    orders = orders.select("order_id", "customer_id", "order_status")
    return clean.drop_duplicate_columns(items.join(orders, items.order_id == orders.order_id))


@query("select_star_sample", "SELECT * FROM {f_orders} ORDER BY order_id LIMIT 100")
def select_star_sample(spark, d):
    return quality.select_star_sample(frame(spark, d, "f_orders"), ["order_id"])


@query("case_sentiment", """
    SELECT o.order_id, review_id, CASE WHEN review_score >= 4 THEN 'Positive' WHEN review_score = 3 THEN 'Neutral'
      ELSE 'Negative' END AS review_sentiment
    FROM {f_orders} o LEFT JOIN {f_reviews} r ON o.order_id = r.order_id""")
def case_sentiment(spark, d):
    orders, reviews = frames(spark, d, "f_orders", "f_reviews")
    return orders.select("order_id").join(reviews, "order_id", "left").select(
        "order_id", "review_id", rules.review_sentiment(F.col("review_score")).alias("review_sentiment")
    )


@query("merge_schema", """
    SELECT order_id, customer_id, order_status, NULL::DATE AS order_estimated_delivery_date FROM {f_orders}
    UNION ALL SELECT order_id, customer_id, order_status, order_estimated_delivery_date FROM {f_orders}""")
def merge_versions(spark, d):
    newer = frame(spark, d, "f_orders").select(
        "order_id", "customer_id", "order_status", "order_estimated_delivery_date"
    )
    return merge_schema(newer.drop("order_estimated_delivery_date"), newer)


@query("strip_special_chars", f"SELECT doc_id, {strip('text')} AS text FROM documents")
def strip_special_chars(spark, d):
    return frame(spark, d, "documents").select("doc_id", text.strip_special_chars(F.col("text")).alias("text"))


@query("collapse_special_runs", """
    SELECT doc_id, regexp_replace(trim(text, ' '), '[,\\t\\n>$*]{2,}', ', ', 'g') AS text FROM documents""")
def collapse_special_runs(spark, d):
    return frame(spark, d, "documents").select("doc_id", text.collapse_special_runs(F.col("text")).alias("text"))


@query("full_address", """
    SELECT customer_id, concat_ws(' ', customer_city, customer_state, customer_zip_code_prefix) AS address
    FROM {raw_customers}""")
def full_address(spark, d):
    return frame(spark, d, "raw_customers").select("customer_id", text.full_address(
        F.col("customer_city"), F.col("customer_state"), F.col("customer_zip_code_prefix")
    ).alias("address"))


@query("date_parse", f"""
    SELECT order_id, {date('order_purchase_timestamp')} AS purchase,
      {date('order_delivered_customer_date')} AS delivered FROM {{raw_orders}}""")
def date_parse(spark, d):
    return frame(spark, d, "raw_orders").select(
        "order_id", dates.parse_date(F.col("order_purchase_timestamp")).alias("purchase"),
        dates.parse_date(F.col("order_delivered_customer_date")).alias("delivered"),
    )


@query("timestamp_parse", """
    SELECT order_id, try_cast(order_purchase_timestamp AS TIMESTAMP) AS purchase,
      try_cast(order_delivered_customer_date AS TIMESTAMP) AS delivered FROM {raw_orders}""")
def timestamp_parse(spark, d):
    return frame(spark, d, "raw_orders").select(
        "order_id", dates.parse_timestamp(F.col("order_purchase_timestamp")).alias("purchase"),
        dates.parse_timestamp(F.col("order_delivered_customer_date")).alias("delivered"),
    )


@query("date_parts", f"""
    SELECT order_id, order_item_id, {parts('shipping_limit_date', 'ship', weekday=True)} FROM {{f_items}}""")
def date_parts(spark, d):
    named = dates.date_parts(F.col("shipping_limit_date"), "ship", weekday=True)
    return frame(spark, d, "f_items").select(
        "order_id", "order_item_id", *[c.alias(name) for name, c in named.items()]
    )


@query("delivery_days", """
    SELECT order_id, CAST(date_diff('day', order_purchase_date, order_delivered_customer_date) AS INTEGER)
        AS actual_delivery_time,
      CAST(date_diff('day', order_purchase_date, order_estimated_delivery_date) AS INTEGER) AS estimated_delivery_time,
      CAST(date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS INTEGER) AS delay_time
    FROM {f_orders}""")
def delivery_days(spark, d):
    named = dates.delivery_days(
        F.col("order_purchase_date"), F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    )
    return frame(spark, d, "f_orders").select("order_id", *[c.alias(name) for name, c in named.items()])


@query("year_month_label", """
    SELECT order_id, CAST(year(order_purchase_date) AS VARCHAR) || '-' || CAST(month(order_purchase_date) AS VARCHAR)
      AS year_month FROM {f_orders}""")
def year_month_label(spark, d):
    day = F.col("order_purchase_date")
    return frame(spark, d, "f_orders").select(
        "order_id", dates.year_month_label(F.year(day), F.month(day)).alias("year_month")
    )


@query("normalize_city", f"""
    SELECT doc_id, trim(regexp_replace(translate(lower(text), '{text.ACCENTED}', '{text.PLAIN}'),
      '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS text FROM documents""")
def normalize_city(spark, d):
    return frame(spark, d, "documents").select("doc_id", text.normalize_city(F.col("text")).alias("text"))


@query("upper_status", "SELECT event_id, upper(event_type) AS status FROM events")
def upper_status(spark, d):
    return frame(spark, d, "events").select("event_id", text.upper_status(F.col("event_type")).alias("status"))


def _register_silver(entity: str) -> None:
    @query(f"silver_{entity}", f"SELECT * FROM {{s_{entity}}}")
    def run(spark, d):
        return silver.BUILDERS[entity](frame(spark, d, f"raw_{entity}"))


for _entity in silver.BUILDERS:
    assert f"s_{_entity}" in VIEWS
    _register_silver(_entity)
