"""Frames of the sales entities, derived from the given tables.

One SQL text per frame serves both engines. ``{name}`` stands for a given table or another
frame. ``raw_*`` frames are all text under the headers of the raw files, with the nulls and
odd values that cleaning has to deal with.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def _money_text(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(18,2)) AS STRING)"


FRAMES = {
    "f_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
          CAST(o_orderdate AS DATE) AS order_purchase_date,
          CASE WHEN o_orderkey % 97 <> 0
            THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INT) END AS order_approved_date,
          CASE WHEN o_orderkey % 53 <> 0
            THEN CAST(o_orderdate AS DATE) + CAST(3 + o_orderkey % 5 AS INT) END AS order_delivered_carrier_date,
          CASE WHEN o_orderkey % 31 <> 0
            THEN CAST(o_orderdate AS DATE) + CAST(8 + o_orderkey % 20 AS INT) END AS order_delivered_customer_date,
          CAST(o_orderdate AS DATE) + 20 AS order_estimated_delivery_date
        FROM {orders}""",
    "f_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
          CAST(l_shipdate AS DATE) AS shipping_limit_date, l_extendedprice AS price,
          CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE)
            AS freight_value
        FROM {lineitem}""",
    "f_payments": """
        SELECT o_orderkey AS order_id, 1 AS payment_sequential,
          CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto' WHEN 2 THEN 'voucher'
            ELSE 'debit_card' END AS payment_type,
          CAST(1 + o_orderkey % 10 AS INT) AS payment_installments, o_totalprice AS payment_value
        FROM {orders} WHERE o_orderkey % 50 <> 0
        UNION ALL
        SELECT o_orderkey, 2, 'voucher', 1, o_totalprice
        FROM {orders} WHERE o_orderkey % 7 = 0 AND o_orderkey % 50 <> 0""",
    "f_reviews": """
        SELECT 2 * o_orderkey AS review_id, o_orderkey AS order_id, CAST(1 + o_orderkey % 5 AS INT) AS review_score
        FROM {orders} WHERE o_orderkey % 20 <> 0
        UNION ALL
        SELECT 2 * o_orderkey + 1, o_orderkey, CAST(1 + o_orderkey % 3 AS INT)
        FROM {orders} WHERE o_orderkey % 11 = 0 AND o_orderkey % 20 <> 0""",
    "f_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_nationkey AS customer_zip_code,
          n_name AS customer_city, r_name AS customer_state, c_mktsegment AS customer_segment
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "f_products": """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
          CAST(length(p_name) AS INT) AS product_name_length, p_size * 10 AS product_description_length,
          p_size % 6 AS product_photos_quantity, p_size * 100 AS product_weight_grams,
          p_size AS product_length_centimeter, p_size + 1 AS product_height_centimeter,
          p_size + 2 AS product_width_centimeter
        FROM {part}""",
    "f_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code, n_name AS seller_city, r_name AS seller_state
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "f_geolocation": """
        SELECT CAST(c_nationkey * 1000 + c_custkey % 7 AS INT) AS geolocation_zip_code,
          CAST(c_custkey % 37 AS DOUBLE) - 33 AS geolocation_latitude,
          CAST(c_custkey % 23 AS DOUBLE) - 60 AS geolocation_longitude,
          n_name AS geolocation_city, r_name AS geolocation_state
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # One category has no translation.
    "f_category": """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
        FROM {part} WHERE p_type <> 'STANDARD'""",

    "raw_orders": """
        SELECT CAST(order_id AS STRING) AS order_id, CAST(customer_id AS STRING) AS customer_id,
          CASE WHEN order_id % 41 <> 0 THEN order_status END AS order_status,
          CAST(order_purchase_date AS STRING) || ' 10:56:33' AS order_purchase_timestamp,
          CAST(order_approved_date AS STRING) AS order_approved_at,
          CAST(order_delivered_carrier_date AS STRING) AS order_delivered_carrier_date,
          CASE WHEN order_id % 43 = 0 THEN 'n/a'
            ELSE CAST(order_delivered_customer_date AS STRING) END AS order_delivered_customer_date,
          CAST(order_estimated_delivery_date AS STRING) AS order_estimated_delivery_date
        FROM {f_orders}""",
    "raw_order_items": f"""
        SELECT CASE WHEN order_id % 13 = 0 THEN ' #' ELSE '' END || CAST(order_id AS STRING) AS order_id,
          CAST(order_item_id AS STRING) AS order_item_id, CAST(product_id AS STRING) AS product_id,
          CASE WHEN order_id % 29 <> 0 THEN CAST(seller_id AS STRING) END AS seller_id,
          CASE WHEN order_id % 17 <> 0 THEN CAST(shipping_limit_date AS STRING) END AS shipping_limit_date,
          CASE WHEN order_id % 37 = 0 THEN 'abc' ELSE {_money_text('price')} END AS price,
          {_money_text('freight_value')} AS freight_value
        FROM {{f_items}}""",
    "raw_order_payments": f"""
        SELECT CAST(order_id AS STRING) AS order_id, CAST(payment_sequential AS STRING) AS payment_sequential,
          CASE WHEN order_id % 19 <> 0 THEN payment_type END AS payment_type,
          CASE WHEN order_id % 23 = 0 THEN 'x' ELSE CAST(payment_installments AS STRING) END AS payment_installments,
          {_money_text('payment_value')} AS payment_value
        FROM {{f_payments}}""",
    # The comment is the whole text of the document of that number: line breaks, accents.
    "raw_order_reviews": """
        SELECT CAST(review_id AS STRING) AS review_id, CAST(r.order_id AS STRING) AS order_id,
          CAST(review_score AS STRING) AS review_score, d.source AS review_comment_title,
          d.text AS review_comment_message,
          CAST(CAST(o.o_orderdate AS DATE) + CAST(10 + r.order_id % 5 AS INT) AS STRING) AS review_creation_date,
          CASE WHEN r.order_id % 59 <> 0
            THEN CAST(CAST(o.o_orderdate AS DATE) + CAST(12 + r.order_id % 9 AS INT) AS STRING) || ' 08:00:00'
            END AS review_answer_timestamp
        FROM {f_reviews} r JOIN {orders} o ON r.order_id = o.o_orderkey
          LEFT JOIN {documents} d ON r.order_id = d.doc_id""",
    "raw_customers": """
        SELECT CAST(customer_id AS STRING) AS customer_id, customer_unique_id,
          CASE WHEN customer_id % 47 = 0 THEN 'none' ELSE CAST(customer_zip_code AS STRING) END
            AS customer_zip_code_prefix,
          CASE WHEN customer_id % 31 <> 0 THEN customer_city END AS customer_city, customer_state
        FROM {f_customers}""",
    "raw_products": """
        SELECT CAST(product_id AS STRING) AS product_id,
          CASE WHEN product_id % 61 <> 0 THEN product_category_name END AS product_category_name,
          CAST(product_name_length AS STRING) AS product_name_lenght,
          CAST(product_description_length AS STRING) AS product_description_lenght,
          CAST(product_photos_quantity AS STRING) AS product_photos_qty,
          CASE WHEN product_id % 67 <> 0 THEN CAST(product_weight_grams AS STRING) END AS product_weight_g,
          CAST(product_length_centimeter AS STRING) AS product_length_cm,
          CAST(product_height_centimeter AS STRING) AS product_height_cm,
          CAST(product_width_centimeter AS STRING) AS product_width_cm
        FROM {f_products}""",
    "raw_sellers": """
        SELECT CAST(seller_id AS STRING) AS seller_id, CAST(seller_zip_code AS STRING) AS seller_zip_code_prefix,
          CASE WHEN seller_id % 7 <> 0 THEN seller_city END AS seller_city, seller_state
        FROM {f_sellers}""",
    "raw_geolocation": """
        SELECT CAST(geolocation_zip_code AS STRING) AS geolocation_zip_code_prefix,
          CAST(CAST(geolocation_latitude AS DECIMAL(9,4)) AS STRING) AS geolocation_lat,
          CAST(CAST(geolocation_longitude AS DECIMAL(9,4)) AS STRING) AS geolocation_lng,
          geolocation_city, CASE WHEN geolocation_zip_code % 5 <> 0 THEN geolocation_state END AS geolocation_state
        FROM {f_geolocation}""",
    "raw_category_translation": """
        SELECT product_category_name,
          CASE WHEN product_category_name <> 'PROMO' THEN product_category_name_english END
            AS product_category_name_english
        FROM {f_category}""",

    # Payments as text with faults: unreadable numbers, blanks, odd ids, empty rows, copies.
    "f_dirty": f"""
        WITH d AS (
          SELECT CASE WHEN k % 101 = 0 THEN NULL WHEN k % 23 = 0 THEN '#' || CAST(k AS STRING) || '-ção'
              ELSE CAST(k AS STRING) END AS order_id,
            CASE WHEN k % 101 <> 0 THEN CAST(payment_sequential AS STRING) END AS payment_sequential,
            CASE WHEN k % 101 <> 0 AND k % 19 <> 0 THEN payment_type END AS payment_type,
            CASE WHEN k % 101 = 0 THEN NULL WHEN k % 13 = 0 THEN '' WHEN k % 13 = 1 THEN 'abc'
              WHEN k % 13 = 2 THEN '12.7' WHEN k % 13 = 3 THEN '  5' WHEN k % 13 = 4 THEN 'true'
              ELSE CAST(payment_installments AS STRING) END AS payment_installments,
            CASE WHEN k % 101 = 0 OR k % 17 = 1 THEN NULL WHEN k % 17 = 0 THEN 'abc'
              ELSE {_money_text('payment_value')} END AS payment_value,
            k
          FROM (SELECT *, order_id AS k FROM {{f_payments}}) p
        )
        SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM d
        UNION ALL
        SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM d WHERE k % 10 = 0""",
    # One to three versions per customer; some repeat the segment before.
    "f_changes": """
        SELECT c_custkey AS customer_id, DATE '1995-01-01' AS effective_date, c_mktsegment AS segment FROM {customer}
        UNION ALL
        SELECT c_custkey, DATE '1996-01-01' + CAST(c_custkey % 300 AS INT),
          CASE WHEN c_custkey % 2 = 0 THEN 'BUILDING' ELSE c_mktsegment END
        FROM {customer} WHERE c_custkey % 3 >= 1
        UNION ALL
        SELECT c_custkey, DATE '1998-01-01', 'MACHINERY' FROM {customer} WHERE c_custkey % 3 = 2""",
}

RAW_ENTITIES = [
    "customers", "geolocation", "order_items", "order_payments", "order_reviews", "orders", "products", "sellers",
    "category_translation",
]


def _names(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or derived frame as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = FRAMES[name]
    return spark.sql(sql, **{n: frame(spark, sf_dir, n) for n in _names(sql)})


def frames(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [frame(spark, sf_dir, n) for n in names]


def with_frames(query: str, **views: str) -> str:
    """Oracle SQL for ``query``: the frames and ``views`` it names, as common table expressions."""
    known = {**FRAMES, **views}
    ordered: list[str] = []

    def add(sql: str) -> None:
        for n in _names(sql):
            if n in known and n not in ordered:
                add(known[n])
                ordered.append(n)

    add(query)
    bare = lambda sql: re.sub(r"\{(\w+)\}", r"\1", sql)
    ctes = ",\n".join(f"{n} AS ({bare(known[n])})" for n in ordered)
    return (f"WITH {ctes}\n" if ctes else "") + bare(query)
