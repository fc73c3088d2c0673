"""SQL for the oracle, written apart from the library: cleaned tables, keys, the sales fact."""

from __future__ import annotations

from acceptance.frames import with_frames


def strip(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9 ]', '', 'g')"


def text(x: str) -> str:
    return f"coalesce({x}, 'Unknown')"


def whole(x: str) -> str:
    """Text as INTEGER, null unless it is a whole number."""
    return f"CASE WHEN regexp_matches(trim({x}), '^[+-]?[0-9]+$') THEN try_cast(trim({x}) AS INTEGER) END"


def number(x: str) -> str:
    return f"try_cast(trim({x}) AS DOUBLE)"


def date(x: str) -> str:
    return f"CAST(try_cast({x} AS TIMESTAMP) AS DATE)"


def parts(day: str, prefix: str, weekday: bool = False) -> str:
    sql = (
        f"CAST(year({day}) AS INTEGER) AS {prefix}_year, CAST(month({day}) AS INTEGER) AS {prefix}_month, "
        f"CAST(day({day}) AS INTEGER) AS {prefix}_day"
    )
    return sql + (f", CAST(dayofweek({day}) + 1 AS INTEGER) AS {prefix}_weekday" if weekday else "")


ORDER_EVENTS = ["purchase", "approved", "delivered_carrier", "delivered_customer", "estimated_delivery"]

VIEWS = {
    "s_customers": f"""
        SELECT *, concat_ws(' ', customer_city, customer_state, CAST(customer_zip_code AS VARCHAR))
          AS customer_full_address
        FROM (SELECT {strip(text('customer_unique_id'))} AS customer_unique_id, {text('customer_id')} AS customer_id,
          coalesce({whole('customer_zip_code_prefix')}, 0) AS customer_zip_code,
          {text('customer_city')} AS customer_city, {text('customer_state')} AS customer_state
          FROM {{raw_customers}})""",
    "s_geolocation": f"""
        SELECT *, concat_ws(' ', geolocation_city, geolocation_state, CAST(geolocation_zip_code AS VARCHAR))
          AS geolocation_full_address
        FROM (SELECT coalesce({whole('geolocation_zip_code_prefix')}, 0) AS geolocation_zip_code,
          coalesce({number('geolocation_lat')}, 0) AS geolocation_latitude,
          coalesce({number('geolocation_lng')}, 0) AS geolocation_longitude,
          {text('geolocation_city')} AS geolocation_city, {text('geolocation_state')} AS geolocation_state
          FROM {{raw_geolocation}})""",
    "s_order_items": f"""
        SELECT *, {parts('shipping_limit_date', 'order', weekday=True)}
        FROM (SELECT regexp_replace(trim({strip(text('order_id'))}), '[,\\t\\n>$*]{{2,}}', ', ', 'g') AS order_id,
          coalesce({whole('order_item_id')}, 0) AS order_item_id, {strip(text('product_id'))} AS product_id,
          {strip(text('seller_id'))} AS seller_id, {date('shipping_limit_date')} AS shipping_limit_date,
          coalesce({number('price')}, 0) AS price, coalesce({number('freight_value')}, 0) AS freight_value
          FROM {{raw_order_items}})""",
    "s_order_payments": f"""
        SELECT {strip(text('order_id'))} AS order_id, coalesce({whole('payment_sequential')}, 0) AS payment_sequential,
          {strip(text('payment_type'))} AS payment_type,
          coalesce({whole('payment_installments')}, 0) AS payment_installments,
          coalesce({number('payment_value')}, 0) AS payment_value
        FROM {{raw_order_payments}}""",
    "s_order_reviews": f"""
        SELECT *, {parts('review_creation_date', 'order_review')}, {parts('review_answer_timestamp', 'review_answer')}
        FROM (SELECT {strip(text('review_id'))} AS review_id, {strip(text('order_id'))} AS order_id,
          coalesce({whole('review_score')}, 0) AS review_score,
          {strip(text('review_comment_title'))} AS review_comment_title,
          {strip(text('review_comment_message'))} AS review_comment_message,
          {date('review_creation_date')} AS review_creation_date,
          {date('review_answer_timestamp')} AS review_answer_timestamp
          FROM {{raw_order_reviews}})""",
    "s_orders": f"""
        SELECT *, {', '.join(parts(f'order_{e}_date', f'order_{e}') for e in ORDER_EVENTS)}
        FROM (SELECT {text('order_id')} AS order_id, {text('customer_id')} AS customer_id,
          {text('order_status')} AS order_status, {date('order_purchase_timestamp')} AS order_purchase_date,
          {date('order_approved_at')} AS order_approved_date,
          {date('order_delivered_carrier_date')} AS order_delivered_carrier_date,
          {date('order_delivered_customer_date')} AS order_delivered_customer_date,
          {date('order_estimated_delivery_date')} AS order_estimated_delivery_date
          FROM {{raw_orders}})""",
    "s_products": f"""
        SELECT {text('product_id')} AS product_id, {text('product_category_name')} AS product_category_name,
          coalesce({whole('product_name_lenght')}, 0) AS product_name_length,
          coalesce({whole('product_description_lenght')}, 0) AS product_description_length,
          coalesce({whole('product_photos_qty')}, 0) AS product_photos_quantity,
          coalesce({whole('product_weight_g')}, 0) AS product_weight_grams,
          coalesce({whole('product_length_cm')}, 0) AS product_length_centimeter,
          coalesce({whole('product_height_cm')}, 0) AS product_height_centimeter,
          coalesce({whole('product_width_cm')}, 0) AS product_width_centimeter
        FROM {{raw_products}}""",
    "s_sellers": f"""
        SELECT {text('seller_id')} AS seller_id, coalesce({whole('seller_zip_code_prefix')}, 0) AS seller_zip_code,
          {text('seller_city')} AS seller_city, {text('seller_state')} AS seller_state
        FROM {{raw_sellers}}""",
    "s_category_translation": f"""
        SELECT {text('product_category_name')} AS product_category_name,
          {text('product_category_name_english')} AS product_category_name_english
        FROM {{raw_category_translation}}""",
    "sales": """
        SELECT o.order_id, o.customer_id AS customer_sk, i.product_id AS product_sk, i.seller_id AS seller_sk,
          o.order_status, o.order_purchase_date AS purchase_date,
          coalesce(o.order_delivered_customer_date, DATE '1900-01-01') AS delivery_date,
          i.price AS sales_amount, i.freight_value AS shipping_cost, p.payment_value AS payment_amount,
          coalesce(p.payment_type, 'Unknown') AS payment_type, coalesce(r.review_score, 0) AS review_score,
          CASE WHEN r.review_score >= 4 THEN 'Positive' WHEN r.review_score = 3 THEN 'Neutral' ELSE 'Negative' END
            AS review_sentiment
        FROM {f_orders} o JOIN {f_items} i ON o.order_id = i.order_id
          LEFT JOIN {f_payments} p ON o.order_id = p.order_id LEFT JOIN {f_reviews} r ON o.order_id = r.order_id""",
    "monthly": """
        SELECT CAST(year(purchase_date) AS INTEGER) AS year, CAST(month(purchase_date) AS INTEGER) AS month,
          CAST(year(purchase_date) AS VARCHAR) || '-' || CAST(month(purchase_date) AS VARCHAR) AS year_month,
          product_sk, seller_sk, CAST(sum(CAST(sales_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
          CAST(sum(CAST(shipping_cost AS DECIMAL(18,2))) AS DOUBLE) AS total_shipping_cost,
          avg(review_score) AS avg_review_score, count(*) AS total_orders
        FROM {sales} GROUP BY ALL""",
    # Order grain, revenue in cents.
    "order_cents": """
        SELECT o.order_id, o.customer_id, o.order_purchase_date, coalesce(i.cents, 0) AS cents
        FROM {f_orders} o LEFT JOIN (
          SELECT order_id, CAST(sum(CAST(CAST(price AS DECIMAL(18,2)) * 100 AS BIGINT)) AS BIGINT) AS cents
          FROM {f_items} GROUP BY order_id) i ON o.order_id = i.order_id""",
    "monthly_cents": """
        SELECT CAST(year(order_purchase_date) AS INTEGER) AS year, CAST(month(order_purchase_date) AS INTEGER) AS month,
          count(*) AS orders, CAST(sum(cents) AS BIGINT) AS cents
        FROM {order_cents} GROUP BY 1, 2""",
}


def sql(query: str) -> str:
    return with_frames(query, **VIEWS)


def key_sql(rows: str, name: str, columns: dict[str, str]) -> str:
    """``rows`` numbered by the digest of ``columns``, given as name to kind."""
    def as_text(column: str, kind: str) -> str:
        c = f"CAST({column} * 1000000 AS BIGINT)" if kind == "double" else column
        return f"coalesce(CAST({c} AS VARCHAR), '~')"

    digest = f"md5(concat_ws('|', {', '.join(as_text(c, k) for c, k in columns.items())}))"
    return f"SELECT row_number() OVER (ORDER BY {digest}) - 1 AS {name}, * FROM ({rows})"


def kinds(columns: str, doubles: str = "") -> dict[str, str]:
    return {c: "double" if c in doubles.split() else "other" for c in columns.split()}
