"""Keys, joins, aggregates, dimensions, facts, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from acceptance.frames import RAW_ENTITIES, frame, frames
from acceptance.oracle import key_sql, kinds
from acceptance.registry import query
from tidemark.operators import joins, keys, quality
from tidemark.plans import dims, facts, gold, silver, wide
from tidemark.session import COMPRESSION, shared_dir, stage

SALES_COLUMNS = (
    "order_id customer_sk product_sk seller_sk order_status purchase_date delivery_date sales_amount shipping_cost "
    "payment_amount payment_type review_score review_sentiment"
)
SALES_KEY = key_sql("SELECT * FROM {sales}", "fact_sales_sk", kinds(
    SALES_COLUMNS, "sales_amount shipping_cost payment_amount"
))
WIDE = """
    SELECT o.*, CAST(date_diff('day', order_purchase_date, order_delivered_customer_date) AS INTEGER)
        AS actual_delivery_time,
      CAST(date_diff('day', order_purchase_date, order_estimated_delivery_date) AS INTEGER) AS estimated_delivery_time,
      CAST(date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS INTEGER) AS delay_time,
      c.* EXCLUDE (customer_id), p.* EXCLUDE (order_id), i.* EXCLUDE (order_id), pr.* EXCLUDE (product_id),
      t.product_category_name_english, s.* EXCLUDE (seller_id)
    FROM (SELECT DISTINCT * FROM {f_orders}) o LEFT JOIN {f_customers} c ON o.customer_id = c.customer_id
      LEFT JOIN {f_payments} p ON o.order_id = p.order_id LEFT JOIN {f_items} i ON o.order_id = i.order_id
      LEFT JOIN {f_products} pr ON i.product_id = pr.product_id
      LEFT JOIN {f_category} t ON pr.product_category_name = t.product_category_name
      LEFT JOIN {f_sellers} s ON i.seller_id = s.seller_id"""


def sales_rows(spark, d):
    return facts.sales_rows(*frames(spark, d, "f_orders", "f_items", "f_payments", "f_reviews"))


def monthly_sales(spark, d):
    return facts.sales_monthly(*frames(spark, d, "f_orders", "f_items", "f_payments", "f_reviews"))


def silver_tables(spark, d):
    return silver.build({e: frame(spark, d, f"raw_{e}") for e in RAW_ENTITIES})


@query("surrogate_key", key_sql("SELECT * FROM {f_dirty}", "row_sk", kinds(
    "order_id payment_sequential payment_type payment_installments payment_value")))
def surrogate_key(spark, d):
    return keys.surrogate_key(frame(spark, d, "f_dirty"), "row_sk")


@query("surrogate_key_hot_copies", key_sql(
    "SELECT payment_type, payment_installments FROM {f_dirty}", "row_sk", kinds("payment_type payment_installments")))
def surrogate_key_hot_copies(spark, d):
    # Few different rows, each with far more copies than a task writes out.
    few = frame(spark, d, "f_dirty").select("payment_type", "payment_installments")
    return keys.surrogate_key(few, "row_sk", copies_per_task=10)


@query("surrogate_key_lookup", f"""
    SELECT s.* REPLACE (coalesce(c.sk, -1) AS customer_sk, coalesce(p.sk, -1) AS product_sk,
      coalesce(v.sk, -1) AS seller_sk)
    FROM {{sales}} s
      LEFT JOIN ({key_sql('SELECT customer_id FROM {f_customers}', 'sk', {'customer_id': 'other'})}) c
        ON s.customer_sk = c.customer_id
      LEFT JOIN ({key_sql('SELECT product_id FROM {f_products}', 'sk', {'product_id': 'other'})}) p
        ON s.product_sk = p.product_id
      LEFT JOIN ({key_sql('SELECT seller_id FROM {f_sellers}', 'sk', {'seller_id': 'other'})}) v
        ON s.seller_sk = v.seller_id""")
def surrogate_key_lookup(spark, d):
    fact = sales_rows(spark, d)
    for entity, natural in [("customers", "customer_id"), ("products", "product_id"), ("sellers", "seller_id")]:
        dim = keys.surrogate_key(frame(spark, d, f"f_{entity}").select(natural), "sk", key=[natural])
        column = natural.replace("_id", "_sk")
        fact = keys.surrogate_key_lookup(fact, dim, column, natural, "sk", column)
    return fact


@query("orphan_keys", """
    SELECT 'customer' AS dimension, CAST(customer_id AS VARCHAR) AS orphan, count(*) AS fact_rows FROM {f_orders} f
    WHERE customer_id NOT IN (SELECT customer_id FROM {f_customers}) GROUP BY 2
    UNION ALL SELECT 'category', product_category_name, count(*) FROM {f_items} f JOIN {f_products} p
      ON f.product_id = p.product_id
    WHERE product_category_name NOT IN (SELECT product_category_name FROM {f_category}) GROUP BY 2
    UNION ALL SELECT 'order without items', CAST(order_id AS VARCHAR), count(*) FROM {f_payments}
    WHERE order_id NOT IN (SELECT order_id FROM {f_items}) GROUP BY 2""")
def orphan_keys(spark, d):
    orders, items, payments, customers, products, category = frames(
        spark, d, "f_orders", "f_items", "f_payments", "f_customers", "f_products", "f_category"
    )
    categories = items.join(products, "product_id").select("product_category_name")
    checks = [
        ("customer", orders, customers, "customer_id"),
        ("category", categories, category, "product_category_name"),
        ("order without items", payments, items, "order_id"),
    ]
    return reduce(lambda a, b: a.unionByName(b), [
        keys.orphan_keys(fact, dim, key, key).select(
            F.lit(name).alias("dimension"), F.col(key).cast("string").alias("orphan"), "fact_rows"
        ) for name, fact, dim, key in checks
    ])


@query("join_inner_orders_items", """
    SELECT o.*, i.* EXCLUDE (order_id) FROM {f_orders} o JOIN {f_items} i ON o.order_id = i.order_id""")
def join_inner_orders_items(spark, d):
    return joins.orders_with_items(*frames(spark, d, "f_orders", "f_items"))


@query("join_left_payments_reviews", """
    SELECT i.order_id, i.product_id, i.price, p.* EXCLUDE (order_id), r.* EXCLUDE (order_id)
    FROM {f_items} i LEFT JOIN {f_payments} p ON i.order_id = p.order_id
      LEFT JOIN {f_reviews} r ON i.order_id = r.order_id""")
def join_left_payments_reviews(spark, d):
    items, payments, reviews = frames(spark, d, "f_items", "f_payments", "f_reviews")
    return joins.with_payments_and_reviews(items.select("order_id", "product_id", "price"), payments, reviews)


@query("join_category_translation", """
    SELECT p.*, product_category_name_english FROM {f_products} p
      LEFT JOIN {f_category} c ON p.product_category_name = c.product_category_name""")
def join_category_translation(spark, d):
    return joins.with_category_translation(*frames(spark, d, "f_products", "f_category"))


@query("join_wide_orders", """
    SELECT o.*, c.* EXCLUDE (customer_id), p.* EXCLUDE (order_id), i.* EXCLUDE (order_id), pr.* EXCLUDE (product_id),
      s.* EXCLUDE (seller_id)
    FROM {f_orders} o LEFT JOIN {f_customers} c ON o.customer_id = c.customer_id
      LEFT JOIN {f_payments} p ON o.order_id = p.order_id LEFT JOIN {f_items} i ON o.order_id = i.order_id
      LEFT JOIN {f_products} pr ON i.product_id = pr.product_id LEFT JOIN {f_sellers} s ON i.seller_id = s.seller_id
    """)
def join_wide_orders(spark, d):
    return joins.wide_orders(*frames(
        spark, d, "f_orders", "f_customers", "f_payments", "f_items", "f_products", "f_sellers"
    ))


@query("join_orders_customers_payments", """
    SELECT o.order_id, o.customer_id, order_purchase_date, payment_type, payment_value
    FROM {f_orders} o JOIN {f_customers} c ON o.customer_id = c.customer_id
      JOIN {f_payments} p ON o.order_id = p.order_id""")
def join_orders_customers_payments(spark, d):
    return joins.orders_customers_payments(*frames(spark, d, "f_orders", "f_customers", "f_payments"))


@query("agg_sales_monthly", "SELECT * FROM {monthly}")
def agg_sales_monthly(spark, d):
    return monthly_sales(spark, d)


@query("agg_revenue_by_month", """
    SELECT year_month, CAST(sum(CAST(total_sales AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM {monthly} GROUP BY year_month""")
def agg_revenue_by_month(spark, d):
    return facts.agg_revenue_by_month(monthly_sales(spark, d))


@query("table_row_count", "SELECT count(*) AS total_rows FROM {sales}")
def table_row_count(spark, d):
    return quality.table_row_count(stage(sales_rows(spark, d), "fact_sales"))


@query("table_column_count", """
    SELECT (SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS total_columns,
      count(*) AS total_rows FROM lineitem""")
def table_column_count(spark, d):
    return quality.table_column_count(frame(spark, d, "lineitem"))


ORDER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_date", "order_approved_date",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
]


@query("null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value FROM {{f_orders}}" for c in ORDER_COLUMNS
))
def null_profile(spark, d):
    return quality.null_profile(frame(spark, d, "f_orders"))


DIM_ROWS = {
    "dim_customer": ("customer_sk", "raw_customers", """
        SELECT customer_id AS natural_customer_key, customer_unique_id, customer_zip_code, customer_city,
          customer_state, customer_full_address FROM {s_customers}""",
        "natural_customer_key customer_unique_id customer_zip_code customer_city customer_state "
        "customer_full_address", ""),
    "dim_seller": ("seller_sk", "raw_sellers", """
        SELECT seller_id AS natural_seller_key, seller_zip_code, seller_city, seller_state FROM {s_sellers}""",
        "natural_seller_key seller_zip_code seller_city seller_state", ""),
    "dim_order_items": ("order_item_sk", "raw_order_items", "SELECT * FROM {s_order_items}",
        "order_id order_item_id product_id seller_id shipping_limit_date price freight_value order_year order_month "
        "order_day order_weekday", "price freight_value"),
    "dim_order_payments": ("payment_sk", "raw_order_payments", "SELECT * FROM {s_order_payments}",
        "order_id payment_sequential payment_type payment_installments payment_value", "payment_value"),
    "dim_order_reviews": ("review_sk", "raw_order_reviews", "SELECT * FROM {s_order_reviews}",
        "review_id order_id review_score review_comment_title review_comment_message review_creation_date "
        "review_answer_timestamp order_review_year order_review_month order_review_day review_answer_year "
        "review_answer_month review_answer_day", ""),
    "dim_orders": ("order_sk", "raw_orders",
        "SELECT order_id AS natural_order_key, * EXCLUDE (order_id) FROM {s_orders}",
        "natural_order_key customer_id order_status " + " ".join(
            [f"order_{e}_date" for e in ["purchase", "approved", "delivered_carrier", "delivered_customer",
                                         "estimated_delivery"]]
            + [f"order_{e}_{p}" for e in ["purchase", "approved", "delivered_carrier", "delivered_customer",
                                          "estimated_delivery"] for p in ["year", "month", "day"]]), ""),
}


def _register_dim(name: str) -> None:
    sk, raw, rows, columns, doubles = DIM_ROWS[name]

    @query(name, key_sql(rows, sk, kinds(columns, doubles)))
    def run(spark, d):
        entity = raw.removeprefix("raw_")
        return getattr(dims, name)(silver.BUILDERS[entity](frame(spark, d, raw)))


for _name in DIM_ROWS:
    _register_dim(_name)

PRODUCT_SIZES = (
    "product_weight_grams product_length_centimeter product_height_centimeter product_width_centimeter"
)


DIM_PRODUCT = key_sql(f"""
    SELECT product_id AS natural_product_key, p.product_category_name AS category,
      product_category_name_english AS category_english, {PRODUCT_SIZES.replace(' ', ', ')}
    FROM {{s_products}} p LEFT JOIN {{s_category_translation}} t ON p.product_category_name = t.product_category_name""",
    "product_sk", kinds(f"natural_product_key category category_english {PRODUCT_SIZES}"))


@query("dim_product", DIM_PRODUCT)
def dim_product(spark, d):
    products, translation = frames(spark, d, "raw_products", "raw_category_translation")
    return dims.dim_product(silver.products(products), silver.category_translation(translation))


@query("dim_geolocation", key_sql("""
    SELECT * EXCLUDE (rn) FROM (
      SELECT geolocation_zip_code AS zip_code, geolocation_latitude AS latitude, geolocation_longitude AS longitude,
        geolocation_city AS city, geolocation_state AS state,
        row_number() OVER (PARTITION BY geolocation_latitude, geolocation_longitude
          ORDER BY geolocation_zip_code, geolocation_city, geolocation_state) AS rn
      FROM {s_geolocation}) WHERE rn = 1""",
    "geolocation_sk", kinds("latitude longitude", "latitude longitude")))
def dim_geolocation(spark, d):
    return dims.dim_geolocation(silver.geolocation(frame(spark, d, "raw_geolocation")))


@query("fact_sales", SALES_KEY)
def fact_sales(spark, d):
    return facts.fact_sales(*frames(spark, d, "f_orders", "f_items", "f_payments", "f_reviews"))


@query("fact_sales_agg", key_sql("SELECT * FROM {monthly}", "fact_sales_agg_sk",
                                 kinds("year month product_sk seller_sk")))
def fact_sales_agg(spark, d):
    return facts.fact_sales_agg(facts.agg_sales_monthly(sales_rows(spark, d)))


@query("bridge_order_items", f"""
    SELECT fact_sales_sk, product_sk, order_status, sales_amount AS total_price,
      fact_sales_sk AS bridge_order_items_sk FROM ({SALES_KEY})""")
def bridge_order_items(spark, d):
    return facts.bridge_order_items(fact_sales(spark, d))


@query("fact_orders_wide", WIDE)
def fact_orders_wide(spark, d):
    return wide.fact_orders_wide(*frames(
        spark, d, "f_orders", "f_customers", "f_payments", "f_items", "f_products", "f_sellers", "f_category"
    ))


def _count(view: str, rows: str) -> str:
    return f"SELECT '{view}' AS view_name, count(*) AS total_rows FROM {rows}"


SILVER_SALES = """
    (SELECT o.order_id, i.product_id, i.seller_id, year(o.order_purchase_date) AS y, month(o.order_purchase_date) AS m
     FROM {s_orders} o JOIN {s_order_items} i ON o.order_id = i.order_id
       LEFT JOIN {s_order_payments} p ON o.order_id = p.order_id
       LEFT JOIN {s_order_reviews} r ON o.order_id = r.order_id)"""


ORACLE_KEYS = {
    "dim_product": DIM_PRODUCT,
    **{n: key_sql(DIM_ROWS[n][2], DIM_ROWS[n][0], kinds(*DIM_ROWS[n][3:])) for n in ["dim_customer", "dim_seller"]},
}


def _dim_key(name: str, entity: str) -> str:
    """For each natural key the row of the dimension that has the lowest key."""
    sql = ORACLE_KEYS[name]
    return f"(SELECT * FROM ({sql}) QUALIFY row_number() OVER (PARTITION BY natural_{entity}_key ORDER BY {entity}_sk) = 1)"


STAR_ORPHANS = " UNION ALL ".join(f"""
    SELECT '{entity}' AS dimension, {entity}_id AS orphan, count(*) AS source_rows FROM {{{source}}}
    WHERE {entity}_id IS NOT NULL AND {entity}_id IN (SELECT {entity}_id FROM {{{source}}} EXCEPT SELECT {entity}_id FROM {{{dim}}})
    GROUP BY 2""" for entity, source, dim in [
        ("customer", "s_orders", "s_customers"), ("product", "s_order_items", "s_products"),
        ("seller", "s_order_items", "s_sellers"),
    ])


@query("star_orphans", STAR_ORPHANS)
def star_orphans(spark, d):
    tables = silver_tables(spark, d)
    return facts.star_orphans(tables["orders"], tables["order_items"], _sales_dimensions(tables))


@query("star_join", f"""
    SELECT o.order_id, o.customer_id, i.product_id, i.seller_id, coalesce(c.customer_sk, -1) AS customer_sk,
      coalesce(pr.product_sk, -1) AS product_sk, coalesce(s.seller_sk, -1) AS seller_sk,
      o.order_purchase_date AS purchase_date, i.price AS sales_amount, p.payment_value AS payment_amount,
      coalesce(p.payment_type, 'Unknown') AS payment_type, coalesce(r.review_score, 0) AS review_score,
      c.customer_city, pr.category, s.seller_state
    FROM {{s_orders}} o JOIN {{s_order_items}} i ON o.order_id = i.order_id
      LEFT JOIN {{s_order_payments}} p ON o.order_id = p.order_id
      LEFT JOIN {{s_order_reviews}} r ON o.order_id = r.order_id
      LEFT JOIN {_dim_key('dim_customer', 'customer')} c ON o.customer_id = c.natural_customer_key
      LEFT JOIN {_dim_key('dim_product', 'product')} pr ON i.product_id = pr.natural_product_key
      LEFT JOIN {_dim_key('dim_seller', 'seller')} s ON i.seller_id = s.natural_seller_key""")
def star_join(spark, d):
    """The fact joined to its dimensions by their keys, all from raw text."""
    tables = silver_tables(spark, d)
    dimensions = _sales_dimensions(tables)
    return facts.fact_sales_star(
        *[tables[n] for n in ["orders", "order_items", "order_payments", "order_reviews"]], dimensions,
        columns={"dim_customer": ["customer_city"], "dim_product": ["category"], "dim_seller": ["seller_state"]},
    ).drop("order_status", "delivery_date", "shipping_cost", "review_sentiment")


def _sales_dimensions(tables):
    return {
        "dim_customer": dims.dim_customer(tables["customers"]),
        "dim_product": dims.dim_product(tables["products"], tables["category_translation"]),
        "dim_seller": dims.dim_seller(tables["sellers"]),
    }


@query("gold_views", " UNION ALL ".join([
    _count("gold_dim_customer", "{s_customers}"),
    _count("gold_dim_geolocation", "(SELECT DISTINCT geolocation_latitude, geolocation_longitude FROM {s_geolocation})"),
    _count("gold_dim_order_items", "{s_order_items}"),
    _count("gold_dim_order_payments", "{s_order_payments}"),
    _count("gold_dim_order_reviews", "{s_order_reviews}"),
    _count("gold_dim_orders", "{s_orders}"),
    _count("gold_dim_product", "{s_products}"),
    _count("gold_dim_seller", "{s_sellers}"),
    _count("gold_fact_sales", SILVER_SALES),
    _count("gold_fact_sales_agg", f"(SELECT DISTINCT y, m, product_id, seller_id FROM {SILVER_SALES})"),
    _count("gold_fact_sales_partitioned", SILVER_SALES),
    _count("gold_fact_order_payments_partitioned", SILVER_SALES),
    _count("gold_bridge_order_items", SILVER_SALES),
    _count("gold_fact_sales_star", SILVER_SALES),
    _count("gold_star_orphans", f"({STAR_ORPHANS})"),
    _count("wide_customers", "{f_customers}"),
    _count("wide_products", "{f_products}"),
    _count("wide_sellers", "{f_sellers}"),
    _count("wide_geolocation", "{f_geolocation}"),
    _count("wide_reviews", "{f_reviews}"),
    _count("wide_payments", "{f_payments}"),
    _count("wide_items", "{f_items}"),
    _count("wide_fact_orders", f"({WIDE})"),
]))
def gold_views(spark, d):
    star, flat = shared_dir(spark, "gold"), shared_dir(spark, "wide")
    cleaned = {name: stage(df, f"silver_{name}", COMPRESSION) for name, df in silver_tables(spark, d).items()}
    gold.write_gold(cleaned, star, stored=True)
    entities = {name: frame(spark, d, f"f_{name}") for name in gold.WIDE_TABLES if name != "fact_orders"}
    gold.write_wide(entities, fact_orders_wide(spark, d), flat)
    views = gold.publish_views(spark, star, gold.STAR_TABLES) + gold.publish_views(
        spark, flat, gold.WIDE_TABLES, prefix="wide_"
    )
    return reduce(lambda a, b: a.unionByName(b), [
        spark.sql(f"SELECT '{v}' AS view_name, count(*) AS total_rows FROM {v}") for v in views
    ])
