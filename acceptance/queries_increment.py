"""Loads that follow each other: stored keys, the star schema by loads, keys of older days."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from acceptance.frames import frame
from acceptance.queries_model import SILVER_SALES, silver_tables
from acceptance.registry import query
from tidemark.operators import keys
from tidemark.plans import increment
from tidemark.session import COMPRESSION, shared_dir, stage
from tidemark.streaming import events, incremental

HALFWAY = "1995-06-17"  # orders before this day come with the first load

_DIGEST = "md5(CAST(customer_id AS VARCHAR))"


@query("surrogate_key_second_load", f"""
    SELECT * FROM (WITH first AS (SELECT DISTINCT customer_id FROM {{f_orders}} WHERE order_purchase_date < DATE '{HALFWAY}'),
    numbered AS (
      SELECT customer_id, row_number() OVER (ORDER BY {_DIGEST}) - 1 AS customer_sk FROM first
      UNION ALL SELECT customer_id, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY {_DIGEST}) - 1
      FROM {{f_customers}} WHERE customer_id NOT IN (SELECT customer_id FROM first))
    SELECT o.order_id, n.customer_sk, c.customer_city
    FROM {{f_orders}} o JOIN numbered n ON o.customer_id = n.customer_id JOIN {{f_customers}} c ON c.customer_id = o.customer_id)""")
def surrogate_key_second_load(spark, d):
    """Orders keyed by the load that brought them, joined to the dimension as the last load left it."""
    orders, customers = frame(spark, d, "f_orders"), frame(spark, d, "f_customers")
    path, early = shared_dir(spark, "customer_keys"), F.col("order_purchase_date") < F.lit(HALFWAY).cast("date")
    facts = []
    for part, members in [(orders.where(early), orders.where(early).select("customer_id")), (orders.where(~early), customers)]:
        numbers = keys.key_map(members.select("customer_id"), "customer_sk", path)
        # A load's facts stay as they were keyed then.
        facts.append(stage(part.join(numbers, "customer_id").select("order_id", "customer_sk"), "keyed_orders"))
    fact = facts[0].unionByName(facts[1])
    dimension = keys.stable_key(customers, "customer_sk", ["customer_id"], path)
    return fact.join(dimension.select("customer_sk", "customer_city"), "customer_sk").select("order_id", "customer_sk", "customer_city")


def _loads(spark, d):
    """All cleaned entities in two loads: late reviews, customers after their orders, sellers sent twice."""
    # Every load and every run again reads the cleaned tables.
    tables = {name: stage(df, f"silver_{name}", COMPRESSION) for name, df in silver_tables(spark, d).items()}
    early = tables["orders"].where(F.col("order_purchase_date") < F.lit(HALFWAY).cast("date")).select("order_id")
    reviewed = F.col("review_creation_date") < F.lit(HALFWAY).cast("date")
    asia = F.col("customer_state") == "ASIA"
    first, second = {}, {}
    for name, df in tables.items():
        if name == "order_reviews":
            first[name], second[name] = df.where(reviewed), df.where(~reviewed | reviewed.isNull())
        elif name == "customers":
            first[name], second[name] = df.where(~asia | asia.isNull()), df.where(asia)
        elif name in ("orders", "order_items", "order_payments"):
            first[name], second[name] = df.join(early, "order_id", "left_semi"), df.join(early, "order_id", "left_anti")
        else:
            first[name], second[name] = df, df if name == "sellers" else df.limit(0)
    return first, second


def _loaded(spark, d, again: bool = False):
    """The star schema after both loads; with ``again`` the second is run twice, as after a failure."""
    root = shared_dir(spark, "star")
    first, second = _loads(spark, d)
    increment.load_star(spark, first, root, 1)
    tables = increment.load_star(spark, second, root, 2)
    return increment.load_star(spark, second, root, 2) if again else tables


@query("incremental_star", """
    SELECT o.order_id, o.customer_id, i.product_id, i.seller_id, o.order_purchase_date AS purchase_date,
      i.price AS sales_amount, i.freight_value AS shipping_cost, p.payment_value AS payment_amount,
      coalesce(p.payment_type, 'Unknown') AS payment_type, coalesce(r.review_score, 0) AS review_score,
      coalesce(c.customer_city, 'Unknown') AS customer_city, coalesce(pr.product_category_name, 'Unknown') AS category,
      t.product_category_name_english AS category_english, coalesce(s.seller_state, 'Unknown') AS seller_state,
      s.seller_id IS NULL AS inferred_seller
    FROM {s_orders} o JOIN {s_order_items} i ON o.order_id = i.order_id
      LEFT JOIN {s_order_payments} p ON o.order_id = p.order_id
      LEFT JOIN {s_order_reviews} r ON o.order_id = r.order_id
      LEFT JOIN {s_customers} c ON o.customer_id = c.customer_id
      LEFT JOIN {s_products} pr ON i.product_id = pr.product_id
      LEFT JOIN {s_category_translation} t ON pr.product_category_name = t.product_category_name
      LEFT JOIN {s_sellers} s ON i.seller_id = s.seller_id""")
def incremental_star(spark, d):
    """The fact after two loads, joined inner to its dimensions: members that no load brought are inferred."""
    tables = _loaded(spark, d)
    customers = tables["dim_customer"].select("customer_sk", "customer_city")
    products = tables["dim_product"].select("product_sk", "category", "category_english")
    sellers = tables["dim_seller"].select("seller_sk", "seller_state", F.col("is_inferred").alias("inferred_seller"))
    fact = tables["fact_sales"].join(customers, "customer_sk").join(products, "product_sk").join(sellers, "seller_sk")
    return fact.select(
        "order_id", "customer_id", "product_id", "seller_id", "purchase_date", "sales_amount", "shipping_cost", "payment_amount",
        "payment_type", "review_score", "customer_city", "category", "category_english", "seller_state", "inferred_seller",
    )


@query("incremental_marts", f"""
    SELECT y AS year, m AS month, CAST(y AS VARCHAR) || '-' || CAST(m AS VARCHAR) AS year_month, product_id, seller_id,
      CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
      CAST(sum(CAST(freight_value AS DECIMAL(18,2))) AS DOUBLE) AS total_shipping_cost,
      avg(coalesce(review_score, 0)) AS avg_review_score, count(*) AS total_orders
    FROM {SILVER_SALES.replace('i.seller_id,', 'i.seller_id, i.price, i.freight_value, r.review_score,').replace(
        'year(o.order_purchase_date)', 'CAST(year(o.order_purchase_date) AS INTEGER)').replace(
        'month(o.order_purchase_date)', 'CAST(month(o.order_purchase_date) AS INTEGER)')}
    GROUP BY ALL""")
def incremental_marts(spark, d):
    """The monthly mart after two loads and one again, under the natural keys: nothing is counted twice."""
    tables = _loaded(spark, d, again=True)
    products = tables["dim_product"].select("product_sk", F.col("natural_product_key").alias("product_id"))
    sellers = tables["dim_seller"].select("seller_sk", F.col("natural_seller_key").alias("seller_id"))
    mart = tables["fact_sales_agg"].drop(increment.MONTH)
    return mart.join(products, "product_sk").join(sellers, "seller_sk").drop("product_sk", "seller_sk")


# Events of which some have no id, some no time, and some come again on a later day.
FEED = """
    SELECT CASE WHEN event_id % 50 <> 0 THEN event_id END AS event_id,
      CASE WHEN event_id % 30 <> 0 THEN ts END AS ts, user_id, event_type, value FROM events"""


@query("incremental_load_keys", f"SELECT DISTINCT * FROM ({FEED})")
def incremental_load_keys(spark, d):
    """Three loads of a feed with null keys, null times and keys of older days: nothing is lost or doubled."""
    frame(spark, d, "events").createOrReplaceTempView("_events")
    feed = spark.sql(FEED.replace("FROM events", "FROM _events"))
    halfway = F.lit("2024-01-16").cast("timestamp_ntz")
    target, marks, known = (shared_dir(spark, n) for n in ["events", "marks", "event_keys"])
    early = feed.where((F.col("ts") < halfway) | F.col("ts").isNull())
    # Old keys under a new day, as a source that stamps rows when it sends them does.
    again = early.where("event_id IS NOT NULL AND ts IS NOT NULL").withColumn("ts", F.lit("2024-01-29").cast("timestamp_ntz"))
    for delivered in [early, feed.unionByName(again), feed]:
        loaded = incremental.incremental_load(
            delivered, target, marks, "ts", ["event_id"], lateness=datetime.timedelta(hours=1), keys=known)
    return loaded


@query("stream_keep_late", """
    WITH b AS (SELECT *, CASE WHEN event_id % 10 = 0 THEN 3 WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS batch FROM events)
    SELECT CAST(ts AS DATE) AS day, event_type, CAST(count(*) FILTER (NOT late) AS BIGINT) AS events, CAST(count(*) FILTER (late) AS BIGINT) AS late
    FROM (SELECT *, batch = 3 AND ts < (SELECT max(ts) FROM b WHERE batch < 3) - INTERVAL 1 DAY AS late FROM b) GROUP BY ALL""".replace(
        "WITH b AS", "SELECT * FROM (WITH b AS") + ")")
def stream_keep_late(spark, d):
    """Three files in three batches; a tenth of all events comes last, most of it late. The first is sent twice."""
    feed = frame(spark, d, "events")
    root, landing, checkpoint = (shared_dir(spark, n) for n in ["kept", "landing", "checkpoint"])
    last, early = F.col("event_id") % 10 == 0, F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in [feed.where(~last & early), feed.where(~last & ~early), feed.where(last)]:
        part.coalesce(1).write.mode("append").parquet(landing)
        stream = events.event_stream(spark, landing, feed.schema, files_per_batch=1)
        events.stream_keep_late(stream, root, checkpoint).awaitTermination()
    return events.kept_and_late(spark, root, stream.schema)
