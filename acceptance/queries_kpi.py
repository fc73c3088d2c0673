"""Report measures, incremental loads, streams."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from acceptance.frames import frame, frames
from acceptance.registry import query
from tidemark.plans import kpis
from tidemark.session import shared_dir, stage
from tidemark.streaming import events, incremental, scd2


@query("kpi_mom_trend", """
    SELECT year, month, orders, CAST(cents AS DOUBLE) / 100 AS gross_revenue,
      CAST((orders - lag(orders) OVER w) * 100 AS DOUBLE) / lag(orders) OVER w AS orders_change_pct,
      CAST((cents - lag(cents) OVER w) * 100 AS DOUBLE) / nullif(lag(cents) OVER w, 0) AS revenue_change_pct
    FROM {monthly_cents} WINDOW w AS (ORDER BY year, month)""")
def mom_trend(spark, d):
    return kpis.mom_trend(*frames(spark, d, "f_orders", "f_items"))


@query("kpi_day_of_week", """
    SELECT CAST(dayofweek(order_purchase_date) + 1 AS INTEGER) AS weekday, count(*) AS orders,
      CAST(sum(cents) AS DOUBLE) / 100 AS gross_revenue
    FROM {order_cents} GROUP BY 1""")
def day_of_week(spark, d):
    return kpis.day_of_week(*frames(spark, d, "f_orders", "f_items"))


@query("kpi_aov", "SELECT year, month, CAST(cents AS DOUBLE) / (orders * 100.0::DOUBLE) AS average_order_value "
       "FROM {monthly_cents}")
def aov(spark, d):
    return kpis.aov(*frames(spark, d, "f_orders", "f_items"))


@query("kpi_payment_mix", """
    SELECT payment_type, payments, CAST(cents AS DOUBLE) / 100 AS value,
      CAST(payments AS DOUBLE) / CAST(sum(payments) OVER () AS DOUBLE) AS payment_share,
      CAST(cents AS DOUBLE) / CAST(sum(cents) OVER () AS DOUBLE) AS value_share
    FROM (SELECT payment_type, count(*) AS payments, sum(CAST(CAST(payment_value AS DECIMAL(18,2)) * 100 AS BIGINT))
      AS cents FROM {f_payments} GROUP BY payment_type)""")
def payment_mix(spark, d):
    return kpis.payment_mix(frame(spark, d, "f_payments"))


@query("kpi_on_time_rate", """
    SELECT *, CAST(on_time AS DOUBLE) / orders AS on_time_rate, CAST(late AS DOUBLE) / orders AS late_rate,
      CAST(undelivered AS DOUBLE) / orders AS undelivered_rate
    FROM (SELECT count(*) AS orders,
      count(*) FILTER (order_delivered_customer_date <= order_estimated_delivery_date) AS on_time,
      count(*) FILTER (order_delivered_customer_date > order_estimated_delivery_date) AS late,
      count(*) FILTER (order_delivered_customer_date IS NULL) AS undelivered FROM {f_orders})""")
def on_time_rate(spark, d):
    return kpis.on_time_rate(frame(spark, d, "f_orders"))


@query("kpi_delivery_histogram", """
    SELECT CAST(floor(date_diff('day', order_purchase_date, order_delivered_customer_date) / 5.0) * 5 AS INTEGER)
      AS days_from, count(*) AS orders
    FROM {f_orders} WHERE order_delivered_customer_date IS NOT NULL GROUP BY 1""")
def delivery_histogram(spark, d):
    return kpis.delivery_histogram(frame(spark, d, "f_orders"))


STAGES = {
    "approve": ("order_purchase_date", "order_approved_date"),
    "process": ("order_approved_date", "order_delivered_carrier_date"),
    "ship": ("order_delivered_carrier_date", "order_delivered_customer_date"),
}


@query("kpi_stage_bottleneck", " UNION ALL ".join(f"""
    SELECT '{s}' AS stage, count(date_diff('day', {a}, {b})) AS orders, avg(date_diff('day', {a}, {b})) AS avg_days,
      CAST(max(date_diff('day', {a}, {b})) AS INTEGER) AS max_days FROM {{f_orders}}""" for s, (a, b) in STAGES.items()))
def stage_bottleneck(spark, d):
    return kpis.stage_bottleneck(frame(spark, d, "f_orders"))


LATE = "date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date)"


@query("kpi_delivery_by_category", f"""
    SELECT product_category_name, count(*) AS delivered, CAST(sum({LATE}) AS DOUBLE) / count(*) AS avg_delay_days,
      CAST(count(*) FILTER ({LATE} > 0) AS DOUBLE) / count(*) AS late_rate
    FROM {{f_items}} i JOIN {{f_orders}} o ON i.order_id = o.order_id JOIN {{f_products}} p ON i.product_id = p.product_id
    WHERE o.order_delivered_customer_date IS NOT NULL GROUP BY 1""")
def delivery_by_category(spark, d):
    return kpis.delivery_by_category(*frames(spark, d, "f_orders", "f_items", "f_products"))


@query("kpi_delivery_by_state", f"""
    SELECT customer_state, count(*) AS delivered, CAST(sum({LATE}) AS DOUBLE) / count(*) AS avg_delay_days,
      CAST(count(*) FILTER ({LATE} > 0) AS DOUBLE) / count(*) AS late_rate
    FROM {{f_orders}} o JOIN {{f_customers}} c ON o.customer_id = c.customer_id
    WHERE o.order_delivered_customer_date IS NOT NULL GROUP BY 1""")
def delivery_by_state(spark, d):
    return kpis.delivery_by_state(*frames(spark, d, "f_orders", "f_customers"))


@query("kpi_new_vs_repeat", """
    SELECT CAST(year(order_purchase_date) AS INTEGER) AS year, CAST(month(order_purchase_date) AS INTEGER) AS month,
      count(*) AS orders, count(*) FILTER (rn = 1) AS new_orders, count(*) FILTER (rn > 1) AS repeat_orders
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_purchase_date, order_id) AS rn
      FROM {f_orders}) GROUP BY 1, 2""")
def new_vs_repeat(spark, d):
    return kpis.new_vs_repeat(frame(spark, d, "f_orders"))


@query("kpi_segment_revenue", """
    SELECT customer_segment, CAST(cents AS DOUBLE) / 100 AS revenue,
      CAST(cents AS DOUBLE) / CAST(sum(cents) OVER () AS DOUBLE) AS revenue_share
    FROM (SELECT customer_segment, sum(cents) AS cents FROM {order_cents} o
      JOIN {f_customers} c ON o.customer_id = c.customer_id GROUP BY 1)""")
def segment_revenue(spark, d):
    return kpis.segment_revenue(*frames(spark, d, "f_orders", "f_items", "f_customers"), "customer_segment")


@query("kpi_review_distribution", """
    SELECT review_score, count(*) AS reviews,
      CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS review_share
    FROM {f_reviews} GROUP BY review_score""")
def review_distribution(spark, d):
    return kpis.review_distribution(frame(spark, d, "f_reviews"))


@query("kpi_retention", """
    SELECT CAST(year(first) AS INTEGER) AS cohort_year, CAST(month(first) AS INTEGER) AS cohort_month,
      CAST(date_diff('month', first, order_purchase_date) AS INTEGER) AS months_since_first,
      count(DISTINCT customer_id) AS customers
    FROM (SELECT customer_id, order_purchase_date, min(order_purchase_date) OVER (PARTITION BY customer_id) AS first
      FROM {f_orders}) GROUP BY 1, 2, 3""")
def retention(spark, d):
    return kpis.retention(frame(spark, d, "f_orders"))


@query("kpi_top_products", """
    SELECT product_category_name, CAST(rank AS INTEGER) AS rank, product_id, CAST(cents AS DOUBLE) / 100 AS revenue
    FROM (SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY cents DESC, product_id) AS rank
      FROM (SELECT p.product_category_name, i.product_id,
          sum(CAST(CAST(price AS DECIMAL(18,2)) * 100 AS BIGINT)) AS cents
        FROM {f_items} i JOIN {f_products} p ON i.product_id = p.product_id GROUP BY 1, 2))
    WHERE rank <= 10""")
def top_products(spark, d):
    return kpis.top_products(*frames(spark, d, "f_items", "f_products"))


@query("scd2_merge", """
    SELECT customer_id, segment, effective_date AS valid_from,
      lead(effective_date) OVER w AS valid_to, lead(effective_date) OVER w IS NULL AS is_current
    FROM (SELECT *, lag(segment) OVER (PARTITION BY customer_id ORDER BY effective_date) AS before FROM {f_changes})
    WHERE before IS DISTINCT FROM segment
    WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date)""")
def scd2_merge(spark, d):
    return scd2.scd2_merge(frame(spark, d, "f_changes"), ["customer_id"], "effective_date", ["segment"])


# Last type of each user and day by time, then by id: the feed has several events a day.
EVENT_HISTORY = """
    SELECT user_id, event_type, day AS valid_from, lead(day) OVER w AS valid_to, lead(day) OVER w IS NULL AS is_current
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before, row_number() OVER
        (PARTITION BY user_id ORDER BY day) AS n
      FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1))
    WHERE n = 1 OR before IS DISTINCT FROM event_type
    WINDOW w AS (PARTITION BY user_id ORDER BY day)"""


@query("scd2_merge_times", EVENT_HISTORY)
def scd2_merge_times(spark, d):
    return scd2.scd2_merge(frame(spark, d, "events"), ["user_id"], "ts", ["event_type"], sequence=["event_id"])


@query("scd2_update", EVENT_HISTORY)
def scd2_update(spark, d):
    feed, halfway = frame(spark, d, "events"), F.lit("2024-01-16").cast("timestamp_ntz")
    by = (["user_id"], "ts", ["event_type"], ["event_id"])
    history = stage(scd2.scd2_merge(feed.where(F.col("ts") < halfway), *by), "history")
    return scd2.scd2_update(history, feed.where(F.col("ts") >= halfway), *by)


@query("scd2_merge_table", EVENT_HISTORY)
def scd2_merge_table(spark, d):
    """The history stored in buckets, after three loads, of which the last repeats the one before."""
    feed, path = frame(spark, d, "events"), shared_dir(spark, "history")
    halfway = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in [feed.where(halfway), feed.where(~halfway), feed.where(~halfway)]:
        history = scd2.scd2_merge_into(path, part, ["user_id"], "ts", ["event_type"], ["event_id"], buckets=16)
    return history


@query("incremental_load", "SELECT * FROM events")
def incremental_load(spark, d):
    feed = frame(spark, d, "events")
    target, marks = shared_dir(spark, "events"), shared_dir(spark, "marks")
    halfway = feed.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    # The first half, then everything, then everything again: nothing is lost or doubled.
    for delivered in [halfway, feed, feed]:
        loaded = incremental.incremental_load(
            delivered, target, marks, "ts", ["event_id"], lateness=datetime.timedelta(hours=1)
        )
    return loaded


@query("stream_ingest", """
    SELECT CAST(ts AS DATE) AS day, event_type, count(DISTINCT event_id) AS events FROM events
    WHERE CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
    GROUP BY 1, 2""")
def stream_ingest(spark, d):
    schema = frame(spark, d, "events").schema
    target, checkpoint = shared_dir(spark, "daily_counts"), shared_dir(spark, "daily_counts_checkpoint")
    counts = events.daily_counts(events.event_stream(spark, d, schema, pattern="events.parquet"))
    events.stream_ingest(counts, target, checkpoint).awaitTermination()
    return spark.read.schema(counts.schema).parquet(target)
