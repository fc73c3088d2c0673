"""Measures behind the sales, delivery and customer reports.

All start from orders or items, never from the fanned-out fact. Rows are reduced per order,
customer or product before they meet another table, so that a hot key is combined within the
tasks that read it. Windows run only over such reduced rows: months, types, segments.

Money is added up in cents; ratios are plain divisions of exact totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import amount, cents

PURCHASE = "order_purchase_date"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"


def _count() -> Column:
    return F.count(F.lit(1))


def _share(part: Column) -> Column:
    """Share of the whole; over grouped rows only."""
    return part / F.sum(part).over(Window.partitionBy())


def _days_late() -> Column:
    return F.datediff(DELIVERED, ESTIMATED)


def order_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order with the cents of its items; orders without items have none."""
    per_order = items.groupBy("order_id").agg(F.sum(cents(F.col("price"))).alias("cents"))
    return orders.select("order_id", "customer_id", "order_purchase_date").join(
        per_order, "order_id", "left"
    ).withColumn("cents", F.coalesce("cents", F.lit(0)))


def _monthly(orders: DataFrame, items: DataFrame) -> DataFrame:
    return order_revenue(orders, items).groupBy(
        F.year(PURCHASE).alias("year"), F.month(PURCHASE).alias("month")
    ).agg(_count().alias("orders"), F.sum("cents").alias("cents"))


def mom_trend(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders and revenue per month with the change from the month before, in percent."""
    previous = Window.orderBy("year", "month")

    def change(c: str) -> Column:
        before = F.lag(c).over(previous)
        return F.try_divide((F.col(c) - before) * 100.0, before)

    return _monthly(orders, items).select(
        "year", "month", "orders",
        amount(F.col("cents")).alias("gross_revenue"),
        change("orders").alias("orders_change_pct"),
        change("cents").alias("revenue_change_pct"),
    )


def day_of_week(orders: DataFrame, items: DataFrame) -> DataFrame:
    return order_revenue(orders, items).groupBy(F.dayofweek(PURCHASE).alias("weekday")).agg(
        _count().alias("orders"), amount(F.sum("cents")).alias("gross_revenue")
    )


def aov(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Average order value per month."""
    return _monthly(orders, items).select(
        "year", "month", (F.col("cents") / (F.col("orders") * 100.0)).alias("average_order_value")
    )


def payment_mix(payments: DataFrame) -> DataFrame:
    per_type = payments.groupBy("payment_type").agg(
        _count().alias("payments"), F.sum(cents(F.col("payment_value"))).alias("cents")
    )
    return per_type.select(
        "payment_type", "payments", amount(F.col("cents")).alias("value"),
        _share(F.col("payments")).alias("payment_share"), _share(F.col("cents")).alias("value_share"),
    )


def on_time_rate(orders: DataFrame) -> DataFrame:
    counts = orders.agg(
        _count().alias("orders"),
        F.count_if(F.col(DELIVERED) <= F.col(ESTIMATED)).alias("on_time"),
        F.count_if(F.col(DELIVERED) > F.col(ESTIMATED)).alias("late"),
        F.count_if(F.col(DELIVERED).isNull()).alias("undelivered"),
    )
    rates = [
        F.try_divide(F.col(c), F.col("orders")).alias(f"{c}_rate") for c in ["on_time", "late", "undelivered"]
    ]
    return counts.select("*", *rates)


def delivery_histogram(orders: DataFrame, bucket_days: int = 5) -> DataFrame:
    """Delivered orders per bucket of days from purchase to delivery."""
    days = F.datediff(DELIVERED, PURCHASE)
    bucket = (F.floor(days / bucket_days) * bucket_days).cast("int").alias("days_from")
    return orders.where(F.col(DELIVERED).isNotNull()).groupBy(bucket).agg(_count().alias("orders"))


def stage_bottleneck(orders: DataFrame) -> DataFrame:
    """Average and longest days per stage, for orders that passed it."""
    stages = {
        "approve": (PURCHASE, "order_approved_date"),
        "process": ("order_approved_date", "order_delivered_carrier_date"),
        "ship": ("order_delivered_carrier_date", DELIVERED),
    }
    rows = []
    for stage, (begin, end) in stages.items():
        days = F.datediff(F.col(end), F.col(begin))
        rows.append(F.struct(
            F.lit(stage).alias("stage"), F.count(days).alias("orders"), F.avg(days).alias("avg_days"),
            F.max(days).alias("max_days"),
        ))
    return orders.agg(F.array(*rows).alias("stages")).select(F.inline("stages"))


def _delivery_totals() -> list[Column]:
    return [
        F.count(_days_late()).alias("delivered"),
        F.sum(_days_late()).alias("days_late"),
        F.count_if(_days_late() > 0).alias("late"),
    ]


def _delivery_rates(totals: DataFrame, by: str) -> DataFrame:
    return totals.groupBy(by).agg(
        F.sum("delivered").alias("delivered"), F.sum("days_late").alias("days_late"), F.sum("late").alias("late")
    ).select(
        by, "delivered",
        F.try_divide(F.col("days_late"), F.col("delivered")).alias("avg_delay_days"),
        F.try_divide(F.col("late"), F.col("delivered")).alias("late_rate"),
    )


def delivery_by_category(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Delay of delivered items per product category."""
    dates = orders.where(F.col(DELIVERED).isNotNull()).select(
        "order_id", "order_delivered_customer_date", "order_estimated_delivery_date"
    )
    per_product = items.select("order_id", "product_id").join(dates, "order_id").groupBy("product_id").agg(
        *_delivery_totals()
    )
    totals = per_product.join(products.select("product_id", "product_category_name"), "product_id")
    return _delivery_rates(totals, "product_category_name")


def delivery_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Delay of delivered orders per state of the customer."""
    per_customer = orders.where(F.col(DELIVERED).isNotNull()).groupBy("customer_id").agg(*_delivery_totals())
    totals = per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
    return _delivery_rates(totals, "customer_state")


def new_vs_repeat(orders: DataFrame) -> DataFrame:
    """Per month: orders that are a customer's first, orders that come later.

    No order is ranked among its customer's orders: the firsts of a month are the customers
    whose first month it is, the rest of its orders are repeats.
    """
    per_customer = orders.groupBy("customer_id").agg(F.min(PURCHASE).alias(PURCHASE))
    month = [F.year(PURCHASE).alias("year"), F.month(PURCHASE).alias("month")]
    firsts = per_customer.groupBy(*month).agg(_count().alias("new_orders"))
    return orders.groupBy(*month).agg(_count().alias("orders")).join(firsts, ["year", "month"], "left").select(
        "year", "month", "orders",
        F.coalesce("new_orders", F.lit(0)).alias("new_orders"),
        (F.col("orders") - F.coalesce("new_orders", F.lit(0))).alias("repeat_orders"),
    )


def segment_revenue(orders: DataFrame, items: DataFrame, customers: DataFrame, segment: str) -> DataFrame:
    per_customer = order_revenue(orders, items).groupBy("customer_id").agg(F.sum("cents").alias("cents"))
    per_segment = per_customer.join(customers.select("customer_id", segment), "customer_id").groupBy(segment).agg(
        F.sum("cents").alias("cents")
    )
    return per_segment.select(
        segment, amount(F.col("cents")).alias("revenue"), _share(F.col("cents")).alias("revenue_share")
    )


def review_distribution(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("review_score").agg(_count().alias("reviews")).select(
        "review_score", "reviews", _share(F.col("reviews")).alias("review_share")
    )


def retention(orders: DataFrame) -> DataFrame:
    """Customers by month of their first order, active so many months later.

    A customer's rows are reduced to the set of active months, which the calendar bounds.
    """
    month_no = F.year(PURCHASE) * 12 + F.month(PURCHASE) - 1
    active = orders.groupBy("customer_id").agg(F.collect_set(month_no).alias("months")).select(
        F.array_min("months").alias("first"), F.explode("months").alias("month_no")
    )
    return active.groupBy("first", (F.col("month_no") - F.col("first")).alias("months_since_first")).agg(
        _count().alias("customers")
    ).select(
        F.floor(F.col("first") / 12).cast("int").alias("cohort_year"),
        (F.col("first") % 12 + 1).alias("cohort_month"),
        "months_since_first", "customers",
    )


def top_products(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products of highest revenue per category; ties go to the lower id.

    Each task keeps its best ``k`` per category before the shuffle.
    """
    per_product = items.groupBy("product_id").agg(F.sum(cents(F.col("price"))).alias("cents"))
    best = Window.partitionBy("product_category_name").orderBy(F.desc("cents"), "product_id")
    return (
        per_product.join(products.select("product_id", "product_category_name"), "product_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("product_category_name", "rank", "product_id", amount(F.col("cents")).alias("revenue"))
    )
