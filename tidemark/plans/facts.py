"""Sales facts. Two grains are kept apart.

``fact_sales`` has a row per item, payment and review of an order, as its readers expect:
sums of ``sales_amount`` over it count an item once per payment and review. The measures in
``plans.kpis`` start from items or orders instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import year_month_label
from tidemark.functions.money import amount, cents, total
from tidemark.functions.rules import review_sentiment
from tidemark.operators.clean import fill_nulls
from tidemark.operators.joins import orders_with_items, with_payments_and_reviews
from tidemark.operators.keys import orphan_keys, surrogate_key, surrogate_key_lookup

# The columns of the fact and the day that stands for no delivery.
NO_DELIVERY = "1900-01-01"


def sales_rows(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, missing_review: str = "Negative",
    keyed: bool = False, more_of_orders: list[str] | None = None, more_of_items: list[str] | None = None,
) -> DataFrame:
    """The fact without its key. ``payment_amount`` stays null where nothing was paid.

    The natural ids stand in for the dimensions' keys, unless orders and items are ``keyed``:
    then these are taken over, and the ids keep their names. More columns of both come last.
    """
    more_of_orders, more_of_items = more_of_orders or [], more_of_items or []
    of_orders, of_items = ["customer_id"], ["product_id", "seller_id"]
    ids = [F.col(c).alias(c.replace("_id", "_sk")) for c in of_orders + of_items]
    if keyed:
        of_orders, of_items = [*of_orders, "customer_sk"], [*of_items, "product_sk", "seller_sk"]
        ids = [F.col(c) for c in of_orders + of_items]
    lines = orders_with_items(
        orders.select(
            "order_id", *of_orders, "order_status", "order_purchase_date", "order_delivered_customer_date",
            *more_of_orders,
        ),
        items.select("order_id", *of_items, "price", "freight_value", *more_of_items),
    )
    rows = with_payments_and_reviews(
        lines,
        payments.select("order_id", "payment_value", "payment_type"),
        reviews.select("order_id", F.col("review_score").cast("int").alias("review_score")),
    ).select(
        "order_id",
        *ids,
        "order_status",
        F.col("order_purchase_date").alias("purchase_date"),
        F.coalesce("order_delivered_customer_date", F.lit(NO_DELIVERY).cast("date")).alias("delivery_date"),
        F.col("price").alias("sales_amount"),
        F.col("freight_value").alias("shipping_cost"),
        F.col("payment_value").alias("payment_amount"),
        "payment_type",
        "review_score",
        review_sentiment(F.col("review_score"), missing_review).alias("review_sentiment"),
        *more_of_orders,
        *more_of_items,
    )
    return fill_nulls(rows, {"review_score": 0, "payment_type": "Unknown"})


def fact_sales(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, missing_review: str = "Negative",
    star: DataFrame | None = None,
) -> DataFrame:
    """The numbered rows. ``star`` is the stored ``fact_sales_star`` of the same entities, whose rows are
    these: with it they are read from there and not joined again."""
    if star is None:
        return surrogate_key(sales_rows(orders, items, payments, reviews, missing_review), "fact_sales_sk")
    ids = {"customer_id": "customer_sk", "product_id": "product_sk", "seller_id": "seller_sk"}
    rows = star.drop(*ids.values()).withColumnsRenamed(ids)
    return surrogate_key(rows, "fact_sales_sk", stored=True)


def _with_key(df: DataFrame, dim: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    copied = df.withColumn(f"{entity}_sk", F.col(f"{entity}_id"))
    known = dim.select(
        F.col(f"natural_{entity}_key").alias("_natural"), F.col(f"{entity}_sk").alias("_dim_sk"), *columns
    )
    return surrogate_key_lookup(copied, known, f"{entity}_sk", "_natural", "_dim_sk", f"{entity}_sk", columns)


def fact_sales_star(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, dimensions: dict[str, DataFrame],
    missing_review: str = "Negative", columns: dict[str, list[str]] | None = None,
) -> DataFrame:
    """The rows of ``fact_sales`` with the keys of its dimensions, -1 where one lacks the id.

    ``columns`` names columns of the dimensions that the rows have as well, last, by dimension; null
    where the key is -1. Keys and these are looked up for orders and items, before payments and reviews
    repeat them.
    """
    of = {entity: (columns or {}).get(f"dim_{entity}", []) for entity in ["customer", "product", "seller"]}
    by_product = _with_key(items, dimensions["dim_product"], "product", of["product"])
    items_keyed = _with_key(by_product, dimensions["dim_seller"], "seller", of["seller"])
    orders_keyed = _with_key(orders, dimensions["dim_customer"], "customer", of["customer"])
    return sales_rows(
        orders_keyed, items_keyed, payments, reviews, missing_review, keyed=True,
        more_of_orders=of["customer"], more_of_items=of["product"] + of["seller"],
    )


def star_orphans(orders: DataFrame, items: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """dimension, orphan, source_rows: ids of orders or items that their dimension lacks."""
    found = [
        orphan_keys(df, dimensions[f"dim_{entity}"], f"{entity}_id", f"natural_{entity}_key").select(
            F.lit(entity).alias("dimension"), F.col(f"{entity}_id").cast("string").alias("orphan"),
            F.col("fact_rows").alias("source_rows"),
        ) for df, entity in [(orders, "customer"), (items, "product"), (items, "seller")]
    ]
    return found[0].union(found[1]).union(found[2])


def sales_monthly(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """The monthly sums of ``agg_sales_monthly``, straight from the entities.

    The fan-out is counted, not built: a line counts once per payment and review of its
    order, so payments and reviews are reduced to one row per order before they are joined.
    """
    paid = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("_payments"))
    reviewed = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_reviews"), F.sum("review_score").alias("_scores")
    )
    payments_of, reviews_of = F.coalesce("_payments", F.lit(1)), F.coalesce("_reviews", F.lit(1))
    counted = orders.join(paid, "order_id", "left").join(reviewed, "order_id", "left").select(
        "order_id",
        F.year("order_purchase_date").alias("year"),
        F.month("order_purchase_date").alias("month"),
        (payments_of * reviews_of).alias("_lines"),
        (payments_of * F.coalesce("_scores", F.lit(0))).alias("_scores"),
    )
    lines = orders_with_items(counted, items.select("order_id", "product_id", "seller_id", "price", "freight_value"))
    return lines.groupBy(
        "year", "month", F.col("product_id").alias("product_sk"), F.col("seller_id").alias("seller_sk")
    ).agg(
        amount(F.sum(cents(F.col("price")) * F.col("_lines"))).alias("total_sales"),
        amount(F.sum(cents(F.col("freight_value")) * F.col("_lines"))).alias("total_shipping_cost"),
        (F.sum("_scores") / F.sum("_lines")).alias("avg_review_score"),
        F.sum("_lines").alias("total_orders"),
    ).withColumn("year_month", year_month_label(F.col("year"), F.col("month")))


def agg_sales_monthly(sales: DataFrame) -> DataFrame:
    """Monthly sums per product and seller. ``total_orders`` counts fact rows."""
    day = F.col("purchase_date")
    return sales.groupBy(
        F.year(day).alias("year"), F.month(day).alias("month"), "product_sk", "seller_sk"
    ).agg(
        total(F.col("sales_amount")).alias("total_sales"),
        total(F.col("shipping_cost")).alias("total_shipping_cost"),
        F.avg("review_score").alias("avg_review_score"),
        F.count(F.lit(1)).alias("total_orders"),
    ).withColumn("year_month", year_month_label(F.col("year"), F.col("month")))


def fact_sales_agg(monthly: DataFrame) -> DataFrame:
    return surrogate_key(monthly, "fact_sales_agg_sk", key=["year", "month", "product_sk", "seller_sk"])


def agg_revenue_by_month(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("year_month").agg(total(F.col("total_sales")).alias("total_revenue"))


def bridge_order_items(fact: DataFrame) -> DataFrame:
    """Links fact rows to products, one row each.

    Its own key is the fact's number: already dense and unique at this grain, so no second
    numbering is needed.
    """
    return fact.select(
        "fact_sales_sk",
        "product_sk",
        "order_status",
        F.col("sales_amount").alias("total_price"),
        F.col("fact_sales_sk").alias("bridge_order_items_sk"),
    )
