"""The star schema by loads: each load is landed, and only what it touches is made anew.

Layout below the root: ``silver/<entity>/load_id=N`` has what each load brought, ``gold/keys/<entity>``
the numbers that natural keys have for good, ``gold/dim_<entity>/load_id=N`` the dimension rows
that load N made or changed, and ``gold/fact_sales`` and ``gold/fact_sales_agg`` a folder per month.

A load that broke off is run again under its number: its folders are replaced, numbers that were
given stay, and whole months are made from what is landed, so nothing is lost or counted twice.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import year_month_label
from tidemark.operators.clean import dedupe_by_key
from tidemark.operators.keys import UNKNOWN_KEY, key_map
from tidemark.operators.layout import folder_files, remove_folders, replace_folders
from tidemark.plans import dims, facts
from tidemark.session import side_by_side, stage
from tidemark.sources.tables import few_values, scan_table

LOAD = "load_id"
MONTH = "sales_month"
NO_MONTH = "none"  # the folder of orders without a day
# Entities of which a later load's row replaces the earlier one, by this key.
KEYS = {
    "customers": "customer_id", "products": "product_id", "sellers": "seller_id", "orders": "order_id",
    "category_translation": "product_category_name",
}
PARTS = ["order_items", "order_payments", "order_reviews"]
# What the fact reads of an order.
ORDER_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_date", "order_delivered_customer_date"]
NARROWING = 2  # landed orders for one that lies in a touched month, from which on its parts are sought out first


def _land(feed: DataFrame, root: str, entity: str, load: int) -> DataFrame:
    """Write a load of an entity and read all loads up to now."""
    path = f"{root}/silver/{entity}"
    feed.write.mode("overwrite").parquet(f"{path}/{LOAD}={load}")
    schema = T.StructType([*feed.schema.fields, T.StructField(LOAD, T.IntegerType())])
    return scan_table(feed.sparkSession, path, schema).where(F.col(LOAD) <= load)


def _newest(rows: DataFrame, key: str) -> DataFrame:
    return dedupe_by_key(rows, [key], [F.desc(LOAD)]).drop(LOAD)


def _month(day: str):
    return F.coalesce(year_month_label(F.year(day), F.month(day)), F.lit(NO_MONTH))


def _build(entity: str, rows: DataFrame, translation: DataFrame, number) -> DataFrame:
    if entity == "product":
        return dims.dim_product(rows, translation, number)
    return (dims.dim_customer if entity == "customer" else dims.dim_seller)(rows, number)


def _load_dimension(
    entity: str, rows: DataFrame, translation: DataFrame, mentioned: list[DataFrame], root: str, load: int
) -> tuple[DataFrame, DataFrame]:
    """Number the load's members and those that facts mention, write the load's rows.

    Returns the whole dimension and the map of its numbers. A member that was only mentioned has a
    row of defaults, marked as inferred, until a load brings its own: its number stays.
    """
    spark, natural, sk, path = rows.sparkSession, f"natural_{entity}_key", f"{entity}_sk", f"{root}/gold/dim_{entity}"
    own = rows.select(F.coalesce(f"{entity}_id", F.lit(dims.UNKNOWN)).alias(natural))
    for ids in mentioned:
        own = own.unionByName(ids.select(F.col(f"{entity}_id").alias(natural)).where(F.col(natural).isNotNull()))
    numbers = key_map(own, sk, f"{root}/gold/keys/{entity}")

    def numbered(df: DataFrame, name: str) -> DataFrame:
        return df.join(numbers, natural).select(name, *df.columns)

    built = _build(entity, rows, translation, numbered).withColumn("is_inferred", F.lit(False))
    built.write.mode("overwrite").parquet(f"{path}/{LOAD}={load}")
    stored = T.StructType([*built.schema.fields, T.StructField(LOAD, T.IntegerType())])
    known = _newest(scan_table(spark, path, stored).where(F.col(LOAD) <= load), sk)
    missing = numbers.join(known.select(sk), sk, "left_anti")
    blank = [F.col(natural).alias(f"{entity}_id") if c == f"{entity}_id" else F.lit(None).cast(rows.schema[c].dataType).alias(c)
             for c in rows.columns]
    inferred = _build(entity, missing.select(*blank), translation, numbered)
    empty = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    nobody = _build(entity, empty, translation, lambda df, name: df.select(F.lit(UNKNOWN_KEY).cast("long").alias(name), *df.columns))
    nobody = nobody.withColumn(natural, F.lit(None).cast(nobody.schema[natural].dataType))
    for made in (inferred, nobody):
        known = known.unionByName(made.withColumn("is_inferred", F.lit(True)))
    return known, numbers


def _touched_orders(landed: DataFrame, feeds: dict[str, DataFrame], load: int) -> tuple[list[str], DataFrame]:
    """The months that a load touches, and the newest versions of all orders that lie there now.

    Touched are the months of all versions of the orders that the load mentions. Of the orders only the
    columns that the fact reads are shuffled, and those before them, which decide between versions of one load.
    """
    mentioned = feeds["orders"].select("order_id")
    for name in PARTS:
        mentioned = mentioned.union(feeds[name].select("order_id"))
    last = max(landed.columns.index(c) for c in ORDER_COLUMNS)
    month = _month("order_purchase_date")
    versions = landed.where("order_id IS NOT NULL").select(*landed.columns[:last + 1], LOAD)
    before = versions.where(F.col(LOAD) < load).join(mentioned.distinct(), "order_id", "left_semi")
    months = few_values(versions.where(F.col(LOAD) == load).unionByName(before).select(month.alias(MONTH)))
    here, elsewhere = versions.where(month.isin(months)), versions.where(~month.isin(months))
    moved = elsewhere.join(here.select("order_id"), "order_id", "left_semi")
    return months, stage(_newest(here.unionByName(moved), "order_id").where(month.isin(months)), "touched_orders")


def load_star(spark: SparkSession, feeds: dict[str, DataFrame], root: str, load: int) -> dict[str, DataFrame]:
    """Take one load of cleaned entities into the star schema below ``root``.

    ``feeds`` has all entities of KEYS and PARTS, empty ones too; loads have rising numbers, and the
    last may be run again. Of the entities in KEYS a later row replaces the earlier one of its key,
    and a corrected order may change its month; items, payments and reviews are added to their order
    whenever they come. Returns the tables as they are after the load, to be read until the next one:
    the fact has the keys of its dimensions, and every one of them has a row.

    How it is spread. The months in which the orders that the load mentions lie, or lay before it, are made
    anew from all that was landed of their orders, straight into their folders, and the marts of these
    months are added up from there. Steps that do not build on each other run side by side. Months that the load does not touch are neither made nor written; the
    months' names are collected, and their number grows with time and not with orders.
    """
    landed = dict(zip([*KEYS, *PARTS], side_by_side([partial(_land, feeds[n], root, n, load) for n in [*KEYS, *PARTS]])))
    # From here on the feeds are read as they were landed.
    feeds = {name: rows.where(F.col(LOAD) == load).drop(LOAD) for name, rows in landed.items()}
    translation = _newest(landed["category_translation"], "product_category_name")
    # A new translation changes the products of its category.
    categories = feeds["category_translation"].select("product_category_name").distinct()
    products = _newest(landed["products"], "product_id")
    renamed = products.join(categories, "product_category_name", "left_semi").select(*feeds["products"].columns)
    changed = {
        "customer": _newest(feeds["customers"].withColumn(LOAD, F.lit(load)), "customer_id"),
        "product": renamed.unionByName(products.join(feeds["products"].select("product_id"), "product_id", "left_semi").select(
            *feeds["products"].columns)).distinct(),
        "seller": _newest(feeds["sellers"].withColumn(LOAD, F.lit(load)), "seller_id"),
    }
    items = feeds["order_items"].where("order_id IS NOT NULL")  # those of earlier loads have their numbers
    tables, numbers = {}, {}

    def load_dimension(entity: str, mentioned: DataFrame) -> None:
        tables[f"dim_{entity}"], numbers[f"dim_{entity}"] = _load_dimension(
            entity, changed[entity], translation, [mentioned], root, load)

    (months, orders), *_ = side_by_side([
        lambda: _touched_orders(landed["orders"], feeds, load), *[partial(load_dimension, e, items) for e in ("product", "seller")]])
    load_dimension("customer", orders)
    parts = {name: landed[name].drop(LOAD) for name in PARTS}
    if NARROWING * orders.count() < landed["orders"].count():
        # What the joins below drop anyway: worth a join of its own only where most is dropped.
        parts = {name: rows.join(orders.select("order_id"), "order_id", "left_semi") for name, rows in parts.items()}

    fact, mart = f"{root}/gold/fact_sales", f"{root}/gold/fact_sales_agg"
    rows = facts.fact_sales_star(orders, parts["order_items"], parts["order_payments"], parts["order_reviews"], numbers)
    # A touched month without a new file has no rows any more: its orders lie elsewhere now.
    before = folder_files(spark, fact, MONTH, months)
    made = replace_folders(rows.withColumn(MONTH, _month("purchase_date")), fact, MONTH, [])
    left = folder_files(spark, fact, MONTH, months)
    emptied = [month for month in months if not left[month] - before[month]]
    tables["fact_sales"] = remove_folders(made, fact, MONTH, emptied)
    touched = tables["fact_sales"].where(F.col(MONTH).isin(months))
    monthly = facts.agg_sales_monthly(touched).withColumn(MONTH, F.coalesce("year_month", F.lit(NO_MONTH)))
    tables["fact_sales_agg"] = replace_folders(monthly, mart, MONTH, emptied)
    return tables
