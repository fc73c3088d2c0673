"""The Gold layer as a whole: build, write, publish as SQL views."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.keys import surrogate_key
from tidemark.operators.layout import cluster_layout, compact_files, write_overwrite, write_partitioned
from tidemark.plans import dims, facts
from tidemark.session import side_by_side
from tidemark.sources.tables import scan_table

# The tables of the star schema, and those of the older wide layout. The last two of the
# star schema are added here: the fact with the keys of its dimensions, and what they lack.
STAR_TABLES = [
    "dim_customer", "dim_geolocation", "dim_order_items", "dim_order_payments", "dim_order_reviews", "dim_orders",
    "dim_product", "dim_seller", "fact_sales", "fact_sales_agg", "fact_sales_partitioned",
    "fact_order_payments_partitioned", "bridge_order_items",
    "fact_sales_star", "star_orphans",
]
WIDE_TABLES = [
    "customers", "products", "sellers", "geolocation", "reviews", "payments", "items", "fact_orders",
]


def dimension_builders(silver: dict[str, DataFrame], stored: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """What builds each dimension; ``stored`` says that the cleaned tables are files."""
    number = partial(surrogate_key, stored=stored)
    return {
        "dim_customer": lambda: dims.dim_customer(silver["customers"], number),
        "dim_geolocation": lambda: dims.dim_geolocation(silver["geolocation"]),
        "dim_order_items": lambda: dims.dim_order_items(silver["order_items"], number),
        "dim_order_payments": lambda: dims.dim_order_payments(silver["order_payments"], number),
        "dim_order_reviews": lambda: dims.dim_order_reviews(silver["order_reviews"], number),
        "dim_orders": lambda: dims.dim_orders(silver["orders"], number),
        "dim_product": lambda: dims.dim_product(silver["products"], silver["category_translation"]),
        "dim_seller": lambda: dims.dim_seller(silver["sellers"], number),
    }


def build_dimensions(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build() for name, build in dimension_builders(silver).items()}


def write_gold(silver: dict[str, DataFrame], root: str, stored: bool = False) -> dict[str, DataFrame]:
    """Write the tables below ``root``. The facts that build on others read their files.

    ``stored`` says that the cleaned tables are read from files that stay as they are, so that rows to be
    numbered need no copy. Entities are joined once, for the star; the numbered fact takes its rows over.
    Tables that do not build on each other are made side by side.
    """
    def write(name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        return lambda: write_overwrite(build(), f"{root}/{name}")

    builders = dimension_builders(silver, stored)
    tables = dict(zip(builders, side_by_side([write(*made) for made in builders.items()])))
    sources = [silver[n] for n in ["orders", "order_items", "order_payments", "order_reviews"]]
    tables["fact_sales_star"], tables["star_orphans"] = side_by_side([
        write("fact_sales_star", lambda: facts.fact_sales_star(*sources, tables)),
        write("star_orphans", lambda: facts.star_orphans(*sources[:2], tables)),
    ])
    fact = write_overwrite(facts.fact_sales(*sources, star=tables["fact_sales_star"]), f"{root}/fact_sales")
    tables["fact_sales"] = fact

    # Rows of one product or order side by side take less room.
    def partitioned(name: str, build: Callable[[], DataFrame], by: str, near: str) -> Callable[[], DataFrame]:
        return lambda: write_partitioned(build(), f"{root}/{name}", by, near)

    of_fact = {
        "fact_sales_partitioned": partitioned("fact_sales_partitioned", lambda: fact, "purchase_date", "order_id"),
        "fact_sales_agg": partitioned(
            "fact_sales_agg", lambda: facts.fact_sales_agg(facts.agg_sales_monthly(fact)), "year_month", "product_sk"),
        "fact_order_payments_partitioned": partitioned(
            "fact_order_payments_partitioned", lambda: fact, "payment_type", "order_id"),
        "bridge_order_items": write("bridge_order_items", lambda: facts.bridge_order_items(fact)),
    }
    return {**tables, **dict(zip(of_fact, side_by_side([*of_fact.values()])))}


def write_wide(entities: dict[str, DataFrame], fact_orders: DataFrame, root: str) -> dict[str, DataFrame]:
    """Write the tables of the wide layout below ``root``; ``entities`` by the names of WIDE_TABLES."""
    frames = {**entities, "fact_orders": fact_orders}
    return dict(zip(WIDE_TABLES, side_by_side(
        [partial(write_overwrite, frames[name], f"{root}/{name}") for name in WIDE_TABLES])))


def relayout(spark: SparkSession, root: str, target: str, schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Lay out the two tables that are read by range, in new folders below ``target``.

    Without its schema, as ``write_gold`` returns it with the table, days stay the text of their folders.
    """
    schemas = schemas or {}
    return {
        "dim_customer": cluster_layout(spark, f"{root}/dim_customer", f"{target}/dim_customer", "customer_city",
                                       schema=schemas.get("dim_customer")),
        "fact_sales_partitioned": compact_files(
            spark, f"{root}/fact_sales_partitioned", f"{target}/fact_sales_partitioned", "purchase_date", "fact_sales_sk",
            schemas.get("fact_sales_partitioned"),
        ),
    }


def publish_views(
    spark: SparkSession, root: str, names: list[str], prefix: str = "gold_", schemas: dict[str, T.StructType] | None = None
) -> list[str]:
    """One SQL view per table folder below ``root``; partition columns come from the path.

    Their types are those of ``schemas``, by table; else Spark guesses them from the folder names.
    """
    for name in names:
        scan_table(spark, f"{root}/{name}", (schemas or {}).get(name)).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in names]
