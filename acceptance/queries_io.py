"""Sources, sinks, file layout, snapshots."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from acceptance.frames import frame, frames
from acceptance.queries_model import SALES_KEY, monthly_sales, sales_rows
from acceptance.registry import query
from tidemark.operators import clean, layout
from tidemark.plans import facts
from tidemark.session import SHUFFLE_BYTES_PER_TASK, shared_dir, stage
from tidemark.sources import csv, lookup, manifest, tables

PAYMENT_TEXT = ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]


@query("scan_table", "SELECT * FROM {sales}")
def scan_table(spark, d):
    rows = sales_rows(spark, d)
    path = shared_dir(spark, "fact_sales")
    rows.write.parquet(path)
    return tables.scan_table(spark, path, rows.schema)


@query("scan_csv_positional", "SELECT * FROM {raw_order_payments}")
def scan_csv_positional(spark, d):
    path = shared_dir(spark, "payments_csv")
    csv.write_csv_quoted(frame(spark, d, "raw_order_payments"), path, header=False)
    return csv.scan_csv_positional(spark, path, PAYMENT_TEXT)


@query("scan_csv_infer", "SELECT * FROM {f_payments}")
def scan_csv_infer(spark, d):
    path = shared_dir(spark, "payments_csv")
    frame(spark, d, "f_payments").write.option("header", True).csv(path)
    # An id column is inferred as int or long, by its largest value.
    return csv.scan_csv_infer(spark, path).withColumn("order_id", F.col("order_id").cast("long"))


REVIEW_TEXT = [
    "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date",
    "review_answer_timestamp",
]


@query("scan_csv_quoted", "SELECT * FROM {raw_order_reviews}")
def scan_csv_quoted(spark, d):
    path = shared_dir(spark, "reviews_csv")
    # Columns on file in another order: they are found by header.
    csv.write_csv_quoted(frame(spark, d, "raw_order_reviews").select(*reversed(REVIEW_TEXT)), path)
    return csv.scan_csv_quoted(spark, path, REVIEW_TEXT, multi_line=True)


@query("write_csv_quoted", "SELECT * FROM documents")
def write_csv_quoted(spark, d):
    documents = frame(spark, d, "documents")
    path = shared_dir(spark, "documents_csv")
    csv.write_csv_quoted(documents, path)
    back = csv.scan_csv_quoted(spark, path, documents.columns, multi_line=True)
    return clean.cast_columns(back, {"doc_id": "long", "n_chars": "long"})


@query("drop_header_row", "SELECT * FROM {raw_order_payments}")
def drop_header_row(spark, d):
    path = shared_dir(spark, "payments_csv")
    csv.write_csv_quoted(frame(spark, d, "raw_order_payments"), path)
    # Read as if without header: every file's header comes as a row.
    return clean.drop_header_row(csv.scan_csv_positional(spark, path, PAYMENT_TEXT))


# Payments as lines of text: some with a field too many, one too few, or a quote that does not close.
PAYMENT_LINES = """
    SELECT *, CASE WHEN n % 11 = 3 THEN good || ',EXTRA' WHEN n % 13 = 5 THEN split_part(good, ',', 1) || ',' || split_part(good, ',', 2)
        WHEN n % 17 = 7 THEN good || ',"open' ELSE good END AS line,
      CASE WHEN n % 11 = 3 OR n % 13 = 5 THEN 'field count' WHEN n % 17 = 7 THEN 'open quote' END AS reason
    FROM (SELECT *, CAST(order_id AS BIGINT) AS n, concat_ws(',', order_id, payment_sequential, coalesce(payment_type, ''),
      payment_installments, payment_value) AS good FROM {raw_order_payments}) p"""


@query("reject_malformed_lines", f"""
    SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value, CAST(NULL AS VARCHAR) AS line, 'accepted' AS outcome
    FROM ({PAYMENT_LINES}) WHERE reason IS NULL
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, line, reason FROM ({PAYMENT_LINES}) WHERE reason IS NOT NULL""")
def reject_malformed_lines(spark, d):
    path = shared_dir(spark, "payment_lines")
    lines = spark.sql(PAYMENT_LINES, raw_order_payments=frame(spark, d, "raw_order_payments")).select("line")
    header = spark.createDataFrame([(",".join(PAYMENT_TEXT),)], "line string")
    # A header in each of two files.
    header.unionByName(lines.where("length(line) % 2 = 0")).coalesce(1).write.text(path)
    header.unionByName(lines.where("length(line) % 2 = 1")).coalesce(1).write.mode("append").text(path)
    good, bad = csv.scan_csv_checked(spark, path, PAYMENT_TEXT)
    return good.withColumns({"line": F.lit(None).cast("string"), "outcome": F.lit("accepted")}).unionByName(
        bad.withColumnRenamed("reason", "outcome"), allowMissingColumns=True)


@query("scan_lookup", "SELECT * FROM {f_category}")
def scan_lookup(spark, d):
    path = shared_dir(spark, "category_json")
    exported = frame(spark, d, "f_category").withColumn("_id", F.md5("product_category_name"))
    exported.write.json(path)
    return lookup.scan_lookup(spark, path, ["product_category_name", "product_category_name_english"], "json")


@query("manifest_ingest", """
    SELECT 'order_payments.csv' AS file_name, order_id, payment_value AS value FROM {raw_order_payments}
    UNION ALL SELECT 'order_reviews.csv', order_id, review_comment_message FROM {raw_order_reviews}""")
def manifest_ingest(spark, d):
    landing, bronze, listing = (shared_dir(spark, n) for n in ["landing", "bronze", "manifest"])
    entries = []
    for entity in ["order_payments", "order_reviews"]:
        csv.write_csv_quoted(frame(spark, d, f"raw_{entity}"), f"{landing}/in/{entity}")
        entries.append({"csv_relative_url": f"in/{entity}", "file_name": f"{entity}.csv"})
    text = json.dumps(entries, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(listing)
    paths = manifest.manifest_ingest(spark, listing, landing, bronze, multi_line={"order_reviews.csv"})
    payments = csv.scan_csv_quoted(spark, paths["order_payments.csv"], ["order_id", "payment_value"])
    reviews = csv.scan_csv_quoted(
        spark, paths["order_reviews.csv"], ["order_id", "review_comment_message"], multi_line=True
    )
    return payments.select(
        F.lit("order_payments.csv").alias("file_name"), "order_id", F.col("payment_value").alias("value")
    ).unionByName(reviews.select(
        F.lit("order_reviews.csv").alias("file_name"), "order_id", F.col("review_comment_message").alias("value")
    ))


_PAYMENT_FILES = """
    SELECT *, CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN 'third.csv' ELSE 'others.csv' END AS file_name FROM {raw_order_payments}"""


@query("manifest_ingest_entities", f"""
    SELECT 'order_payments' AS entity, * FROM ({_PAYMENT_FILES})
    UNION ALL BY NAME SELECT 'order_reviews' AS entity, 'reviews.csv' AS file_name, * FROM {{raw_order_reviews}}""")
def manifest_ingest_entities(spark, d):
    """Two files of one entity and one of another, every column."""
    landing, bronze, listing = (shared_dir(spark, n) for n in ["landing", "bronze", "manifest"])
    payments = spark.sql(_PAYMENT_FILES, raw_order_payments=frame(spark, d, "raw_order_payments"))
    files = {name: payments.where(F.col("file_name") == name).drop("file_name") for name in ["third.csv", "others.csv"]}
    files["reviews.csv"] = frame(spark, d, "raw_order_reviews")
    for name, rows in files.items():
        csv.write_csv_quoted(rows, f"{landing}/in/{name}")
    text = json.dumps([{"csv_relative_url": f"in/{name}", "file_name": name} for name in files])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(listing)
    entities = {"third.csv": "order_payments", "others.csv": "order_payments", "reviews.csv": "order_reviews"}
    paths = manifest.manifest_ingest_entities(spark, listing, landing, bronze, entities, {"order_reviews"})
    found = []
    for entity, columns in [("order_payments", PAYMENT_TEXT), ("order_reviews", REVIEW_TEXT)]:
        for path in paths[entity]:
            rows = csv.scan_csv_quoted(spark, path, columns, multi_line=entity == "order_reviews")
            found.append(rows.withColumns({"entity": F.lit(entity), "file_name": F.lit(path.rsplit("=")[-1])}))
    return found[0].unionByName(found[1], allowMissingColumns=True).unionByName(found[2], allowMissingColumns=True)


def _monthly_on_disk(spark, d) -> str:
    path = shared_dir(spark, "fact_sales_agg")
    layout.write_partitioned(monthly_sales(spark, d), path, "year_month")
    return path


@query("scan_partition_folder", "SELECT * FROM {monthly} WHERE year_month = '1997-7'")
def scan_partition_folder(spark, d):
    return tables.scan_partition_folder(spark, _monthly_on_disk(spark, d), {"year_month": "1997-7"})


@query("write_partition_month", "SELECT * FROM {monthly}")
def write_partition_month(spark, d):
    path = shared_dir(spark, "fact_sales_agg")
    return layout.write_partitioned(monthly_sales(spark, d), path, "year_month")


@query("write_overwrite", "SELECT * FROM {sales}")
def write_overwrite(spark, d):
    path = shared_dir(spark, "fact_sales")
    rows = sales_rows(spark, d)
    first = layout.write_overwrite(rows.select("order_id"), path)
    assert first.columns == ["order_id"]
    return layout.write_overwrite(rows, path)


@query("write_parquet_both_layers", """
    SELECT 'silver' AS layer, * FROM {f_customers} UNION ALL SELECT 'gold', * FROM {f_customers}""")
def write_parquet_both_layers(spark, d):
    first, second = shared_dir(spark, "silver"), shared_dir(spark, "gold")
    customers, sellers = frames(spark, d, "f_customers", "f_sellers")
    gold = layout.write_layers({"customers": customers, "sellers": sellers}, first, second)
    silver = tables.scan_table(spark, f"{first}/customers")
    return silver.select(F.lit("silver").alias("layer"), "*").unionByName(
        gold["customers"].select(F.lit("gold").alias("layer"), "*")
    )


@query("write_partition_date", "SELECT * FROM {sales}")
def write_partition_date(spark, d):
    return layout.write_partitioned(sales_rows(spark, d), shared_dir(spark, "fact_by_date"), "purchase_date")


@query("write_partition_payment", "SELECT * FROM {sales}")
def write_partition_payment(spark, d):
    landed = stage(sales_rows(spark, d), "fact_sales")
    return layout.write_partitioned(landed, shared_dir(spark, "fact_by_payment"), "payment_type")


@query("cluster_layout", "SELECT * FROM {sales}")
def cluster_layout(spark, d):
    source, target = shared_dir(spark, "fact_sales"), shared_dir(spark, "clustered")
    sales_rows(spark, d).write.parquet(source)
    return layout.cluster_layout(spark, source, target, "customer_sk")


@query("cluster_layout_columns", "SELECT * FROM {sales}")
def cluster_layout_columns(spark, d):
    source, target = shared_dir(spark, "fact_sales"), shared_dir(spark, "clustered")
    sales_rows(spark, d).write.parquet(source)
    return layout.cluster_layout_columns(spark, source, target, ["customer_sk", "purchase_date", "payment_type"])


@query("merge_schema_versions", """
    SELECT CAST(payment_installments AS BIGINT) AS payment_installments, payment_value, payment_type,
      CASE WHEN order_id % 3 > 0 THEN payment_sequential END AS payment_sequential, CASE WHEN order_id % 3 = 2 THEN order_id END AS order_id
    FROM {f_payments}""")
def merge_schema_versions(spark, d):
    """Three versions of a table: int and float columns, then a column more, then wider ones and another."""
    payments, key = frame(spark, d, "f_payments"), F.col("order_id") % 3
    root = shared_dir(spark, "versions")
    columns = ["payment_installments", "payment_value", "payment_type", "payment_sequential", "order_id"]
    payments.where(key == 0).select(*columns[:3]).write.parquet(f"{root}/1")
    payments.where(key == 1).select(*columns[:4]).write.parquet(f"{root}/2")
    payments.where(key == 2).select(F.col(columns[0]).cast("long").alias(columns[0]), *columns[1:]).write.parquet(f"{root}/3")
    return tables.merge_versions(spark, [f"{root}/{i}" for i in (1, 2, 3)])


@query("compact_files", "SELECT * FROM {monthly}")
def compact_files(spark, d):
    scattered, compact = shared_dir(spark, "scattered"), shared_dir(spark, "compact")
    # Four files a folder, more where a task would write more than its share.
    files = max(4, -(-tables.table_bytes(spark, d) // SHUFFLE_BYTES_PER_TASK))
    monthly_sales(spark, d).repartition(files).write.partitionBy("year_month").parquet(scattered)
    return layout.compact_files(spark, scattered, compact, "year_month")


@query("snapshot_table", SALES_KEY)
def snapshot_table(spark, d):
    fact = facts.fact_sales(*frames(spark, d, "f_orders", "f_items", "f_payments", "f_reviews"))
    return layout.snapshot_table(fact, "fact_sales_table", shared_dir(spark, "fact_sales_table"))


@query("snapshot_agg", """
    SELECT year_month, CAST(sum(CAST(total_sales AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM {monthly} GROUP BY year_month""")
def snapshot_agg(spark, d):
    monthly = tables.scan_table(spark, _monthly_on_disk(spark, d))
    return layout.snapshot_table(
        facts.agg_revenue_by_month(monthly), "fact_sales_agg_table", shared_dir(spark, "fact_sales_agg_table")
    )
