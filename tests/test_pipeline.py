"""From landed CSV files to views, with the faults real files have."""

from __future__ import annotations

import glob
import json

import pytest

from tidemark.plans import gold, pipeline

LANDED = {
    "customers": 'customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n'
                 'c1,u1,01037,sao paulo,SP\nc2,u1,x,,SP\n',
    "geolocation": 'geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n'
                   '1037,-23.54,-46.63,sao paulo,SP\n1037,-23.54,-46.63,são paulo,SP\n',
    "order_items": 'order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n'
                   'o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\no1,2,p1,s1,2017-09-19 09:45:35,58.90,13.29\n'
                   'o2,1,p2,s1,,10.00,1.00\n',
    "order_payments": 'order_id,payment_sequential,payment_type,payment_installments,payment_value\n'
                      'o1,1,credit_card,8,99.33\no1,2,voucher,1,45.05\n',
    "order_reviews": 'review_id,order_id,review_score,review_comment_title,review_comment_message,'
                     'review_creation_date,review_answer_timestamp\n'
                     '"r1","o1","5","","muito bom,\n\\"recomendo\\"","2018-01-18 00:00:00","2018-01-18 21:46:59"\n',
    "orders": 'order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,'
              'order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n'
              'o1,c1,delivered,2017-07-02 10:56:33,2017-07-02 11:07:15,2017-07-04 19:55:00,2017-07-10 21:25:13,'
              '2017-07-18 00:00:00\no2,c2,shipped,2017-10-02 10:56:33,,,,2017-10-18 00:00:00\n',
    "products": 'product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,'
                'product_weight_g,product_length_cm,product_height_cm,product_width_cm\n'
                'p1,beleza_saude,40,287,1,225,16,10,14\np2,,,,,,,,\n',
    "sellers": 'seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,13023,campinas,SP\n',
    "category_translation": '﻿product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n',
}


def test_landed_files_become_views(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    entries = []
    for entity, text in LANDED.items():
        (landing / f"{entity}.csv").write_text(text, encoding="utf-8")
        entries.append({"csv_relative_url": f"{entity}.csv", "file_name": f"{entity}_dataset.csv"})
    (tmp_path / "manifest.json").write_text(json.dumps(entries, indent=2))
    views = pipeline.run(spark, f"{tmp_path}/manifest.json", str(landing), str(tmp_path),
                         {f"{entity}_dataset.csv": entity for entity in LANDED})
    assert views == [f"gold_{t}" for t in gold.STAR_TABLES]

    def one(query):
        return [tuple(r) for r in spark.sql(query).collect()]

    counts = {v: one(f"SELECT count(*) FROM {v}")[0][0] for v in views}
    assert counts["gold_fact_sales"] == counts["gold_bridge_order_items"] == counts["gold_fact_sales_partitioned"] == 5
    assert counts["gold_dim_geolocation"] == 1
    assert one("SELECT review_comment_message FROM gold_dim_order_reviews") == [("muito bomrecomendo",)]
    assert one("SELECT natural_customer_key, customer_zip_code, customer_city FROM gold_dim_customer ORDER BY 1") == [
        ("c1", 1037, "sao paulo"), ("c2", 0, "Unknown"),
    ]
    assert one("SELECT category, category_english, product_weight_grams FROM gold_dim_product ORDER BY 1") == [
        ("Unknown", None, 0), ("beleza_saude", "health_beauty", 225),
    ]
    assert one("SELECT year_month, product_sk, total_sales, avg_review_score, total_orders FROM gold_fact_sales_agg "
               "ORDER BY year, month") == [("2017-7", "p1", 235.6, 5.0, 4), ("2017-10", "p2", 10.0, 0.0, 1)]
    assert one("SELECT DISTINCT payment_type FROM gold_fact_order_payments_partitioned ORDER BY 1") == [
        ("Unknown",), ("creditcard",), ("voucher",),
    ]

    laid_out = gold.relayout(spark, f"{tmp_path}/gold", f"{tmp_path}/laid_out")
    assert laid_out["dim_customer"].count() == 2
    assert laid_out["fact_sales_partitioned"].count() == 5
    assert len(glob.glob(f"{tmp_path}/laid_out/fact_sales_partitioned/*/*.parquet")) == 2


def _landed(tmp_path, files, entries):
    landing = tmp_path / "landing"
    landing.mkdir()
    for name, text in files.items():
        (landing / f"{name}.csv").write_text(text, encoding="utf-8")
    (tmp_path / "manifest.json").write_text(json.dumps(
        [{"csv_relative_url": f"{a}.csv", "file_name": b} for a, b in entries], indent=2
    ))
    return f"{tmp_path}/manifest.json", str(landing), str(tmp_path)


def test_all_files_of_an_entity_are_read(spark, tmp_path):
    more = LANDED["orders"].splitlines()[0] + "\no3,c1,shipped,2017-11-02 10:56:33,,,,2017-11-18 00:00:00\n"
    files = {**LANDED, "orders_more": more}
    where = _landed(tmp_path, files, [(name, f"{name}.csv") for name in files])
    pipeline.run(spark, *where, {f"{name}.csv": name.removesuffix("_more") for name in files})
    found = spark.sql("SELECT natural_order_key FROM gold_dim_orders ORDER BY 1").collect()
    assert [r[0] for r in found] == ["o1", "o2", "o3"]


@pytest.mark.parametrize("entries", [[("orders", "a.csv"), ("sellers", "a.csv")], [("orders", "a.csv"), ("sellers", "b.csv")]])
def test_a_name_listed_twice_or_without_an_entity_is_refused(spark, tmp_path, entries):
    with pytest.raises(ValueError):
        pipeline.run(spark, *_landed(tmp_path, LANDED, entries), {"a.csv": "orders"})


def test_unreadable_rows_go_to_quarantine_and_no_row_is_lost(spark, tmp_path):
    header, good = LANDED["order_items"].splitlines()[:2]
    columns = header.split(",")
    bad = ["NaN" if c == "price" else v for c, v in zip(columns, good.split(","))]
    worse = ["Infinity" if c == "freight_value" else "soon" if c == "order_item_id" else v for c, v in zip(columns, good.split(","))]
    files = {**LANDED, "order_items": LANDED["order_items"] + ",".join(bad) + "\n" + ",".join(worse) + "\n"}
    read = len(files["order_items"].splitlines()) - 1
    pipeline.run(spark, *_landed(tmp_path, files, [(name, f"{name}.csv") for name in files]),
                 {f"{name}.csv": name for name in files}, quarantine=True)
    rejected = spark.read.parquet(f"{tmp_path}/rejected/order_items")
    assert sorted(r.bad_columns for r in rejected.collect()) == ["order_item_id,freight_value", "price"]
    assert spark.read.parquet(f"{tmp_path}/silver/order_items").count() + rejected.count() == read


def test_star_joins_its_dimensions_by_key(spark, tmp_path):
    files = {**LANDED, "sellers": LANDED["sellers"].splitlines()[0] + "\n"}
    pipeline.run(spark, *_landed(tmp_path, files, [(name, f"{name}.csv") for name in files]),
                 {f"{name}.csv": name for name in files})
    assert spark.table("gold_fact_sales_star").count() == spark.table("gold_fact_sales").count()
    wrong = spark.sql("""SELECT * FROM gold_fact_sales_star f LEFT JOIN gold_dim_product d USING (product_sk)
        WHERE f.product_id IS DISTINCT FROM d.natural_product_key""")
    assert wrong.isEmpty()
    assert [r[0] for r in spark.sql("SELECT DISTINCT seller_sk FROM gold_fact_sales_star").collect()] == [-1]
    assert spark.sql("SELECT count(*) FROM gold_star_orphans WHERE dimension = 'seller'").first()[0] > 0
