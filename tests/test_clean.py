from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import schemas
from tidemark.functions import rules, text
from tidemark.operators import clean
from tidemark.plans import silver


def test_columns_are_found_by_header_not_by_position(spark):
    raw = spark.createDataFrame(
        [("SP", "sao paulo", "1037", "order-1", "per_son")],
        "customer_state string, customer_city string, customer_zip_code_prefix string, customer_id string, "
        "customer_unique_id string",
    )
    got = silver.customers(raw).first()
    assert (got.customer_id, got.customer_unique_id) == ("order-1", "person")
    assert got.customer_full_address == "sao paulo SP 1037"


def test_unreadable_text_becomes_null_and_defaults_fit_their_type(spark):
    raw = spark.createDataFrame(
        [("o#1", "x", None, "s", "soon", "12,5", None)], schemas.raw_schema(schemas.ORDER_ITEMS)
    )
    got = silver.order_items(raw).first()
    assert (got.order_id, got.order_item_id, got.product_id) == ("o1", 0, "Unknown")
    assert (got.shipping_limit_date, got.order_year, got.price, got.freight_value) == (None, None, 0.0, 0.0)


def test_date_with_time_and_missing_dates(spark):
    raw = spark.createDataFrame(
        [("1", "2", None, "2017-10-02 10:56:33", None, "", "n/a", "2017-10-18")], schemas.raw_schema(schemas.ORDERS)
    )
    got = silver.orders(raw).first()
    assert got.order_purchase_date == datetime.date(2017, 10, 2)
    assert (got.order_status, got.order_approved_date, got.order_delivered_customer_date) == ("Unknown", None, None)
    assert (got.order_purchase_month, got.order_approved_month) == (10, None)


def test_header_row_is_dropped_wherever_it_is(spark):
    df = spark.createDataFrame([("1", None), ("a", "b"), ("a", None), ("a", "b")], "a string, b string")
    assert rows(clean.drop_header_row(df)) == [("1", None), ("a", None)]


def test_rejected_rows_come_with_the_reason(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "y"), (None, None)], "i string, d string")
    good, bad = clean.reject_bad_rows(df, {"i": "int", "d": "double"})
    assert rows(good) == [(None, None), (1, 2.5)]
    assert rows(bad) == [("x", "y", "i,d")]


def test_first_row_per_key_does_not_depend_on_partitions(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    assert rows(clean.dedupe_by_key(df.repartition(5), ["k"], [F.desc("v")])) == [(0, 297), (1, 298), (2, 299)]
    assert rows(clean.dedupe_by_key(df.select("k"), ["k"])) == [(0,), (1,), (2,)]


def test_first_of_columns_with_one_name_stays(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, n string"), spark.createDataFrame([(1, "y")], "id int, n string")
    got = clean.drop_duplicate_columns(a.join(b, a.id == b.id))
    assert (got.columns, rows(got)) == (["id", "n"], [(1, "x")])


def test_text_clean_up(spark):
    df = spark.createDataFrame([("  São-Paulo,,\n12! * ",)], "t string")
    c = F.col("t")
    got = df.select(text.strip_special_chars(c), text.collapse_special_runs(c), text.normalize_city(c)).first()
    assert tuple(got) == ("  SoPaulo12  ", "São-Paulo, 12! *", "sao-paulo,, 12! *")
    assert len(text.ACCENTED) == len(text.PLAIN)


def test_sentiment_of_missing_reviews(spark):
    df = spark.createDataFrame([(5,), (4,), (3,), (1,), (None,)], "s int")
    default = [r[0] for r in df.select(rules.review_sentiment(F.col("s"))).collect()]
    assert default == ["Positive", "Positive", "Neutral", "Negative", "Negative"]
    assert df.select(rules.review_sentiment(F.col("s"), "Unknown")).collect()[-1][0] == "Unknown"


def test_no_number_is_read_from_nan_and_infinity(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("Infinity",), ("-Infinity",), (None,)], "x string")
    assert rows(clean.cast_columns(df, {"x": "double"})) == [(None,)] * 4 + [(1.5,)]
    assert [r.bad_columns for r in clean.flag_bad_rows(df, {"x": "double"}).collect()] == ["", "x", "x", "x", ""]
