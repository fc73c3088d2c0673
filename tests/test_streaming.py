from __future__ import annotations

import datetime
import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.streaming import events, incremental, scd2

SCHEMA = "event_id long, ts timestamp_ntz, event_type string"


def _ts(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def _land(spark, folder, number, data):
    """One file per batch; the stream takes files by time of change."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}_{number}")
    part = next(f for f in os.listdir(f"{folder}_{number}") if f.endswith(".parquet"))
    os.makedirs(folder, exist_ok=True)
    target = f"{folder}/{number:03d}.parquet"
    os.link(f"{folder}_{number}/{part}", target)
    os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))


def _run(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = events.event_stream(spark, f"{tmp_path}/in", schema, files_per_batch=1)
    counts = events.daily_counts(stream)
    events.stream_ingest(counts, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{tmp_path}/out")


def test_stream_leaves_out_repeats_and_late_rows_and_goes_on_after_a_stop(spark, tmp_path):
    folder = f"{tmp_path}/in"
    _land(spark, folder, 1, [(1, _ts(1), "view"), (2, _ts(1, 5), "view"), (2, _ts(1, 5), "view"), (3, _ts(2), "click")])
    _land(spark, folder, 2, [(3, _ts(2), "click"), (4, _ts(5), "view")])
    _land(spark, folder, 3, [(6, _ts(6), "view")])
    # Day 1 lies behind the watermark by now.
    _land(spark, folder, 4, [(5, _ts(1, 9), "view")])
    assert rows(_run(spark, tmp_path)) == [
        (datetime.date(2024, 1, 1), "view", 2), (datetime.date(2024, 1, 2), "click", 1),
    ]
    _land(spark, folder, 5, [(7, _ts(9), "view")])
    assert rows(_run(spark, tmp_path)) == [
        (datetime.date(2024, 1, 1), "view", 2), (datetime.date(2024, 1, 2), "click", 1),
        (datetime.date(2024, 1, 5), "view", 1), (datetime.date(2024, 1, 6), "view", 1),
    ]


def test_stream_equals_batch_on_closed_days(spark, tmp_path, sf_dir):
    feed = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = events.daily_counts(events.event_stream(spark, sf_dir, feed.schema, pattern="events.parquet"))
    events.stream_ingest(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    batch = events.daily_counts(feed.withColumn("ts", F.col("ts").cast("timestamp")))
    last = got.agg(F.max("day")).first()[0]
    assert rows(got) == rows(batch.where(F.col("day") <= F.lit(last)))
    assert (feed.agg(F.max("ts")).first()[0].date() - last).days == 2


def _load(spark, tmp_path, data, marks="marks", **kwargs):
    feed = spark.createDataFrame(data, SCHEMA)
    return incremental.incremental_load(feed, f"{tmp_path}/t", f"{tmp_path}/{marks}", "ts", ["event_id"], **kwargs)


def test_load_takes_new_rows_once(spark, tmp_path):
    first = [(1, _ts(1), "view"), (2, _ts(2), "view"), (2, _ts(2), "view")]
    assert _load(spark, tmp_path, first).count() == 2
    assert _load(spark, tmp_path, first).count() == 2
    assert rows(_load(spark, tmp_path, [*first, (3, _ts(3), "view")]).select("event_id")) == [(1,), (2,), (3,)]
    assert incremental.read_mark(spark, f"{tmp_path}/marks") == _ts(3)


def test_load_takes_late_rows_within_the_lateness(spark, tmp_path):
    _load(spark, tmp_path, [(1, _ts(10), "view")])
    late = [(2, _ts(9, 20), "view"), (3, _ts(5), "view")]
    assert rows(_load(spark, tmp_path, late, lateness=datetime.timedelta(days=1)).select("event_id")) == [(1,), (2,)]


def test_load_that_broke_off_before_its_mark_is_repeated_safely(spark, tmp_path):
    _load(spark, tmp_path, [(1, _ts(1), "view")])
    _load(spark, tmp_path, [(2, _ts(2), "view")], marks="lost_marks")
    assert incremental.read_mark(spark, f"{tmp_path}/marks") == _ts(1)
    assert rows(_load(spark, tmp_path, [(2, _ts(2), "view"), (3, _ts(3), "view")]).select("event_id")) == [(1,), (2,), (3,)]


def test_load_opens_only_the_last_days_of_the_target(spark, tmp_path):
    _load(spark, tmp_path, [(d, _ts(d), "view") for d in range(1, 29)])
    # A file of an old day that cannot be read.
    folder = f"{tmp_path}/t/_day=2024-01-03"
    for name in os.listdir(folder):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"not parquet")
    _load(spark, tmp_path, [(28, _ts(28), "view"), (29, _ts(29), "view")], lateness=datetime.timedelta(days=2))
    assert sorted(os.listdir(f"{tmp_path}/t"))[-1] == "_day=2024-01-29"
    assert len([f for f in os.listdir(f"{tmp_path}/t/_day=2024-01-28") if f.endswith(".parquet")]) == 1


def test_history_has_a_version_per_change(spark):
    d = datetime.date
    feed = spark.createDataFrame([
        (1, d(2020, 1, 1), "A"), (1, d(2020, 2, 1), "A"), (1, d(2020, 3, 1), "B"), (1, d(2020, 4, 1), "A"),
        (2, d(2020, 1, 1), None), (2, d(2020, 1, 5), "C"), (2, d(2020, 1, 5), "B"),
    ], "id int, day date, segment string")
    got = scd2.scd2_merge(feed, ["id"], "day", ["segment"]).orderBy("id", "valid_from").collect()
    assert [tuple(r) for r in got] == [
        (1, "A", d(2020, 1, 1), d(2020, 3, 1), False),
        (1, "B", d(2020, 3, 1), d(2020, 4, 1), False),
        (1, "A", d(2020, 4, 1), None, True),
        (2, None, d(2020, 1, 1), d(2020, 1, 5), False),
        (2, "C", d(2020, 1, 5), None, True),
    ]


def test_last_row_of_a_day_wins(spark):
    t = datetime.datetime
    feed = spark.createDataFrame([
        (1, t(2020, 1, 1, 8), 1, "Z"), (1, t(2020, 1, 1, 20), 1, "A"),  # the later time, not the greater value
        (2, t(2020, 1, 1, 8), 2, "A"), (2, t(2020, 1, 1, 8), 1, "Z"),   # one time: the sequence decides
        (2, t(2020, 1, 2, 8), 1, "A"),                                  # repeats the day before
    ], "id int, at timestamp, seq int, segment string")
    got = scd2.scd2_merge(feed, ["id"], "at", ["segment"], sequence=["seq"]).orderBy("id").collect()
    day = datetime.date(2020, 1, 1)
    assert [tuple(r) for r in got] == [(1, "A", day, None, True), (2, "A", day, None, True)]


def test_changes_merge_into_a_stored_history(spark):
    d = datetime.date
    schema = "id int, day date, segment string"
    old = [(1, d(2020, 1, 1), "A"), (1, d(2020, 2, 1), "B"), (2, d(2020, 1, 1), "C"), (3, d(2020, 1, 1), None)]
    new = [(1, d(2020, 2, 1), "A"), (1, d(2020, 3, 1), "D"), (3, d(2020, 2, 1), None), (4, d(2020, 3, 1), "E")]
    history = scd2.scd2_merge(spark.createDataFrame(old, schema), ["id"], "day", ["segment"])
    got = scd2.scd2_update(history, spark.createDataFrame(new, schema), ["id"], "day", ["segment"])
    assert rows(got) == rows(spark.createDataFrame([
        (1, "A", d(2020, 1, 1), d(2020, 3, 1), False), (1, "D", d(2020, 3, 1), None, True),
        (2, "C", d(2020, 1, 1), None, True), (3, None, d(2020, 1, 1), None, True), (4, "E", d(2020, 3, 1), None, True),
    ], got.schema))
