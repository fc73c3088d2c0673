"""Sources, written tables, file layout."""

from __future__ import annotations

import glob
import json
import os

import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators import layout
from tidemark.sources import csv, jdbc, lookup, manifest, tables


def parquet_files(path):
    return sorted(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_line_breaks_quotes_and_escapes_survive(spark, tmp_path):
    texts = ['two\nlines', 'a "quoted" word', 'back\\slash', 'comma, comma', '  blanks  ', 'ção']
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, t string")
    csv.write_csv_quoted(df, f"{tmp_path}/t")
    assert rows(csv.scan_csv_quoted(spark, f"{tmp_path}/t", ["id", "t"], multi_line=True)) == rows(df)


def test_byte_order_mark_and_store_id_are_dropped(spark, tmp_path):
    (tmp_path / "lookup.csv").write_text("product_category_name,product_category_name_english,_id\nbeleza,beauty,9\n",
                                         encoding="utf-8-sig")
    got = lookup.scan_lookup(
        spark, f"{tmp_path}/lookup.csv", ["product_category_name", "product_category_name_english"]
    )
    assert rows(got) == [("beleza", "beauty")]


def test_manifest_copies_each_listed_file(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.csv").write_text('id,t\n1,"x\ny"\n')
    (tmp_path / "landing" / "b.csv").write_text("k\n7\n")
    (tmp_path / "m.json").write_text(json.dumps([
        {"csv_relative_url": "a.csv", "file_name": "first.csv"}, {"csv_relative_url": "b.csv", "file_name": "second.csv"},
    ], indent=1))
    paths = manifest.manifest_ingest(
        spark, f"{tmp_path}/m.json", f"{tmp_path}/landing", f"{tmp_path}/bronze", multi_line={"first.csv"}
    )
    assert rows(csv.scan_csv_quoted(spark, paths["first.csv"], ["id", "t"], multi_line=True)) == [("1", "x\ny")]
    assert rows(csv.scan_csv_quoted(spark, paths["second.csv"], ["k"])) == [("7",)]
    part = glob.glob(f"{tmp_path}/bronze/second.csv/*.csv")[0]
    assert open(part).read() == '"k"\n"7"\n'


def test_a_partition_value_is_one_folder_with_few_files(spark, tmp_path):
    df = spark.range(4000).select(F.col("id"), F.concat(F.lit("2017-"), F.col("id") % 12 + 1).alias("year_month"))
    back = layout.write_partitioned(df.repartition(16), f"{tmp_path}/p", "year_month")
    assert len(parquet_files(f"{tmp_path}/p")) == 12
    assert back.dtypes == df.dtypes
    assert rows(back) == rows(df)
    one = tables.scan_partition_folder(spark, f"{tmp_path}/p", {"year_month": "2017-7"})
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert one.count() == df.where("year_month = '2017-7'").count()


def test_a_hot_partition_value_is_split(spark, tmp_path):
    wide = F.sha2(F.col("id").cast("string"), 512)
    df = spark.range(0, 60_000, 1, 12).select(
        F.col("id"), wide.alias("w"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k")
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        layout.write_partitioned(df, f"{tmp_path}/h", "k")
    finally:
        spark.conf.set(name, before)
    assert len(parquet_files(f"{tmp_path}/h/k=hot")) > 3
    assert spark.read.parquet(f"{tmp_path}/h").count() == 60_000


def test_tables_are_written_small(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 2).cast("string").alias("k"))
    layout.write_overwrite(df, f"{tmp_path}/a")
    layout.write_partitioned(df, f"{tmp_path}/b", "k")
    layout.replace_folders(df, f"{tmp_path}/c", "k", [])
    files = parquet_files(tmp_path)
    assert len(files) >= 5
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_compaction_merges_files_and_keeps_rows(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 4).cast("string").alias("k"))
    df.repartition(10).write.partitionBy("k").parquet(f"{tmp_path}/many")
    df.repartition(10).write.parquet(f"{tmp_path}/flat")
    compact = layout.compact_files(spark, f"{tmp_path}/many", f"{tmp_path}/few", "k")
    assert (len(parquet_files(f"{tmp_path}/many")), len(parquet_files(f"{tmp_path}/few"))) == (40, 4)
    assert rows(compact.select("id")) == rows(df.select("id"))
    flat = layout.compact_files(spark, f"{tmp_path}/flat", f"{tmp_path}/one")
    assert (len(parquet_files(f"{tmp_path}/one")), flat.count()) == (1, 1000)


def test_compaction_refuses_a_folder_in_use(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/a")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        layout.compact_files(spark, f"{tmp_path}/a", f"{tmp_path}/a")


def test_clustered_files_cover_separate_ranges_and_split_a_hot_value(spark, tmp_path):
    # A third of all rows have one city.
    df = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * 7919 % 1000).alias("city")
    )
    df.write.parquet(f"{tmp_path}/in")
    got = layout.cluster_layout(spark, f"{tmp_path}/in", f"{tmp_path}/out", "city", files=9)
    ranges, sizes = [], []
    for f in parquet_files(f"{tmp_path}/out"):
        meta = pq.ParquetFile(f).metadata
        stats = meta.row_group(0).column(1).statistics
        ranges.append((stats.min, stats.max))
        sizes.append(meta.num_rows)
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(sizes) < 2000
    assert rows(got) == rows(df)


def test_layers_hold_the_same_rows(spark, tmp_path):
    df = spark.range(10)
    layout.write_layers({"t": df}, f"{tmp_path}/silver", f"{tmp_path}/gold")
    assert rows(spark.read.parquet(f"{tmp_path}/silver/t")) == rows(spark.read.parquet(f"{tmp_path}/gold/t")) == rows(df)


class _Recorder:
    """Stands in for the reader and writer of JDBC: no database is started here."""

    def __init__(self, result=None):
        self.result, self.calls, self.given = result, [], {}

    def options(self, **given):
        self.given |= given
        return self

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))
        return self.result


class _Bounds:
    def first(self):
        return 10, 250


def test_jdbc_read_is_split_over_the_key_range():
    class Session:
        read = _Recorder(_Bounds())

    jdbc.scan_jdbc(Session, "jdbc:x", "payments", "order_no", 4, {"user": "u"})
    (bounds, _), (args, split) = Session.read.calls
    assert "MIN(order_no)" in bounds[1]
    assert args == ("jdbc:x", "payments")
    assert (split["column"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("order_no", 10, 250, 4)


def test_jdbc_write_replaces_the_table_in_batches():
    class Frame:
        write = _Recorder()

    jdbc.write_jdbc_batched(Frame, "jdbc:x", "payments", {"user": "u"}, connections=3)
    assert Frame.write.given["batchsize"] == 500
    assert "order_id VARCHAR(50)" in Frame.write.given["createTableColumnTypes"]
    assert Frame.write.calls[0][1]["mode"] == "overwrite"


def test_scratch_folders_lie_in_the_shared_folder(spark):
    from tidemark.session import shared_dir

    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second
    run = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"
    assert os.path.dirname(first) == run


def test_folder_names_of_partitions_stay_apart(spark, tmp_path):
    for name, x in [("01", 1), ("1", 2)]:
        spark.createDataFrame([(x,)], "x int").write.parquet(f"{tmp_path}/t/k={name}")
    compact = layout.compact_files(spark, f"{tmp_path}/t", f"{tmp_path}/few", "k")
    assert rows(compact.select("k", "x")) == [("01", 1), ("1", 2)]
    schema = T.StructType.fromDDL("x int, k string")
    one = tables.scan_partition_folder(spark, f"{tmp_path}/t", {"k": "01"}, schema)
    assert rows(one) == [(1, "01")]
    clustered = layout.cluster_layout(spark, f"{tmp_path}/t", f"{tmp_path}/clustered", "x", schema=schema)
    assert rows(clustered) == [(1, "01"), (2, "1")]


def test_bytes_of_a_table_are_those_of_its_files(spark, tmp_path):
    (tmp_path / "t" / "k=1").mkdir(parents=True)
    (tmp_path / "t" / "k=1" / "a.csv").write_bytes(b"x" * 70)
    (tmp_path / "t" / "b.csv").write_bytes(b"x" * 30)
    assert tables.table_bytes(spark, f"{tmp_path}/t") == 100
