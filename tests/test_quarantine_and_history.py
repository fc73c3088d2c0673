"""Lines that do not fit their header, and histories merged in place."""

from __future__ import annotations

import datetime
import glob
import json
import os

import pytest

from tests.conftest import rows
from tidemark.session import shared_dir
from tidemark.sources import csv, manifest
from tidemark.streaming import scd2


def landed(spark, name, *texts):
    folder = shared_dir(spark, name).removeprefix("file://")
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/part{i}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return folder


GOOD = 'id,n,text\na,1,plain\nb,2,"with, comma"\nd,,\n"e","3","say \\"hi\\""\n'


def test_malformed_lines_are_set_aside_with_the_reason(spark):
    path = landed(spark, "lines", GOOD + 'c,2,x,EXTRA\nf,5\n\ng,1,"open\nh,2,fine\n', 'id,n,text\ni,3,"é"\n')
    good, bad = csv.scan_csv_checked(spark, path, ["text", "id"])
    assert rows(good) == rows(spark.createDataFrame(
        [("plain", "a"), ("with, comma", "b"), (None, "d"), ('say "hi"', "e"), ("fine", "h"), ("é", "i")], "text string, id string"))
    assert sorted(map(tuple, bad.collect())) == [
        ("c,2,x,EXTRA", "field count"), ("f,5", "field count"), ('g,1,"open', "open quote")]


def test_malformed_records_with_line_breaks(spark):
    path = landed(spark, "records", 'id,text\na,"two\nlines"\nb,x,EXTRA\nc,"three\n\nlines"\n', 'id,text\nd,ok\ne,y,"never closed\nf,z\n')
    good, bad = csv.scan_csv_checked(spark, path, multi_line=True)
    assert sorted(map(tuple, good.collect())) == [("a", "two\nlines"), ("c", "three\n\nlines"), ("d", "ok")]
    assert sorted(r.reason for r in bad.collect()) == ["field count", "field count"]
    assert any("never closed" in r.line and "f,z" in r.line for r in bad.collect())


def test_ingest_loses_no_line(spark):
    landing = landed(spark, "landing", GOOD + "c,2,x,EXTRA\n")
    bronze, rejected, listing = (shared_dir(spark, n) for n in ("bronze", "rejected", "manifest"))
    entries = [{"csv_relative_url": "part0.csv", "file_name": "things.csv"}]
    spark.createDataFrame([(json.dumps(entries),)], "value string").coalesce(1).write.text(listing)
    paths = manifest.manifest_ingest(spark, listing, landing, bronze, rejected=rejected)
    assert spark.read.parquet(f"{rejected}/things.csv").collect() == [("c,2,x,EXTRA", "field count")]
    got = csv.scan_csv_quoted(spark, paths["things.csv"], ["id", "n", "text"])
    assert {r.id: r.text for r in got.collect()} == {"a": "plain", "b": "with, comma", "d": None, "e": 'say "hi"'}


def changes(spark, *found):
    days = [(k, datetime.date(2024, 1, d), v) for k, d, v in found]
    return spark.createDataFrame(days, "id int, day date, v string")


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file://')}/*/*.parquet")}


def test_only_buckets_of_changed_keys_are_rewritten(spark):
    path, by = shared_dir(spark, "history"), (["id"], "day", ["v"])
    first = changes(spark, *[(k, 1, "a") for k in range(40)], (None, 1, "a"))
    scd2.scd2_merge_into(path, first, *by, buckets=8)
    before = files(path)
    second = changes(spark, (3, 5, "b"), (3, 3, "c"), (None, 2, "d"), (99, 2, "new"))
    got = rows(scd2.scd2_merge_into(path, second, *by, buckets=8))
    assert got == rows(scd2.scd2_merge(first.union(second), *by))
    folder = lambda f: f.split("/")[-2]
    now = files(path)
    touched = {folder(f) for f in set(now) - set(before)}
    assert 1 <= len(touched) <= 3
    assert all(now[f] == before[f] for f in before if folder(f) not in touched)
    again = scd2.scd2_merge_into(path, second, *by, buckets=8)
    assert rows(again) == got
    scd2.scd2_merge_into(path, second.limit(0), *by, buckets=8)
    with pytest.raises(ValueError, match="8 buckets, not 16"):
        scd2.scd2_merge_into(path, second, *by, buckets=16)


def listed(spark, *entries):
    path = shared_dir(spark, "manifest")
    text = json.dumps([{"csv_relative_url": url, "file_name": name} for url, name in entries])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("quarantine", [False, True])
def test_files_of_an_entity_are_copied_by_a_fixed_number_of_jobs(spark, quarantine):
    jobs = {}
    for n in (1, 12):
        landing = landed(spark, "landing", *[f"id,text\na{i},x\n\"b {i}\",\"y, z\"\n" for i in range(n)])
        listing = listed(spark, *[(f"part{i}.csv", f"file {i}.csv") for i in range(n)])
        bronze, rejected = shared_dir(spark, "bronze"), shared_dir(spark, "rejected")
        spark.sparkContext.setJobGroup(f"ingest{n}{quarantine}", "")
        paths = manifest.manifest_ingest_entities(
            spark, listing, landing, bronze, {f"file {i}.csv": "things" for i in range(n)}, rejected=rejected if quarantine else None)
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"ingest{n}{quarantine}"))
        spark.sparkContext.setJobGroup("", "")
        assert len(paths["things"]) == n
        for i, path in enumerate(paths["things"]):
            assert sorted(map(tuple, csv.scan_csv_quoted(spark, path, ["text", "id"]).collect())) == [("x", f"a{i}"), ("y, z", f"b {i}")]
    assert jobs[12] <= jobs[1] + 1, jobs


def test_a_file_with_other_columns_is_not_taken_for_one_of_its_entity(spark):
    landing = landed(spark, "landing", "id,text\na,x\n", "text,id\ny,b\n")
    listing, entities = listed(spark, ("part0.csv", "one.csv"), ("part1.csv", "two.csv")), {"one.csv": "things", "two.csv": "things"}
    with pytest.raises(Exception, match="header"):
        manifest.manifest_ingest_entities(spark, listing, landing, shared_dir(spark, "bronze"), entities)
    for wrong in ({"one.csv": "things"}, {}):
        with pytest.raises(ValueError, match="without an entity"):
            manifest.manifest_ingest_entities(spark, listing, landing, shared_dir(spark, "bronze"), wrong)
    with pytest.raises(ValueError, match="twice: one.csv"):
        manifest.manifest_ingest_entities(spark, listed(spark, ("part0.csv", "one.csv"), ("part1.csv", "one.csv")), landing, "b", entities)


def test_malformed_lines_are_kept_by_file_and_folder(spark):
    landing = landed(spark, "landing/sub", "id,text\na,x\nb,y,z\n", "id,text\nc\n")
    one = landed(spark, "landing2", "id,text\nd,w\n")
    root = os.path.commonpath([landing, one])
    listing = listed(spark, (os.path.relpath(landing, root), "folder.csv"), (os.path.relpath(f"{one}/part0.csv", root), "one.csv"))
    bronze, rejected = shared_dir(spark, "bronze"), shared_dir(spark, "rejected")
    paths = manifest.manifest_ingest_entities(spark, listing, root, bronze, {"folder.csv": "t", "one.csv": "t"}, rejected=rejected)
    assert [spark.read.csv(p, header=True).count() for p in paths["t"]] == [1, 1]
    bad = spark.read.parquet(f"{rejected}/t")
    assert sorted(map(tuple, bad.select("file_name", "line").collect())) == [("folder.csv", "b,y,z"), ("folder.csv", "c")]
