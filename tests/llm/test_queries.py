"""The registered corpus queries on the given tables, and the pipeline's stages on what they are given."""

from __future__ import annotations

import pytest

import corpus_pipeline
from acceptance.compare import differences
from tidemark.llm import mixing
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_the_rows_of_its_oracle(spark, oracle, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir).toPandas(), oracle.sql(ORACLE[name]).df()) is None


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in QUERIES


def test_each_source_comes_near_its_target(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    each = mixing.mix(docs).toPandas().merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    by = each.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), size=("source_size", "first"))
    assert ((by.taken - by.target).abs() <= 0.005 * by.target + 8).all()
    assert (by.target <= 3 * by["size"]).all() and abs(by.target.sum() - each["size"].sum()) < 1
    assert (each.taken <= 3 * each["size"]).all()


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, sf_dir)
        assert docs.columns == columns, name
        if name != "mixing":
            after = docs.count()
            assert 0 < after <= before
            before = after
    assert docs.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 3
