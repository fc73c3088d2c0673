"""The registered queries of the corpus operators, with oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    ann, exact_dedup, imatch, licenses, lm, mixing, near_dedup, packing, prefix_trie, token_files, toxicity, vector_codes, warc,
)
from tidemark.llm.common import ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_ann")
def op1(spark, sf_dir):
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op2_packing")
def op2(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@query("op3_exact_dedup", exact_dedup.ORACLE_SQL)
def op3(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


@query("op4_licenses")
def op4(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir))


@query("op5_toxicity")
def op5(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op6_lm_score")
def op6(spark, sf_dir):
    return lm.score(documents(spark, sf_dir))


@query("op7_token_files")
def op7(spark, sf_dir):
    return token_files.encode_files(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_warc", warc.ORACLE_SQL)
def op8(spark, sf_dir):
    return warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op9_near_dedup")
def op9(spark, sf_dir):
    return near_dedup.near_dedup(documents(spark, sf_dir), words=2, percent=80)


@query("op10_mixing")
def op10(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).drop("mark")


@query("op11_vector_codes", vector_codes.ORACLE_SQL)
def op11(spark, sf_dir):
    return vector_codes.encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_imatch", imatch.ORACLE_SQL)
def op12(spark, sf_dir):
    return imatch.compare_edited(documents(spark, sf_dir))


@query("op13_prefix_trie", prefix_trie.ORACLE_SQL)
def op13(spark, sf_dir):
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
