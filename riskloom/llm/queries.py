"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import (
    bit_search,
    bpe,
    brown_lm,
    collocations,
    jaccard_join,
    kneser_ney,
    mixing,
    near_dedup,
    quality_rules,
    sharding,
    token_counts,
    top_k,
    toxicity,
)
from riskloom.llm.common import table
from riskloom.llm.oracle import ORACLE as ORACLE

MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.duplicates(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.judged(docs, table(spark, sf_dir, "labels"), kneser_ney.WORDS)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path(MULTI_BPE), public_tokenizers.PATTERN)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.counts(docs, public_tokenizers.path(WORD_BPE))


def op10_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.scored(table(spark, sf_dir, "documents"))


def op11_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_near_dedup,
        op3_top_k,
        op4_sharding,
        op5_kneser_ney,
        op6_byte_bpe,
        op7_quality_rules,
        op8_mixing,
        op9_token_counts,
        op10_brown_lm,
        op11_bit_search,
        op12_jaccard_join,
        op13_collocations,
    )
}
