"""Cleaning, deduplicating, mixing and encoding of a corpus, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of documents.

Any column may hold nulls, further columns may have any name and pass through, and empty
tables give empty ones. Whole texts count, however long. Unless a stage says otherwise, repeated
rows and rows without id are judged alike, each for itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, mixing, near_dedup, quality_rules, toxicity
from riskloom.llm.common import table
from riskloom.llm.queries import MULTI_BPE
from riskloom.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    Null and empty texts stay, and so does everything where no document is labelled.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the quality model.

    Null and empty texts fail the base rules, which ask for 50 words.
    """
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, model)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Null and empty texts are near to none and stay. Repeated rows of an id give one row; rows
    without id stay.
    """
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the token budgets of their sources, again for each epoch.

    Rows without words go. Repeated rows of an id stay together in a budget; rows without id
    count as one.
    """
    return mixing.mix(docs, mixing.TARGET).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, a row for each row.

    A null text counts as empty.
    """
    return bpe.digests(docs, public_tokenizers.path(MULTI_BPE), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_quality),
    ("near_dedup", keep_one_of_near),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# Trained models and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
