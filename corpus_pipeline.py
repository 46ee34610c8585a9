"""The corpus pipeline: five stages of the training-data operators over documents, each stored and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from listloom.llm import bpe, decontam, langid, quality, simhash
from listloom.llm.common import shared_folder, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined by a sufficient margin."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    return bpe.round_trip(docs, RANKS)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]
#: SQL expresses neither compression nor tokenizers; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for documents of sf_dir.

    Null and empty texts have no words and go with the quality rules. A row without doc_id goes where a row with one, or an
    earlier one without, is its copy, and is judged like any other elsewhere. Of repeated rows one stays. A null lang is
    learned from by none and judged by the pooled cutoff. Other columns go through as they are, whatever their names. An
    empty table goes through every stage; without labels no cutoff is certified and no language is known, so nothing stays.
    """
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
