"""A corpus pipeline: each stage is one operator, written as Parquet and read again by the next."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratelake.llm import bpe, mixing, neardup, quality_model, quality_rules
from ratelake.llm.runtime import table
from ratelake.session import stage


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; documents labelled as good are the trusted text."""
    return quality_rules.keep_good(docs, quality_rules.trusted_from_labels(table(spark, sf_dir, "labels")))


def drop_unlikely(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more."""
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id."""
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of each document, with the digests of the numbers and of what they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                          with_ids=True)


STAGES = [("quality_rules", drop_low_quality), ("quality_classifier", drop_unlikely), ("near_duplicates", drop_near_copies),
          ("mix_sources", mix_sources), ("byte_level_bpe", encode)]

#: The classifier is no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
