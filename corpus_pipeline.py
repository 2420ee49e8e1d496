"""The corpus pipeline: documents through five stages, each stored before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import bpe, decontaminate, near_dedup, quality_rules, substring_dedup
from zonecast.llm.common import materialise, read


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted quality rules keep."""
    return quality_rules.filter_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dedup.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages of 50 words or more that a smaller doc_id has too."""
    return substring_dedup.rewrite(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document that is left, encoded and decoded again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN))


STAGES = [
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", decontaminate_benchmark),
    ("byte_bpe", encode),
]

# SQL has neither the fitted weights of the rules nor byte-pair merges; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
