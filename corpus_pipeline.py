"""From raw documents to training sequences: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dailymart.llm import decontaminate, hyperminhash, packing, quality, suffixes
from dailymart.llm.store import saved, ship


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, similarity 0.8)."""
    ship(spark)
    return hyperminhash.one_of_each(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice go from the texts; every document stays."""
    ship(spark)
    return suffixes.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item, literal or edited, go."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    ship(spark)
    return packing.placements(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("decontamination", decontamination),
    ("packing", packing_plan),
]

#: SQL cannot express the classifier, the registers, the alignment or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
