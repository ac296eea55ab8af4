"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dailymart.llm import conversations, decontaminate, embeddings, hyperminhash, licenses, packing, quality, sharding, suffixes, token_counts, toxicity, urls, vector_codes
from dailymart.llm.store import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of all documents, each document encoded as a whole."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents on three-word shingles at similarity 0.85."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, declared in it or inherited."""
    return licenses.scan(table(spark, sf_dir, "documents").withColumn("path", licenses.document_path()))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of all documents without strings of 200 bytes that occur twice."""
    return suffixes.removals(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item or an edited copy of one."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; labels of held-out ones are not learnt from."""
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Small enough to split even the small tables; a parameter like any other.
SHARD_BYTES = 1 << 20


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of at most ``SHARD_BYTES`` bytes of text."""
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels of held-out ones are not learnt from."""
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all embeddings at cosine 0.9."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 4096 tokens as possible."""
    return packing.placements(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


#: The rules that overrule the vocabulary.
URL_RULES = [
    urls.Rule("org/", "allow"),
    urls.Rule("example.org/es/", "block"),
    urls.Rule("example.org/en/1", "block"),
    urls.Rule("com/fr/", "allow"),
    urls.Rule("com/de/", "block"),
]


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the URL of every page."""
    return urls.verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a fixed rule, with their faults and cheapest repair."""
    every = table(spark, sf_dir, "conversations")
    return conversations.repaired(every, conversations.damaged(conversations.turns(every)), texts=False)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, eight parts of sixteen entries each."""
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict[str, Query]:
    queries = [
        op1_token_counts,
        op2_hyperminhash,
        op3_licenses,
        op4_suffixes,
        op5_decontaminate,
        op6_quality,
        op7_sharding,
        op8_toxicity,
        op9_embeddings,
        op10_packing,
        op11_urls,
        op12_conversations,
        op13_vector_codes,
    ]
    return {q.__name__: q for q in queries}


def all_sql() -> dict[str, str]:
    return {
        "op3_licenses": licenses.sql(),
        "op7_sharding": sharding.sql(SHARD_BYTES),
        "op11_urls": urls.sql(URL_RULES),
        "op12_conversations": conversations.sql(),
        "op13_vector_codes": vector_codes.sql(),
    }
