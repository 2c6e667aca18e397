"""The corpus pipeline: rejected documents go, near copies go, repeated passages go, sources are
mixed to their weights, and what is left is packed into training sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and returns the
columns of ``documents`` (the last one returns the packed pieces). Between stages the rows are
written as Parquet in the shared folder and read again.

Edge cases are those of the operators: a null text fails the quality rules, a null doc_id is a
document like any other, and an empty table runs through to an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import mixing, packing, quality_rules, simhash, substring, tokens
from strata.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds."""
    return substring.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences."""
    # the workers of the earlier stages live on beside the JVM, so the tokenizer keeps less in memory
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), digest=True, limits=tokens.SMALL)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

#: The stages draw on fingerprints, an estimated model and a tokenizer that SQL cannot express; the
#: tests hold each stage, and the whole run, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
