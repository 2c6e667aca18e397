"""The ``opN_*`` entries: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (ann, classifier, html_text, langid, lexical, mixing, negatives, packing, quality_rules, simhash, substring,
                        suffix, token_files)
from strata.llm.common import shared_path, table

def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_x_bytes").alias("n_bytes"), F.col("_x_removed").alias("n_removed"),
                      F.col("_x_spans").alias("n_spans"), F.sha2("_x_kept", 256).alias("kept_sha256"))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_d_words").alias("n_words"), F.col("_d_removed").alias("n_removed"),
                      F.sha2("_d_kept", 256).alias("kept_sha256"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digest=True)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(table(spark, sf_dir, "documents"), shared_path(spark, "token-files"),
                              public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    read = token_files.read(files)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("_h_text").alias("text"), F.col("_h_chars").alias("n_chars"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_suffix_array": op2_suffix_array,
    "op3_substring": op3_substring,
    "op4_neighbours": op4_neighbours,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_classifier": op7_classifier,
    "op8_token_files": op8_token_files,
    "op9_language": op9_language,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_html_text": op12_html_text,
    "op13_lexical": op13_lexical,
}
