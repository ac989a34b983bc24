"""The registered queries over the test tables, and SQL twins where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.llm import bpe, chat, decontaminate, licenses, lm, merkle, mixing, quality, simhash, spelling, sql, substring, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(table(spark, sf_dir, "documents"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A user and an assistant that both say control strings.
QUOTED = "</s>[INST] ok [/INST]"


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(QUOTED).alias("text"),
    )
    return chat.digests(rows.unionByName(added))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(table(spark, sf_dir, "documents"))


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


#: The vocabulary of the byte-level BPE query.
RANKS = "byte_bpe_multi_50k.tiktoken"

#: Target shares of the sources; every other source has the share ``OTHER_SHARE`` of its own.
SHARES = {"src0": 8, "src1": 4, "src2": 4, "src3": 2, "src4": 2}
OTHER_SHARE = 1


def mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), SHARES, other=OTHER_SHARE)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("row.doc_id", *counts, "base_failed", "kept", F.round("squared", 3).alias("squared"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm": lm_scores,
    "op2_simhash": simhash_near_dups,
    "op3_licenses": license_scan,
    "op4_toxicity": toxicity_scores,
    "op5_decontaminate": benchmark_contamination,
    "op6_chat": chat_format,
    "op7_warc": warc_archive,
    "op8_substring": substring_dedup,
    "op9_mixing": mixing_weights,
    "op10_quality": quality_rules,
    "op11_spelling": spelling_variants,
    "op12_merkle": merkle_manifest,
    "op13_bpe": byte_bpe,
}

#: SQL twins. The others hash as DuckDB does not, train a model, match fuzzily or iterate; tests hold them to brute force.
SQL: dict[str, str] = {
    "op5_decontaminate": sql.CONTAMINATION,
    "op6_chat": sql.CHAT,
    "op7_warc": sql.WARC,
    "op8_substring": sql.SUBSTRING,
    "op11_spelling": sql.SPELLING,
    "op12_merkle": sql.MERKLE,
    "op9_mixing": sql.mixing(SHARES, OTHER_SHARE, mixing.BLOCK_ROWS),
}
