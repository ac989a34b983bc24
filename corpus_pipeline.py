"""The training-data pipeline: quality rules, near dedup, substring dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``, extra ones and clashing names included. An empty table stays
empty; rows are told apart by doc_id and text, so rows that repeat both whole are one
after near dedup. A null doc_id is an id like others that comes last where the smallest
id decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.llm import decontaminate, mixing, quality, simhash, substring
from itemsync.llm.common import fresh_folder, own_folder, written
from itemsync.llm.queries import OTHER_SHARE, SHARES, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go; null, empty and short texts are among them."""
    return quality.judged(docs).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of three-word shingles link at two bits, the smallest doc_id stays."""
    return simhash.deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 50 that a document of a smaller doc_id holds are cut out; the document stays."""
    return substring.cleaned(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; items without words hit nothing."""
    found = decontaminate.scan(docs.select(F.struct("*").alias("row"), "text"), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select("row.*")


def mixing_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place in the mix of sources, null among them; the last stage: ids and places, no texts."""
    return mixing.mixed(docs, SHARES, other=OTHER_SHARE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_order),
]

#: XXH64 with a seed and robust estimates are not in SQL; a test runs the stages by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's intermediate tables go once its output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, "stage")
        with own_folder(spark, "work"):
            docs = written(stage(spark, docs, sf_dir), name, folder)
    return STAGES[-1][1](spark, docs, sf_dir)
