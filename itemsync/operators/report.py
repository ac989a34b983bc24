"""Counts and outcomes of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def ids_by_type(batches: DataFrame, batch: list[str]) -> DataFrame:
    """Ids of each type inside each batch; a list never outgrows its batch."""
    return batches.groupBy(*batch, "type").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def failed_ids(responses: DataFrame) -> DataFrame:
    """Ids with at least one error, each once."""
    return responses.filter(F.size("errors") > 0).select("id").distinct()


def with_outcome(documents: DataFrame, responses: DataFrame) -> DataFrame:
    """Narrow rows (``id``, ``type``, ``failed``); bodies stay out of the join."""
    failed = failed_ids(responses).withColumn("failed", F.lit(True))
    return (
        documents.select("id", "type")
        .join(failed, "id", "left")
        .select("id", "type", F.coalesce("failed", F.lit(False)).alias("failed"))
    )


def index_report(documents: DataFrame, responses: DataFrame) -> DataFrame:
    """Per type: how many documents were indexed out of how many."""
    counted = with_outcome(documents, responses).groupBy("type").agg(
        F.count("*").alias("total"), F.count_if("failed").alias("failed")
    )
    indexed = F.col("total") - F.col("failed")
    return counted.select(
        "type",
        "total",
        "failed",
        indexed.alias("indexed"),
        F.concat_ws(" out of ", indexed.cast("string"), F.col("total").cast("string")).alias("summary"),
    )


def failed_per_batch(batches: DataFrame, responses: DataFrame, batch: list[str]) -> DataFrame:
    """Number of failed documents of each batch."""
    failed = failed_ids(responses).withColumn("failed", F.lit(1))
    return (
        batches.select("id", *batch)
        .join(failed, "id", "left")
        .groupBy(*batch)
        .agg(F.count("*").alias("total"), F.count("failed").alias("failed"))
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they pass, at no extra scan."""
    watch = Observation(name)
    return df.observe(watch, F.count("*").alias("rows")), watch
