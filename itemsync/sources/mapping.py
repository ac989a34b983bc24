"""The header-less two-column file that maps source users to target users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.schemas import USER_MAPPING
from itemsync.sources.tables import read_or_empty


#: Holds the text of a line that has not two fields.
BROKEN = "_broken"


def last_mapping(rows: DataFrame, source: str, target: str, order: list[str]) -> DataFrame:
    """One row per source; later rows win. Rows without a target are left out."""
    kept = rows.filter(F.col(source).isNotNull() & F.col(target).isNotNull())
    latest = F.max_by(F.col(target), F.struct(*order)).alias("target")
    return kept.groupBy(F.col(source).alias("source")).agg(latest)


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """The lines with their place in the file: source, target, whole line; None without a file.

    The place of a row in the file decides, also where the file is large enough
    to be read by several tasks: block start first, then order inside the block.
    """
    kind = f"{USER_MAPPING}, {BROKEN} STRING"
    rows = read_or_empty(
        spark, path, kind, "csv", header=False, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN
    )
    if not rows.inputFiles():
        return None
    return rows.select(
        "source",
        "target",
        BROKEN,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Read the mapping file; a missing or empty one maps nobody.

    Fields beyond the second are ignored. Lines without a source and a target map
    nobody (``broken_lines``) and do not keep the others from it.
    """
    placed = _lines(spark, path)
    if placed is None:
        return spark.createDataFrame([], USER_MAPPING)
    return last_mapping(placed.drop(BROKEN), "source", "target", ["_file", "_block", "_line"])


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, reason) of every line that maps nobody."""
    placed = _lines(spark, path)
    if placed is None:
        return spark.createDataFrame([], "line STRING, reason STRING")
    text = F.coalesce(BROKEN, F.concat_ws(",", F.coalesce("source", F.lit("")), F.coalesce("target", F.lit(""))))
    reason = F.when(F.col("source").isNull(), F.lit("no source")).otherwise(F.lit("no target"))
    # the whole rows are needed: Spark answers a query for the broken text alone without reading lines
    broken = placed.filter(F.col("source").isNull() | F.col("target").isNull())
    return broken.select(text.alias("line"), reason.alias("reason"))
