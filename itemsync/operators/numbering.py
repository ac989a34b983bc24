"""Dense row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOTS = 4096


def hash_slot(key: list[str], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slots))


def with_position(
    df: DataFrame,
    key: list[str],
    within: list[str] | None = None,
    slot: Column | None = None,
    name: str = "position",
) -> DataFrame:
    """Add the 0-based position of each row in the order ``(slot, key)``.

    ``key`` must tell the rows of a group apart. ``slot`` cuts the rows into
    pieces that are sorted independently, by default a hash of the key, so a
    group that holds most of the rows is still spread over ``SLOTS`` tasks. A
    first narrow pass counts the rows per slot; the running sum of these counts
    (at most one row per slot and group) shifts the numbers of each slot.
    """
    within = within or []
    slot = hash_slot(key) if slot is None else slot
    # One struct key: equal where its members are, missing ones included.
    cut = df.withColumn("_piece", F.struct(*within, slot.alias("_slot")))
    counts = cut.groupBy("_piece").agg(F.count("*").alias("_rows"))
    group = [F.col(f"_piece.`{column}`") for column in within] or [F.lit(0)]
    before = W.partitionBy(*group).orderBy("_piece._slot").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    local = F.row_number().over(W.partitionBy("_piece").orderBy(*key)) - 1
    numbered = cut.withColumn("_local", local).join(shifts, "_piece")
    return numbered.withColumn(name, F.col("_shift") + F.col("_local")).drop("_piece", "_local", "_shift")
