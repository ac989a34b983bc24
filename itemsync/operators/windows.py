"""Change windows and their division into equal time chunks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.functions.times import instant_literal

def change_window(
    df: DataFrame, column: str, start, end, bounds: str = "half_open", day: str | None = None
) -> DataFrame:
    """Rows changed in ``[start, end)``, or in ``(start, end)`` for ``bounds='open'``; all without a ``start``.

    The bounds are literals of the column's own type: both comparisons and the
    null test are pushed into the parquet scan. ``day`` names a partition column
    that holds the date of ``column``; folders outside the window are not listed
    for reading then.
    """
    if start is None:
        return df
    low, high = instant_literal(df, column, start), instant_literal(df, column, end)
    moment = F.col(column)
    after = moment > low if bounds == "open" else moment >= low
    inside = after & (moment < high)
    if day is not None:
        inside = F.col(day).between(low.cast("date"), high.cast("date")) & inside
    return df.filter(inside)


def split_ranges(df: DataFrame, start: str, end: str, chunks: int) -> DataFrame:
    """One row per chunk of each row's ``[start, end]``: ``chunk, chunk_start, chunk_end``.

    Bounds are equally spaced, computed in microseconds and cut to seconds; the
    last one is ``end`` itself.
    """
    origin = F.unix_micros(F.col(start).cast("timestamp"))
    length = F.unix_micros(F.col(end).cast("timestamp")) - origin
    step = F.bround(length / F.lit(chunks)).cast("long")

    def bound(number: Column) -> Column:
        cut = F.date_trunc("second", F.timestamp_micros(origin + step * number))
        return F.when(number == chunks, F.date_trunc("second", F.col(end).cast("timestamp"))).otherwise(cut)

    return (
        df.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        .withColumn("chunk_start", bound(F.col("chunk")))
        .withColumn("chunk_end", bound(F.col("chunk") + 1))
    )


def chunk_bounds(start: datetime, end: datetime, chunks: int) -> list[datetime]:
    """The ``chunks + 1`` bounds of one job-wide window, a parameter of its plan."""
    step = (end - start) / chunks
    return [(start + step * n).replace(microsecond=0) for n in range(chunks)] + [end.replace(microsecond=0)]


def chunk_index(df: DataFrame, column: str, start: datetime, end: datetime, chunks: int) -> Column:
    """Number of the chunk a row falls in: a plain expression, no range join."""
    index = F.lit(0)
    for bound in chunk_bounds(start, end, chunks)[1:-1]:
        index = index + (F.col(column) >= instant_literal(df, column, bound)).cast("int")
    return index


def off_bounds(df: DataFrame, column: str, start: datetime, end: datetime, chunks: int) -> DataFrame:
    """Leave out rows stamped exactly on a chunk bound, as windows open on both sides do."""
    keep = F.lit(True)
    for bound in chunk_bounds(start, end, chunks)[1:-1]:
        keep = keep & (F.col(column) != instant_literal(df, column, bound))
    return df.filter(keep)
