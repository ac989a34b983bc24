"""Cutting rows into requests: equal buckets, fixed chunks, size-bounded batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from itemsync.operators.numbering import hash_slot, with_position
from itemsync.schemas import BATCH_SIZE, MAX_REQUEST_CHARS


def round_robin_buckets(df: DataFrame, buckets: int, key: list[str], slot: Column | None = None) -> DataFrame:
    """Deal the rows one by one into ``min(buckets, rows)`` buckets."""
    total = df.agg(F.count("*").alias("_total")).scalar()
    numbered = with_position(df, key, slot=slot)
    return numbered.withColumn("bucket", F.col("position") % F.least(F.lit(buckets), total)).drop("position")


def fixed_chunks(
    df: DataFrame,
    size: int,
    key: list[str],
    within: list[str] | None = None,
    slot: Column | None = None,
) -> DataFrame:
    """Add ``chunk`` and ``ord``: consecutive groups of ``size`` rows, only the last one smaller."""
    numbered = with_position(df, key, within, slot)
    chunk = F.floor(F.col("position") / F.lit(size))
    return (
        numbered.withColumn("chunk", chunk)
        .withColumn("ord", (F.col("position") % F.lit(size)).cast("int"))
        .drop("position")
    )


def delete_batches(ids: DataFrame, id_column: str = "id", slot: Column | None = None) -> DataFrame:
    return fixed_chunks(ids, BATCH_SIZE, [id_column], slot=slot)


def byte_batches(
    chunks: DataFrame,
    limit: int = MAX_REQUEST_CHARS,
    group: list[str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Fill batches in order: next-fit inside each chunk of at most ``BATCH_SIZE`` rows.

    Takes narrow rows (``chunk``, ``ord``, ``size``, ``bare_size`` and the
    columns ``keep``) and adds ``batch`` and ``body_removed``. A row joins the
    open batch while it is strictly smaller than the room left. A row above the
    limit loses its body and opens a batch. What is folded per group is a list
    of at most one chunk, with numbers and keys only.
    """
    group = group or ["chunk"]
    keep = keep or ["id"]
    rows = F.array_sort(F.collect_list(F.struct("ord", "size", "bare_size", *keep)))
    start = F.struct(
        F.lit(0).alias("batch"),
        F.lit(0).alias("filled"),
        F.lit(limit).cast("long").alias("room"),
        F.array().cast("array<int>").alias("marks"),
    )

    def place(state: Column, row: Column) -> Column:
        joins = row["size"] < state["room"]
        removed = ~joins & (row["size"] > limit)
        taken = F.when(removed, row["bare_size"]).otherwise(row["size"])
        batch = state["batch"] + F.when(~joins & (state["filled"] > 0), 1).otherwise(0)
        room = F.when(joins, state["room"]).otherwise(F.lit(limit).cast("long")) - taken
        mark = 2 * batch + removed.cast("int")
        return F.struct(
            batch.alias("batch"),
            F.lit(1).alias("filled"),
            room.alias("room"),
            F.concat(state["marks"], F.array(mark)).alias("marks"),
        )

    marks = F.aggregate("rows", start, place, lambda state: state["marks"])
    folded = chunks.groupBy(*group).agg(rows.alias("rows")).withColumn("marks", marks)
    placed = folded.select(*group, F.explode(F.arrays_zip("rows", "marks")).alias("placed"))
    return placed.select(
        *group,
        "placed.rows.ord",
        *[f"placed.rows.{column}" for column in keep],
        F.floor(F.col("placed.marks") / 2).cast("int").alias("batch"),
        (F.col("placed.marks") % 2 == 1).alias("body_removed"),
    )


def gather_messages(
    sizes: DataFrame,
    queue: str,
    message: str,
    rows: int = BATCH_SIZE,
    limit: int = MAX_REQUEST_CHARS,
) -> DataFrame:
    """Which messages of a queue are gathered before a request is cut.

    Messages are taken in order until at least ``rows`` rows or ``limit``
    characters are gathered; the end of a queue closes the gathering too. What a
    message opens depends on all before it, so the totals of a queue (one row per
    message, that is one per time chunk) stream through one task in order, which
    holds a running count and no list.
    """
    totals = sizes.groupBy(queue, message).agg(F.count("*").alias("n"), F.sum("size").alias("chars"))
    ordered = totals.repartition(queue).sortWithinPartitions(queue, message)
    kind = StructType([totals.schema[queue], totals.schema[message], StructField("gather", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(kind)
        first, now, gather, n, chars = True, None, 0, 0, 0
        for batch in batches:
            gathers = []
            for at, own, size in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
                if first or at != now:
                    first, now, gather, n, chars = False, at, 0, 0, 0
                # the printed size of a list: brackets, and a comma and a blank between its rows
                if n >= rows or 2 + chars + 2 * max(n - 1, 0) >= limit:
                    gather, n, chars = gather + 1, 0, 0
                n, chars = n + own, chars + (size or 0)
                gathers.append(gather)
            columns = [batch.column(0), batch.column(1), pa.array(gathers, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, fields)], schema=fields)

    return ordered.mapInArrow(run, kind)


def consumer_batches(
    sizes: DataFrame,
    queue: str,
    message: str,
    key: list[str],
    limit: int = MAX_REQUEST_CHARS,
    rows: int = BATCH_SIZE,
    slot: Column | None = None,
) -> DataFrame:
    """The whole consumer rule: gather messages, cut chunks of ``rows``, fill batches.

    ``sizes`` is narrow: keys, ``size`` and ``bare_size``. The result keeps the
    keys and says which request a row belongs to; bodies are joined back once.
    """
    gathers = gather_messages(sizes, queue, message, rows, limit)
    gathered = sizes.join(gathers, [queue, message])
    order = F.struct(F.col(message), hash_slot(key) if slot is None else slot)
    chunks = fixed_chunks(gathered, rows, key, within=[queue, "gather"], slot=order)
    return byte_batches(chunks, limit, group=[queue, "gather", "chunk"], keep=key)
