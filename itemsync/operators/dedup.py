"""Duplicate documents and latest versions.

Each comes twice. ``distinct_rows`` and ``latest_by_id`` are for stored tables, which
are cheap to read again: a narrow pass over digests or keys finds what has copies, and
only those wide rows are shuffled. The ``_computed`` forms are for rows that cost more
to compute again than to shuffle once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.operators.joins import key_filter, may_match


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup of a stored table.

    Only a 128-bit digest of every row is counted. Rows whose digest may occur twice are
    combined and shuffled whole; all others stay where they are.
    """
    digest = F.struct(F.xxhash64(*df.columns).alias("a"), F.xxhash64(F.lit(1), *df.columns).alias("b"))
    marked = df.withColumn("_digest", digest)
    repeated = marked.groupBy("_digest").agg(F.count("*").alias("_n")).filter("_n > 1").select("_digest")
    flagged = key_filter(marked, repeated, "_digest").drop("_digest")
    once = flagged.filter(~F.col("_may")).drop("_may")
    return once.unionByName(flagged.filter("_may").drop("_may").dropDuplicates(df.columns))


def distinct_computed(df: DataFrame) -> DataFrame:
    """Whole-row dedup in one pass. Copies are combined on the map side before the shuffle."""
    return df.dropDuplicates()


def latest_by_id(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key of a stored table by ``order``; ties go to the greater remaining fields.

    The greatest order of each key comes from narrow aggregates, column by column. Other
    fields are read again for the winners alone: rows that cannot be one are left out by a
    bitmap, so bodies move once and are not sorted. Only keys with tied winners compare them.
    """
    if not order:
        return latest_computed(df, key, order)
    narrow = df.select(*key, *order)
    best = narrow
    for n, column in enumerate(order):
        top = narrow.groupBy(*key, *order[:n]).agg(F.max(column).alias(column))
        best = top if n == 0 else met(top, best, [*key, *order[:n]], "left_semi")
    place = [*key, *order]
    copies = narrow.groupBy(*place).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    tied = met(best, copies, place, "left_semi")
    single = met(best, copies, place, "left_anti")
    return _winners(df, single, place).unionByName(latest_computed(_winners(df, tied, place), key, order))


def _winners(df: DataFrame, keys: DataFrame, place: list[str]) -> DataFrame:
    """Wide rows that stand at one of ``keys``; those that surely do not are never shuffled."""
    spot = lambda rows: rows.withColumn("_spot", F.struct(*place))
    near = may_match(spot(df), spot(keys).select("_spot"), "_spot").drop("_spot")
    return met(near, keys.hint("shuffle_hash"), place, "left_semi")


def met(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """A semi or anti join in which missing values are equal."""
    equal = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in columns]
    return left.alias("l").join(right.alias("r"), reduce(Column.__and__, equal), how)


def latest_computed(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``latest_by_id`` in one pass over rows that are computed on the way.

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a key with very many versions costs one row per task.
    """
    rest = [name for name in df.columns if name not in key and name not in order]
    if not order and not rest:
        return df.distinct()
    latest = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*key).agg(latest).select(*key, "_row.*").select(*df.columns)
