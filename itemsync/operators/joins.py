"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if its rows are this share of what an even shuffle partition holds.
HOT_PARTITIONS = 0.5
#: Keys in the broadcast list, at most.
MOST_HOT = 20_000
SALTS = 1024
#: Rows of ids and zones that a join sends to every task, by their real count.
BROADCAST_ROWS = 500_000
#: Bits of the key filter of a join, as a power of two: 4 MB.
FILTER_BITS = 25


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark itself would broadcast ``df`` by its estimated size.

    A remote session keeps plans to itself; there the answer is no.
    """
    if not hasattr(df, "_jdf"):
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def hot_share(df: DataFrame) -> float:
    """The share of the rows from which on a key is hot: by rows per shuffle partition, with a bounded list."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(HOT_PARTITIONS / parts, 0.001), 1 / MOST_HOT)


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """Keys holding more than ``share`` of the rows: at most ``1 / share`` of them.

    Counts are combined on the map side, so a hot key costs one row per task.
    """
    share = share or hot_share(df)
    counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    total = df.agg(F.count("*").alias("_total")).scalar()
    return counts.filter(F.col("_rows") > F.greatest(total * F.lit(share), F.lit(1))).select(key)


def key_filter(big: DataFrame, keys: DataFrame, on: str, bits: int = FILTER_BITS) -> DataFrame:
    """``big`` with ``_may``: true for all rows whose key is among ``keys``, and for few others.

    A bitmap of ``bits`` hashed keys is built in one narrow aggregate and sent to the tasks
    (4 KB for each 32,768 bits, whatever the data). With more keys than bits it marks more
    rows, never fewer.
    """
    slot = F.pmod(F.xxhash64(on), F.lit(1 << bits))
    marked = keys.select(slot.alias("_slot")).groupBy(F.expr("bitmap_bucket_number(_slot)").alias("_bucket"))
    made = marked.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_slot))").alias("_bits"))
    rows = big.withColumn("_slot", slot).withColumn("_bucket", F.expr("bitmap_bucket_number(_slot)"))
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(bitmap_bit_position(_slot) AS INT) DIV 8 + 1, 1)")), 16, 10)
    spot = F.expr("CAST(bitmap_bit_position(_slot) % 8 AS INT)")
    held = F.call_function("shiftright", byte.cast("int"), spot).bitwiseAND(1) == 1
    joined = rows.join(F.broadcast(made), "_bucket", "left")
    return joined.withColumn("_may", F.coalesce(held, F.lit(False))).drop("_bucket", "_slot", "_bits")


def may_match(big: DataFrame, keys: DataFrame, on: str, bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``big`` whose key may be among ``keys``, so that others are left out before anything is shuffled."""
    return key_filter(big, keys, on, bits).filter("_may").drop("_may")


def skew_join(
    big: DataFrame,
    small: DataFrame,
    on: str,
    how: str = "inner",
    spread: Column | None = None,
    sized_by: DataFrame | None = None,
    share: float | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join of ``big``, whose key may be skewed, with ``small``, unique by key.

    Where ``small`` is within Spark's broadcast limit nothing is shuffled and
    skew does no harm. Estimates of joins are far too high; ``sized_by`` is a
    simpler table that has at least as many rows, for the limit to be tested on.
    Beyond it, rows of hot keys are spread over ``salts`` by
    ``spread`` (a column that differs between rows of one key) and only the
    matching rows of ``small`` are repeated. Rows of ``big`` that cannot match are left out
    before the shuffle (``may_match``) where the join drops them. The list of hot keys is broadcast;
    it holds at most ``1 / share`` keys whatever the data.
    """
    if sized_by is not None and fits_broadcast(sized_by) and sized_by.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on, how)
    if fits_broadcast(small):
        # no hint: the estimate is of the size on disk, and Spark still looks at the real one
        return big.join(small, on, how)
    spread = F.xxhash64(*big.columns) if spread is None else spread
    if how in ("inner", "left_semi"):
        big = may_match(big, small, on)
    hot = hot_keys(big, on, share).withColumn("_hot", F.lit(True))
    salted = big.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)
    )
    repeated = small.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    )
    return salted.drop("_hot").join(repeated.drop("_hot"), [on, "_salt"], how).drop("_salt")
