"""Windows to resume from, and the checkpoints to store afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.functions.times import parse_rfc3339, rfc3339, rfc3339_text
from itemsync.options import JobOptions

INCREMENTAL, FULL = "incremental", "full_sync"


def _stored(checkpoint: Column) -> Column:
    """A usable stored value; empty counts as absent, malformed text raises."""
    return F.when(checkpoint != "", rfc3339(parse_rfc3339(checkpoint)))


def checkpoint_windows(wanted: DataFrame, checkpoints: DataFrame, options: JobOptions) -> DataFrame:
    """The window of each wanted (platform, object).

    From the stored value to now; where nothing is stored, the configured window.
    """
    start, end, now = (rfc3339_text(t) for t in (options.start_time, options.end_time, options.now))
    stored = _stored(F.col("checkpoint"))
    return wanted.join(checkpoints, ["platform", "object"], "left").select(
        *wanted.columns,
        F.coalesce(stored, F.lit(start)).alias("start_time"),
        F.when(stored.isNotNull(), F.lit(now)).otherwise(F.lit(end)).alias("end_time"),
    )


def next_checkpoints(
    wanted: DataFrame, checkpoints: DataFrame, options: JobOptions, mode: str, order: str = "object"
) -> DataFrame:
    """The value stored for each wanted (platform, object) after a run.

    It is the end of the window that was read: now for a full run or where a
    value was stored, else the configured end. With ``reference_rules`` a full
    run stores now only for the first object of a platform without any stored
    value; the others, and new objects of a known platform, get the configured end.
    """
    end, now = rfc3339_text(options.end_time), rfc3339_text(options.now)
    known = checkpoints.groupBy("platform").agg(F.lit(True).alias("_known"))
    first = wanted.groupBy("platform").agg(F.min(order).alias("_first"))
    rows = (
        wanted.join(checkpoints, ["platform", "object"], "left")
        .join(known, "platform", "left")
        .join(first, "platform")
    )
    stored = F.coalesce(F.col("checkpoint"), F.lit("")) != ""
    if mode == INCREMENTAL:
        takes_now = stored
    elif options.reference_rules:
        takes_now = stored | (F.col("_known").isNull() & (F.col(order) == F.col("_first")))
    else:
        takes_now = F.lit(True)
    return rows.select(
        "platform", "object", F.when(takes_now, F.lit(now)).otherwise(F.lit(end)).alias("checkpoint")
    )
