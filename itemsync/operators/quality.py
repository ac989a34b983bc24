"""Rows that cannot be synced as they are, set aside with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(rules: dict[str, Column]) -> Column:
    """The broken rules of a row, joined; empty for a sound row. A rule holds where it is true."""
    return F.concat_ws(", ", *[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()])


def faults(*found: Column) -> Column:
    """What had to be mended in a row, joined; null for a sound one. Each of ``found`` may be null or empty."""
    return F.nullif(F.concat_ws(", ", *[F.nullif(reason, F.lit("")) for reason in found]), F.lit(""))


def set_aside(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and broken rows with ``reason``. One bad row never stops the rest of its account."""
    marked = df.withColumn("reason", reasons(rules))
    return marked.filter("reason = ''").drop("reason"), marked.filter("reason <> ''")


def item_rules() -> dict[str, Column]:
    """What every item needs."""
    return {f"no {name}": F.col(name).isNull() for name in ("id", "account", "last_modified")}


def event_rules() -> dict[str, Column]:
    """What every item needs, and what calendar events have stand-in texts for."""
    return {**item_rules(), **stand_ins()}


def stand_ins() -> dict[str, Column]:
    """Calendar events that are shaped with stand-in texts."""
    recurring = F.coalesce(F.col("type"), F.lit("")) != "Single"
    return {
        "no organizer": F.col("organizer").isNull(),
        "no recurrence": recurring & F.col("recurrence_pattern").isNull(),
    }
