"""Instants, dates and their text forms. All expect a UTC session time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemsync.schemas import DEFAULT_TIME_ZONE, NO_BIRTH_YEAR, RFC3339, RFC3339_PY


def plain_utc(moment: datetime) -> datetime:
    """The same instant in UTC without a zone; a moment without a zone is taken as UTC."""
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


def parse_rfc3339(text: Column) -> Column:
    """``2022-04-02T08:20:30Z`` as a UTC instant; anything else raises."""
    return F.to_timestamp(text, RFC3339)


def try_parse_rfc3339(text: Column) -> Column:
    """As ``parse_rfc3339``, with null for empty or malformed text."""
    return F.try_to_timestamp(text, F.lit(RFC3339))


def rfc3339(instant: Column) -> Column:
    return F.date_format(instant, RFC3339)


def rfc3339_text(moment: datetime) -> str:
    return moment.strftime(RFC3339_PY)


def known_zone(timezone: Column) -> Column:
    """Whether instants can be shifted to a zone: a region or an offset that Spark knows. Never raises."""
    date, clock = [F.lit(n) for n in (2000, 1, 1)], [F.lit(0)] * 2
    return F.try_make_timestamp_ltz(*date, *clock, F.lit(0).cast("decimal(16,6)"), timezone).isNotNull()


def local_text(instant: Column, timezone: Column) -> Column:
    """Wall clock of ``timezone`` (a known one) to the second, with a literal ``Z`` behind it."""
    zone = F.coalesce(timezone, F.lit(DEFAULT_TIME_ZONE))
    return F.date_format(F.convert_timezone(F.lit("UTC"), zone, instant.cast("timestamp_ntz")), RFC3339)


def date_text(day: Column) -> Column:
    """A plain date is never shifted."""
    return F.date_format(day, "yyyy-MM-dd")


def moment_text(instant: Column | None, day: Column | None, timezone: Column) -> Column:
    """Text of a field that holds either an instant or a plain date; null if neither."""
    forms = []
    if instant is not None:
        forms.append(local_text(instant, timezone))
    if day is not None:
        forms.append(date_text(day))
    return F.coalesce(*forms)


def date_part(text: Column) -> Column:
    return F.substring_index(text, "T", 1)


def birthday_text(day: Column) -> Column:
    """``MM-dd`` where the year stands for "no year", else the whole date."""
    return F.when(F.year(day) == NO_BIRTH_YEAR, F.date_format(day, "MM-dd")).otherwise(date_text(day))


def instant_literal(df: DataFrame, column: str, moment: datetime | str) -> Column:
    """A literal of the column's own type, so that comparisons reach the file scan."""
    text = moment if isinstance(moment, str) else plain_utc(moment).strftime("%Y-%m-%d %H:%M:%S.%f")
    text = text.replace("T", " ").rstrip("Z")
    kind = df.schema[column].dataType
    return F.lit(text).cast("timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp")
