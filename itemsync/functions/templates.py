"""Body texts: one labelled line per field, with fixed labels and indents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Indents of continuation lines.
WIDE_INDENT = " " * 28
NARROW_INDENT = " " * 16

# Line labels, in order.
MAIL_LABELS = ("Sender Email", "Receiver Email", "CC", "BCC", "Importance", "Category", "Body")
CALENDAR_LABELS = (
    "Start Date",
    "End Date",
    "Location",
    "Organizer",
    "Meeting Type",
    "Attendee List",
    "Description",
)
ON_PREM_TASK_LABELS = (
    "Due Date",
    "Status",
    "Owner",
    "Start Date",
    "Complete Date",
    "Body",
    "Companies",
    "Categories",
    "Importance",
)
CLOUD_TASK_LABELS = ("Due Date", "Status", "Owner", "Complete Date", "Body", "Categories", "Importance")
CONTACT_LABELS = ("Email Addresses", "Company Name", "Contact Numbers", "Date of Birth")


def _lines(labels: tuple[str, ...], values: dict[str, Column], first: str, between: str) -> Column:
    parts = []
    for number, label in enumerate(labels):
        parts += [F.lit(f"{between if number else first}{label}: "), values[label]]
    return F.concat(*parts)


def mail_body(values: dict[str, Column]) -> Column:
    return _lines(MAIL_LABELS, values, "", "\n" + WIDE_INDENT)


def contact_body(values: dict[str, Column]) -> Column:
    return _lines(CONTACT_LABELS, values, "", "\n" + WIDE_INDENT)


def calendar_body(values: dict[str, Column]) -> Column:
    return _lines(CALENDAR_LABELS, values, "\n" + NARROW_INDENT, "\n" + NARROW_INDENT)


def birthday_body(day: Column, organizer: Column, meeting_type: Column) -> Column:
    """The short body; its last label follows a single space and a line feed ends it."""
    return F.concat(
        F.lit(f"\n{NARROW_INDENT}Date: "),
        day,
        F.lit(f"\n{NARROW_INDENT}Organizer: "),
        organizer,
        F.lit("\n Meeting Type: "),
        meeting_type,
        F.lit("\n"),
    )


def task_body(values: dict[str, Column], on_prem: bool) -> Column:
    labels = ON_PREM_TASK_LABELS if on_prem else CLOUD_TASK_LABELS
    return _lines(labels, values, "\n" + NARROW_INDENT, "\n" + NARROW_INDENT)
