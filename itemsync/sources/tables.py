"""Scans of the mailbox tables and of stored state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.schemas import MAIL_FOLDER_TYPES

# Fixed value: item class of a true contact, as opposed to a distribution list.
CONTACT_CLASS = "Contact"


def read_or_empty(spark: SparkSession, path: str, schema: str, form: str = "parquet", **options) -> DataFrame:
    """A stored table, or an empty one of the same schema where nothing is stored yet."""
    try:
        return spark.read.format(form).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def mail_items(mails: DataFrame) -> DataFrame:
    """Mails of the four folders that are synced."""
    return mails.filter(F.col("folder").isin(*MAIL_FOLDER_TYPES))


def calendar_items(calendar: DataFrame) -> DataFrame:
    """Events of the main calendar and of its direct child calendars."""
    return calendar.filter(F.col("depth") <= 1)


def contact_items(contacts: DataFrame) -> DataFrame:
    return contacts.filter(F.col("item_class") == CONTACT_CLASS)


def scan(name: str, table: DataFrame) -> DataFrame:
    """The items of an object that take part in a sync."""
    if name == "mails":
        return mail_items(table)
    if name == "calendar":
        return calendar_items(table)
    return contact_items(table) if name == "contacts" else table
