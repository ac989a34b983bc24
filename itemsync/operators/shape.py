"""Items of the four objects turned into documents.

Every function is a row-wise projection: the item's account and time zone are
already on the row (``with_account``), so nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.functions import templates
from itemsync.functions.text import first_text, html_to_text, join_field, join_texts, text_or_empty, text_or_none
from itemsync.functions.times import birthday_text, date_part, known_zone, local_text, moment_text
from itemsync.operators.joins import skew_join
from itemsync.operators.quality import faults, reasons, stand_ins
from itemsync.options import FieldRule
from itemsync.schemas import (
    BIRTHDAY_CALENDARS,
    CALENDAR_TYPE,
    CONTACT_TYPE,
    DEFAULT_TIME_ZONE,
    DOCUMENT_FIELDS,
    MAIL_FOLDER_TYPES,
    PLATFORM_ON_PREM,
    SOURCE_FIELD,
    TASK_TYPE,
)

ENGINE_FIELDS = ["account", "object", "parent_id", "last_modified", "has_attachments", "fault"]


#: Reason of rows whose account states a zone that Spark does not know.
UNKNOWN_ZONE = "unknown time zone, shown in the default one"


def with_account(items: DataFrame, accounts: DataFrame) -> DataFrame:
    """Items of the listed accounts, with the account's time zone.

    An account without a zone that Spark knows has the default one, and ``zone_fault``
    says so if it states another. Zones are tried once an account, not once an item.
    One account may own most of the items; its rows are spread (``skew_join``).
    """
    tried = accounts.select("account", "timezone", F.when(known_zone(F.col("timezone")), F.col("timezone")).alias("known"))
    stated = tried.groupBy("account").agg(F.max("timezone").alias("stated"), F.max("known").alias("known"))
    wrong = F.when(F.col("known").isNull() & F.col("stated").isNotNull(), F.lit(UNKNOWN_ZONE))
    zones = stated.select(
        "account",
        F.coalesce("known", F.when(F.col("stated").isNotNull(), F.lit(DEFAULT_TIME_ZONE))).alias("timezone"),
        wrong.alias("zone_fault"),
    )
    return skew_join(items, zones, "account", spread=F.col("id"))


def allow_permissions(account: Column, enabled: bool) -> Column:
    return F.array(account) if enabled else F.array().cast("array<string>")


def folder_type(folder: Column) -> Column:
    label = F.lit(None).cast("string")
    for name, kind in MAIL_FOLDER_TYPES.items():
        label = F.when(folder == name, F.lit(kind)).otherwise(label)
    return label


def meeting_type(kind: Column, pattern: Column) -> Column:
    return F.when(kind == "Single", F.lit("Normal")).otherwise(F.concat(F.lit("Recurring "), text_or_none(pattern)))


def mail_fields(mails: DataFrame) -> DataFrame:
    body = templates.mail_body(
        {
            "Sender Email": text_or_empty(F.col("sender")),
            "Receiver Email": join_field(F.col("to_recipients"), "email_address"),
            "CC": join_field(F.col("cc_recipients"), "email_address"),
            "BCC": join_field(F.col("bcc_recipients"), "email_address"),
            "Importance": text_or_none(F.col("importance")),
            "Category": join_texts(F.col("categories")),
            "Body": text_or_none(html_to_text(F.col("body"))),
        }
    )
    return mails.select(
        *_engine(mails, "mails"),
        folder_type(F.col("folder")).alias("type"),
        F.col("id").cast("string").alias("id"),
        F.col("subject").alias("title"),
        body.alias("body"),
        text_or_empty(local_text(F.col("last_modified"), F.col("timezone"))).alias("created_at"),
    )


def calendar_fields(events: DataFrame) -> DataFrame:
    zone = F.col("timezone")
    start = text_or_none(moment_text(F.col("start_ts"), F.col("start_date"), zone))
    end = text_or_none(moment_text(F.col("end_ts"), F.col("end_date"), zone))
    organizer = text_or_none(F.col("organizer"))
    meeting = meeting_type(F.col("type"), F.col("recurrence_pattern"))
    body = templates.calendar_body(
        {
            "Start Date": start,
            "End Date": end,
            "Location": text_or_none(F.col("location")),
            "Organizer": organizer,
            "Meeting Type": meeting,
            "Attendee List": join_field(F.col("required_attendees"), "email_address", skip_empty=True),
            "Description": text_or_none(html_to_text(F.col("body"))),
        }
    )
    birthday = templates.birthday_body(date_part(start), organizer, meeting)
    return events.select(
        *_engine(events, "calendar", reasons(stand_ins())),
        F.lit(CALENDAR_TYPE).alias("type"),
        F.col("id").cast("string").alias("id"),
        F.col("subject").alias("title"),
        F.when(F.col("calendar_name").isin(*BIRTHDAY_CALENDARS), birthday).otherwise(body).alias("body"),
        text_or_empty(moment_text(F.col("last_modified"), _optional(events, "last_modified_date"), zone)).alias(
            "created_at"
        ),
    )


def task_fields(tasks: DataFrame, platform: str) -> DataFrame:
    zone = F.col("timezone")
    values = {
        "Due Date": text_or_empty(date_or_moment(tasks, "due", zone)),
        "Status": text_or_none(F.col("status")),
        "Owner": text_or_none(F.col("owner")),
        "Start Date": text_or_empty(date_or_moment(tasks, "start", zone)),
        "Complete Date": text_or_empty(date_part(date_or_moment(tasks, "complete", zone))),
        "Body": text_or_none(F.col("text_body")),
        "Companies": first_text(F.col("companies")),
        "Categories": join_texts(F.col("categories")),
        "Importance": text_or_none(F.col("importance")),
    }
    return tasks.select(
        *_engine(tasks, "tasks"),
        F.lit(TASK_TYPE).alias("type"),
        F.col("id").cast("string").alias("id"),
        F.col("subject").alias("title"),
        templates.task_body(values, on_prem=PLATFORM_ON_PREM in platform).alias("body"),
        text_or_empty(moment_text(F.col("last_modified"), _optional(tasks, "last_modified_date"), zone)).alias(
            "created_at"
        ),
    )


def contact_fields(contacts: DataFrame) -> DataFrame:
    body = templates.contact_body(
        {
            "Email Addresses": join_field(F.col("email_addresses"), "email"),
            "Company Name": text_or_none(F.col("company_name")),
            "Contact Numbers": join_field(F.col("phone_numbers"), "phone_number"),
            "Date of Birth": text_or_none(birthday_text(F.col("birthday"))),
        }
    )
    return contacts.select(
        *_engine(contacts, "contacts"),
        F.lit(CONTACT_TYPE).alias("type"),
        F.col("id").cast("string").alias("id"),
        F.col("display_name").alias("title"),
        body.alias("body"),
        text_or_empty(
            moment_text(F.col("last_modified"), _optional(contacts, "last_modified_date"), F.col("timezone"))
        ).alias("created_at"),
    )


def date_or_moment(df: DataFrame, stem: str, zone: Column) -> Column:
    """Text of ``<stem>_ts`` if the table has it, else of ``<stem>_date``."""
    return moment_text(_optional(df, f"{stem}_ts"), _optional(df, f"{stem}_date"), zone)


def _optional(df: DataFrame, column: str) -> Column | None:
    return F.col(column) if column in df.columns else None


def zone_fault(df: DataFrame) -> Column:
    return F.col("zone_fault") if "zone_fault" in df.columns else F.lit(None).cast("string")


def _engine(df: DataFrame, name: str, *found: Column) -> list[Column]:
    return [
        F.col("account"),
        F.lit(name).alias("object"),
        F.lit("").alias("parent_id"),
        F.col("last_modified"),
        (F.col("has_attachments") if "has_attachments" in df.columns else F.lit(None).cast("boolean")).alias("has_attachments"),
        faults(zone_fault(df), *found).alias("fault"),
    ]


def kept_fields(rule: FieldRule | None) -> list[str]:
    """Target fields left by an include or exclude list; ``id`` always stays.

    The lists hold source names. An include list wins over an exclude list.
    """
    fields = list(SOURCE_FIELD)
    if rule and rule.include_fields:
        fields = [name for name in fields if SOURCE_FIELD[name] in rule.include_fields]
    elif rule and rule.exclude_fields:
        fields = [name for name in fields if SOURCE_FIELD[name] not in rule.exclude_fields]
    return fields if "id" in fields else ["id", *fields]


def project_fields(documents: DataFrame, rule: FieldRule | None) -> DataFrame:
    """Blank the mapped fields a rule leaves out, so every object keeps one schema."""
    kept = kept_fields(rule)
    gone = [name for name in SOURCE_FIELD if name not in kept and name in documents.columns]
    return documents.withColumns({name: F.lit(None).cast("string") for name in gone}) if gone else documents


def to_documents(fields: DataFrame, permissions: bool, rule: FieldRule | None = None) -> DataFrame:
    """Shaped items with access list, field rule and the whole document schema."""
    tagged = fields.withColumns(
        {
            "_allow_permissions": allow_permissions(F.col("account"), permissions),
            "created": F.lit(None).cast("string"),
            "url": F.lit(None).cast("string"),
        }
    )
    return project_fields(tagged, rule).select(*DOCUMENT_FIELDS, *ENGINE_FIELDS)
