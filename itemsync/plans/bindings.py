"""The test tables seen as mailbox tables. Row-wise projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.plans.jobs import Mailboxes, union_all
from itemsync.schemas import PLATFORM_CLOUD, PLATFORM_ON_PREM

# Time zones by nation, folders by language.
ZONES = "array('UTC', 'Europe/Berlin', 'America/New_York', 'Asia/Kolkata', 'Australia/Sydney')"
FOLDERS = "map('en', 'inbox', 'fr', 'sent', 'de', 'junk', 'es', 'archive')"
EMAIL = "([A-Za-z0-9._+-]+@[A-Za-z0-9.-]+)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def user(number: Column) -> Column:
    return F.concat(F.lit("user"), number.cast("string"), F.lit("@example.com"))


def user_sql(number: str) -> str:
    return f"concat('user', {number}, '@example.com')"


def prefixed(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("-", *[p.cast("string") for p in parts]))


def every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def in_month(seconds: str) -> str:
    """An instant in January 2024."""
    return f"timestamp_seconds(1704067200 + pmod({seconds}, 30 * 24 * 3600))"


def structs(name: str, *values: str) -> str:
    return "array(" + ", ".join(f"named_struct('{name}', {value})" for value in values) + ")"


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        f"{user_sql('c_custkey')} AS account",
        f"element_at({ZONES}, c_nationkey % 5 + 1) AS timezone",
        f"if(c_custkey % 2 = 0, '{PLATFORM_CLOUD}', '{PLATFORM_ON_PREM}') AS platform",
    )


def directory(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "if(c_custkey % 10 = 0, 'searchResRef', 'searchResEntry') AS entry_type",
        "if(c_mktsegment = 'FURNITURE', 'group', 'person') AS category",
        "if(c_acctbal >= 0, 'user', 'computer') AS class",
        "if(c_custkey % 7 = 0, NULL, c_name) AS given_name",
        f"{user_sql('c_custkey')} AS mail",
        f"element_at({ZONES}, c_nationkey % 5 + 1) AS timezone",
    )


def mails(spark: SparkSession, folder: str) -> DataFrame:
    return mails_of(table(spark, folder, "documents"))


def mails_of(documents: DataFrame) -> DataFrame:
    """Documents as mails: recipients are the addresses found in the whole text."""
    found = f"if(contains(text, '@'), regexp_extract_all(text, '{EMAIL}', 1), CAST(array() AS ARRAY<STRING>))"
    sender = "concat(source, '@example.com')"
    return documents.selectExpr(
        "concat('m', doc_id) AS id",
        f"{user_sql('doc_id')} AS account",
        f"if(doc_id % 17 = 0, 'drafts', try_element_at({FOLDERS}, lang)) AS folder",
        "concat(source, '/', doc_id) AS subject",
        f"if(doc_id % 11 = 0, NULL, {sender}) AS sender",
        f"transform({found}, a -> named_struct('email_address', a)) AS to_recipients",
        f"{structs('email_address', sender, user_sql('doc_id + 1'))} AS cc_recipients",
        f"if(doc_id % 3 = 0, NULL, {structs('email_address', user_sql('doc_id + 2'))}) AS bcc_recipients",
        "if(doc_id % 5 = 0, NULL, 'Normal') AS importance",
        "array(lang, source) AS categories",
        "text AS body",
        "doc_id % 4 <> 0 AS has_attachments",
        f"{in_month('doc_id * 7919')} AS last_modified",
    )


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    attendees = structs("email_address", user_sql("user_id + 1"), "NULL", "''", user_sql("user_id + 2"))
    return table(spark, folder, "events").selectExpr(
        "concat('e', event_id) AS id",
        f"{user_sql('user_id')} AS account",
        "CASE event_type WHEN 'error' THEN 'Birthdays (Birthdays)' WHEN 'signup' THEN 'Folder (Birthdays)' "
        "ELSE 'Calendar' END AS calendar_name",
        "CAST(event_id % 3 AS INT) AS depth",
        "concat(event_type, ' ', event_id) AS subject",
        "if(event_id % 4 = 0, 'RecurringMaster', 'Single') AS type",
        "if(event_id % 8 = 0, NULL, props) AS recurrence_pattern",
        "if(event_id % 5 = 0, NULL, ts) AS start_ts",
        "if(event_id % 5 = 0, NULL, ts + INTERVAL 90 MINUTES) AS end_ts",
        "if(event_id % 5 = 0, to_date(ts), NULL) AS start_date",
        "if(event_id % 5 = 0, date_add(to_date(ts), 1), NULL) AS end_date",
        "if(event_id % 6 = 0, NULL, concat('Room ', user_id)) AS location",
        f"if(event_id % 9 = 0, NULL, {user_sql('user_id')}) AS organizer",
        f"if(event_id % 7 = 0, NULL, {attendees}) AS required_attendees",
        "if(event_id % 10 = 0, '', concat('<p>', props, ' &amp; more</p>')) AS body",
        "event_id % 2 = 0 AS has_attachments",
        "ts AS last_modified",
    )


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('t', o_orderkey) AS id",
        f"{user_sql('o_custkey')} AS account",
        "concat('Order ', o_orderkey) AS subject",
        "o_orderstatus AS status",
        f"if(o_custkey % 10 = 0, NULL, {user_sql('o_custkey')}) AS owner",
        "to_date(o_orderdate) AS start_date",
        "if(o_orderkey % 6 = 0, NULL, date_add(to_date(o_orderdate), 30)) AS due_date",
        "if(o_orderstatus = 'F', o_orderdate + INTERVAL 34 HOURS, NULL) AS complete_ts",
        "if(o_orderkey % 9 = 0, NULL, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING)) AS text_body",
        "if(o_orderkey % 4 = 0, NULL, array(o_orderpriority, o_orderstatus)) AS companies",
        "array(o_orderstatus, o_orderpriority) AS categories",
        "o_orderpriority AS importance",
        "o_orderkey % 2 <> 0 AS has_attachments",
        "o_orderdate AS last_modified",
    )


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    born = "date_add(DATE '1950-01-01', CAST(pmod(c_custkey, 20000) AS INT))"
    unknown_year = f"make_date(1604, month({born}), day({born}))"
    phones = structs("phone_number", "CAST(c_custkey AS STRING)", "lpad(CAST(c_custkey AS STRING), 12, '0')")
    return table(spark, folder, "customer").selectExpr(
        "concat('c', c_custkey) AS id",
        f"{user_sql('c_custkey')} AS account",
        "if(c_mktsegment = 'FURNITURE', 'DistributionList', 'Contact') AS item_class",
        "c_name AS display_name",
        "if(c_nationkey % 3 = 0, NULL, c_mktsegment) AS company_name",
        f"CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN {unknown_year} ELSE {born} END AS birthday",
        f"{structs('email', user_sql('c_custkey'), 'lower(c_name)')} AS email_addresses",
        f"if(c_custkey % 8 = 0, NULL, {phones}) AS phone_numbers",
        f"{in_month('c_custkey * 6151')} AS last_modified",
    )


def mail_attachments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").selectExpr(
        "concat('p', page_id) AS attachment_id",
        "concat('m', page_id) AS parent_id",
        "'mails' AS object",
        "url AS name",
        "element_at(array('text/html', 'text/html; charset=UTF-8', 'TEXT/HTML', 'application/xhtml+xml'), "
        "CAST(page_id % 4 AS INT) + 1) AS content_type",
        "encode(html, 'UTF-8') AS content",
        f"{in_month('page_id * 8111')} AS last_modified",
    )


def calendar_attachments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").selectExpr(
        "concat('v', conv_id, '-', turn) AS attachment_id",
        "concat('e', conv_id) AS parent_id",
        "'calendar' AS object",
        "role AS name",
        "element_at(array('text/plain', 'Text/Markdown; charset=\"utf-16\"'), CAST(conv_id % 2 AS INT) + 1) AS content_type",
        "encode(text, if(conv_id % 2 = 0, 'UTF-8', 'UTF-16')) AS content",
        f"{in_month('conv_id * 10007 + turn * 60')} AS last_modified",
    )


def task_attachments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as attachments without readable text; (order, line) is not unique."""
    return table(spark, folder, "lineitem").selectExpr(
        "concat('l', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS attachment_id",
        "concat('t', l_orderkey) AS parent_id",
        "'tasks' AS object",
        "concat('line ', l_linenumber) AS name",
        "'application/octet-stream' AS content_type",
        "CAST(NULL AS BINARY) AS content",
        "CAST(l_shipdate AS TIMESTAMP) AS last_modified",
    )


ATTACHMENTS = {"mails": mail_attachments, "calendar": calendar_attachments, "tasks": task_attachments}
ITEMS = {"mails": mails, "calendar": calendar, "tasks": tasks, "contacts": contacts}


def attachments(spark: SparkSession, folder: str, names=tuple(ATTACHMENTS)) -> DataFrame:
    return union_all([ATTACHMENTS[name](spark, folder) for name in names])


def mailboxes(spark: SparkSession, folder: str, names=tuple(ITEMS)) -> Mailboxes:
    """The tables of the named objects."""
    owners = [name for name in names if name in ATTACHMENTS]
    return Mailboxes(
        accounts=accounts(spark, folder),
        attachments=attachments(spark, folder, owners) if owners else None,
        **{name: ITEMS[name](spark, folder) for name in names},
    )


def identities(spark: SparkSession, folder: str) -> DataFrame:
    """One identity per order, readable by two users; every tenth list is empty."""
    return table(spark, folder, "orders").selectExpr(
        "concat('identity', o_orderkey) AS identity",
        f"if(o_orderkey % 10 = 0, CAST(array() AS ARRAY<STRING>), array({user_sql('o_custkey')}, "
        f"{user_sql('o_custkey + 1')})) AS permissions",
    )


def live_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").filter("c_acctbal > 5000").selectExpr(f"{user_sql('c_custkey')} AS account")


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Documents already indexed, on both platforms."""
    return table(spark, folder, "documents").selectExpr(
        "CAST(doc_id AS STRING) AS id",
        "'' AS parent_id",
        "lang AS type",
        f"if(doc_id % 3 = 0, '{PLATFORM_ON_PREM}', '{PLATFORM_CLOUD}') AS platform",
        "'mails' AS object",
    )
