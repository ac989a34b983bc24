"""The queries restated in plain SQL over the test tables.

Written from the definitions, independent of the DataFrame code, for a second
engine to check the results.
"""

from __future__ import annotations

JAN = ("TIMESTAMP '2024-01-05'", "TIMESTAMP '2024-01-25'")
ORD = ("TIMESTAMP '1997-01-01'", "TIMESTAMP '1999-07-01'")
YEARS = ("TIMESTAMP '1997-01-01'", "TIMESTAMP '2024-01-25'")
WIDE, NARROW = " " * 28, " " * 16
NL = "chr(10)"
MARKUP = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|<template\b[^>]*>.*?(?:</template\s*>|\z)|<[!?][^>]*>"
    r"""|<[a-z/](?:"[^"]*"|''[^'']*''|[^>])*>"""
)


def user(number: str) -> str:
    return f"('user' || ({number}) || '@example.com')"


def stamp(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%SZ')"


def local(moment: str) -> str:
    return f"strftime(timezone(timezone, timezone('UTC', {moment})), '%Y-%m-%dT%H:%M:%SZ')"


def none(value: str) -> str:
    return f"coalesce({value}, 'None')"


def within(column: str, span: tuple[str, str]) -> str:
    return f"{column} >= {span[0]} AND {column} < {span[1]}"


def in_month(seconds: str) -> str:
    return f"(TIMESTAMP '2024-01-01' + to_seconds(({seconds}) % 2592000))"


def html(column: str) -> str:
    value = f"regexp_replace({column}, '{MARKUP}', chr(57344), 'g')"
    for entity, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&nbsp;", "chr(160)"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)")):
        value = f"replace({value}, '{entity}', {char})"
    value = f"replace(regexp_replace({value}, '&amp;?', '&', 'g'), chr(57344), '')"
    value = rf"regexp_replace({value}, '^[\s\x{{a0}}]+', '')"
    value = rf"regexp_replace({value}, '[\s\x{{a0}}]+$', '')"
    return f"CASE WHEN {column} <> '' THEN {value} END"


def lines(first: str, between: str, *pairs: tuple[str, str]) -> str:
    """Labelled lines; both separators are SQL expressions."""
    parts = []
    for number, (label, value) in enumerate(pairs):
        parts.append(f"{between if number else first} || '{label}: ' || {value}")
    return " || ".join(parts)


WIDE_LINE = f"{NL} || '{WIDE}'"
NARROW_LINE = f"{NL} || '{NARROW}'"

ACCOUNTS = f"""accounts AS (
  SELECT {user('c_custkey')} AS account,
         ['UTC', 'Europe/Berlin', 'America/New_York', 'Asia/Kolkata', 'Australia/Sydney'][c_nationkey % 5 + 1] AS timezone,
         CASE WHEN c_custkey % 2 = 0 THEN 'Office365' ELSE 'Microsoft Exchange' END AS platform
  FROM customer)"""

DIRECTORY = f"""directory AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN 'searchResRef' ELSE 'searchResEntry' END AS entry_type,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'group' ELSE 'person' END AS category,
         CASE WHEN c_acctbal >= 0 THEN 'user' ELSE 'computer' END AS class,
         CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS given_name,
         account AS mail, timezone
  FROM customer JOIN accounts ON account = {user('c_custkey')})"""

MAILS = rf"""mails AS (
  SELECT 'm' || doc_id AS id, {user('doc_id')} AS account,
         CASE WHEN doc_id % 17 = 0 THEN 'drafts' WHEN lang = 'en' THEN 'inbox' WHEN lang = 'fr' THEN 'sent'
              WHEN lang = 'de' THEN 'junk' WHEN lang = 'es' THEN 'archive' END AS folder,
         source || '/' || doc_id AS subject,
         CASE WHEN doc_id % 11 <> 0 THEN source || '@example.com' ELSE '' END AS sender,
         array_to_string(regexp_extract_all(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+'), ', ') AS receivers,
         source || '@example.com, ' || {user('doc_id + 1')} AS cc,
         CASE WHEN doc_id % 3 <> 0 THEN {user('doc_id + 2')} ELSE '' END AS bcc,
         CASE WHEN doc_id % 5 <> 0 THEN 'Normal' END AS importance,
         lang || ', ' || source AS categories, text AS body, doc_id % 4 <> 0 AS has_attachments,
         {in_month('doc_id * 7919')} AS last_modified
  FROM documents)"""

CALENDAR = f"""calendar AS (
  SELECT 'e' || event_id AS id, {user('user_id')} AS account,
         CASE event_type WHEN 'error' THEN 'Birthdays (Birthdays)' WHEN 'signup' THEN 'Folder (Birthdays)'
              ELSE 'Calendar' END AS calendar_name,
         CAST(event_id % 3 AS INTEGER) AS depth, event_type || ' ' || event_id AS subject,
         CASE WHEN event_id % 4 <> 0 THEN 'Normal'
              ELSE 'Recurring ' || CASE WHEN event_id % 8 <> 0 THEN props ELSE 'None' END END AS meeting,
         event_id % 5 = 0 AS all_day, ts,
         CASE WHEN event_id % 6 <> 0 THEN 'Room ' || user_id ELSE 'None' END AS location,
         CASE WHEN event_id % 9 <> 0 THEN {user('user_id')} ELSE 'None' END AS organizer,
         CASE WHEN event_id % 7 <> 0 THEN {user('user_id + 1')} || ', ' || {user('user_id + 2')} ELSE '' END AS attendees,
         CASE WHEN event_id % 10 = 0 THEN '' ELSE '<p>' || props || ' &amp; more</p>' END AS body,
         event_id % 2 = 0 AS has_attachments, ts AS last_modified
  FROM events)"""

TASKS = f"""tasks AS (
  SELECT 't' || o_orderkey AS id, {user('o_custkey')} AS account, 'Order ' || o_orderkey AS subject,
         o_orderstatus AS status, CASE WHEN o_custkey % 10 <> 0 THEN {user('o_custkey')} END AS owner,
         strftime(o_orderdate, '%Y-%m-%d') AS start_day,
         CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') ELSE '' END AS due_day,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 34 HOUR END AS complete_ts,
         CASE WHEN o_orderkey % 9 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS text_body,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority ELSE '' END AS company,
         o_orderstatus || ', ' || o_orderpriority AS categories, o_orderpriority AS importance,
         o_orderkey % 2 <> 0 AS has_attachments, o_orderdate AS last_modified
  FROM orders)"""

CONTACTS = f"""contacts AS (
  SELECT 'c' || c_custkey AS id, {user('c_custkey')} AS account, c_name AS display_name,
         c_mktsegment <> 'FURNITURE' AS is_contact,
         CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END AS company_name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_custkey % 3 = 0 THEN strftime(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%m-%d')
              ELSE strftime(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d') END AS birthday,
         {user('c_custkey')} || ', ' || lower(c_name) AS emails,
         CASE WHEN c_custkey % 8 <> 0 THEN c_custkey || ', ' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') ELSE '' END AS phones,
         {in_month('c_custkey * 6151')} AS last_modified
  FROM customer)"""

ATTACHMENTS = f"""attachments AS (
  SELECT 'p' || page_id AS attachment_id, 'm' || page_id AS parent_id, 'mails' AS object, url AS name,
         {html('html')} AS body, {in_month('page_id * 8111')} AS last_modified FROM pages
  UNION ALL
  SELECT 'v' || conv_id || '-' || turn, 'e' || conv_id, 'calendar', role, text,
         {in_month('conv_id * 10007 + turn * 60')} FROM conversations
  UNION ALL
  SELECT 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, 't' || l_orderkey, 'tasks',
         'line ' || l_linenumber, NULL, l_shipdate FROM lineitem)"""

SCANS = {
    "mails": "mails.folder <> 'drafts' AND mails.folder IS NOT NULL",
    "calendar": "calendar.depth <= 1",
    "tasks": "TRUE",
    "contacts": "contacts.is_contact",
}

MAIL_TYPE = "CASE folder WHEN 'inbox' THEN 'Inbox Mails' WHEN 'sent' THEN 'Sent Mails' WHEN 'junk' THEN 'Junk Mails' WHEN 'archive' THEN 'Archive Mails' END"
MAIL_BODY = lines(
    "''", WIDE_LINE, ("Sender Email", "sender"), ("Receiver Email", "receivers"), ("CC", "cc"), ("BCC", "bcc"),
    ("Importance", none("importance")), ("Category", "categories"), ("Body", none(html("body"))),
)
START_TEXT = f"CASE WHEN all_day THEN strftime(ts, '%Y-%m-%d') ELSE {local('ts')} END"
END_TEXT = f"CASE WHEN all_day THEN strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') ELSE {local('(ts + INTERVAL 90 MINUTE)')} END"
LONG_BODY = lines(
    NARROW_LINE, NARROW_LINE, ("Start Date", START_TEXT), ("End Date", END_TEXT), ("Location", "location"),
    ("Organizer", "organizer"), ("Meeting Type", "meeting"), ("Attendee List", "attendees"),
    ("Description", none(html("body"))),
)
SHORT_BODY = (
    f"{NARROW_LINE} || 'Date: ' || split_part({START_TEXT}, 'T', 1) || {NARROW_LINE} || 'Organizer: ' || organizer"
    f" || {NL} || ' Meeting Type: ' || meeting || {NL}"
)
CALENDAR_BODY = f"CASE WHEN calendar_name = 'Calendar' THEN {LONG_BODY} ELSE {SHORT_BODY} END"
COMPLETE = f"coalesce(split_part({local('complete_ts')}, 'T', 1), '')"
TASK_HEAD = (("Due Date", "due_day"), ("Status", none("status")), ("Owner", none("owner")))
TASK_TAIL = (("Categories", "categories"), ("Importance", none("importance")))
ON_PREM_BODY = lines(
    NARROW_LINE, NARROW_LINE, *TASK_HEAD, ("Start Date", "start_day"), ("Complete Date", COMPLETE),
    ("Body", none("text_body")), ("Companies", "company"), *TASK_TAIL,
)
CLOUD_BODY = lines(NARROW_LINE, NARROW_LINE, *TASK_HEAD, ("Complete Date", COMPLETE), ("Body", none("text_body")), *TASK_TAIL)
CONTACT_BODY = lines(
    "''", WIDE_LINE, ("Email Addresses", "emails"), ("Company Name", none("company_name")),
    ("Contact Numbers", "phones"), ("Date of Birth", none("birthday")),
)


CLOUD, ON_PREM = "Office365", "Microsoft Exchange"


def item_docs(
    name: str, span: tuple[str, str] | None, allow: str = "account", task_body: str = CLOUD_BODY, platform: str = CLOUD
) -> str:
    kind, title, body = {
        "mails": (MAIL_TYPE, "subject", MAIL_BODY),
        "calendar": ("'Calendar'", "subject", CALENDAR_BODY),
        "tasks": ("'Tasks'", "subject", task_body),
        "contacts": ("'Contacts'", "display_name", CONTACT_BODY),
    }[name]
    return f"""SELECT {kind} AS type, id, {title} AS title, {body} AS body, {local('last_modified')} AS created_at,
      CAST(NULL AS VARCHAR) AS created, {allow} AS allow
    FROM {name} JOIN accounts USING (account)
    WHERE platform = '{platform}' AND {SCANS[name]} AND {within('last_modified', span) if span else 'TRUE'}"""


ATTACHMENT_TYPES = {"mails": "Mails Attachments", "calendar": "Calendar Attachments", "tasks": "Tasks Attachments"}


def attachment_docs(name: str, span: tuple[str, str] | None, extra: str = "TRUE") -> str:
    both = f"{within(name + '.last_modified', span)} AND {within('a.last_modified', span)}" if span else "TRUE"
    return f"""SELECT '{ATTACHMENT_TYPES[name]}' AS type, a.attachment_id AS id, a.name AS title, a.body,
      CAST(NULL AS VARCHAR) AS created_at, {local('a.last_modified')} AS created, {name}.account AS allow
    FROM {name} JOIN accounts USING (account) JOIN attachments a ON a.object = '{name}' AND a.parent_id = {name}.id
    WHERE platform = '{CLOUD}' AND {SCANS[name]} AND has_attachments AND {both} AND {extra}"""


def object_docs(name: str, span: tuple[str, str], extra: str = "TRUE") -> str:
    """Items and attachments; calendar rows are not deduplicated."""
    parts = [item_docs(name, span)]
    if name in ATTACHMENT_TYPES:
        parts.append(attachment_docs(name, span, extra))
    whole = " UNION ALL ".join(parts)
    return whole if name == "calendar" else f"SELECT DISTINCT * FROM ({whole})"


MAILBOXES = f"WITH {ACCOUNTS}, {MAILS}, {CALENDAR}, {TASKS}, {CONTACTS}, {ATTACHMENTS}"


def all_docs(spans: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS object, * FROM ({object_docs(name, span)})" for name, span in spans.items())


FULL = all_docs({name: YEARS for name in ("mails", "calendar", "tasks", "contacts")})

# Bounds of five equal chunks: the exact fractions, cut to seconds.
ORDER_STEP = "(epoch_us(TIMESTAMP '1999-07-01') - epoch_us(TIMESTAMP '1997-01-01')) // 5"


def order_chunk(column: str) -> str:
    bounds = [f"date_trunc('second', make_timestamp(epoch_us(TIMESTAMP '1997-01-01') + {n} * {ORDER_STEP}))" for n in range(1, 5)]
    return " + ".join(f"CAST({column} >= {bound} AS INTEGER)" for bound in bounds)


REGISTRY = """registry AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, '' AS parent_id, lang AS type,
         CASE WHEN doc_id % 3 = 0 THEN 'Microsoft Exchange' ELSE 'Office365' END AS platform, 'mails' AS object
  FROM documents)"""
LIVE = "live AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels)"

IDENTITIES = f"""identities AS (
  SELECT 'identity' || o_orderkey AS identity,
         CASE WHEN o_orderkey % 10 = 0 THEN CAST([] AS VARCHAR[])
              ELSE [{user('o_custkey')}, {user('o_custkey + 1')}] END AS permissions
  FROM orders)"""
LIVE_ACCOUNTS = f"live_accounts AS (SELECT {user('c_custkey')} AS account FROM customer WHERE c_acctbal > 5000)"
MAPPING = f"mapping AS (SELECT {user('s_suppkey * 3')} AS source, s_name AS target FROM supplier)"
OVERLAP = """kept AS (
  SELECT DISTINCT identity FROM (SELECT identity, unnest(permissions) AS address FROM identities)
  WHERE address IN (SELECT account FROM live_accounts))"""
REVOKED = f"""SELECT identity, array_to_string(list_sort(permissions), ',') AS permissions
  FROM identities WHERE identity NOT IN (SELECT identity FROM kept)"""


def grants(accounts: str) -> str:
    return f"SELECT coalesce(target, account) AS identity, account AS permissions FROM {accounts} LEFT JOIN mapping ON source = account"


def numbered(table: str, key: str, columns: str, partition: str = "", where: str = "TRUE") -> str:
    return f"""SELECT {columns}, row_number() OVER ({partition} ORDER BY {key} % 4096, {key}) - 1 AS pos
      FROM {table} WHERE {where}"""


def printed(column: str) -> str:
    doubled = f"length({column}) - length(translate({column}, chr(10) || chr(13) || chr(9) || chr(92), ''))"
    quotes = f"CASE WHEN contains({column}, chr(39)) AND contains({column}, chr(34)) THEN length({column}) - length(replace({column}, chr(39), '')) ELSE 0 END"
    return f"(length({column}) + 2 + {doubled} + {quotes})"


# {'lang': ..., 'source': ..., 'body': ...}
SIZE = f"2 + 4 + (8 + {printed('lang')}) + (10 + {printed('source')}) + (8 + {printed('text')})"
SIZES = f"""sizes AS (
  SELECT doc_id, lang, source, {SIZE} AS size, {SIZE} - {printed('text')} + 4 AS bare_size FROM documents)"""


def fold(rows: str, group: str, limit: int) -> str:
    """Next-fit by recursion: ``rows`` has the group columns, ord, size, bare_size."""
    same = " AND ".join(f"r.{c.strip()} = f.{c.strip()}" for c in group.split(","))
    listed = ", ".join(f"r.{c.strip()}" for c in group.split(","))
    taken = f"CASE WHEN r.size > {limit} THEN r.bare_size ELSE r.size END"
    return f"""fold AS (
      SELECT {listed}, r.ord, r.doc_id, 0 AS batch, r.size > {limit} AS body_removed,
             CAST({limit} - {taken} AS BIGINT) AS room
      FROM {rows} r WHERE r.ord = 0
      UNION ALL
      SELECT {listed}, r.ord, r.doc_id,
             CASE WHEN r.size < f.room THEN f.batch ELSE f.batch + 1 END,
             r.size >= f.room AND r.size > {limit},
             CAST(CASE WHEN r.size < f.room THEN f.room - r.size ELSE {limit} - {taken} END AS BIGINT)
      FROM fold f JOIN {rows} r ON {same} AND r.ord = f.ord + 1)"""


CHECKPOINTS = f"""wanted AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS platform, event_type AS object FROM events),
stored AS (
  SELECT CAST(user_id AS VARCHAR) AS platform, event_type AS object, {stamp('max(ts)')} AS checkpoint
  FROM events WHERE event_type <> 'signup' AND user_id % 5 <> 0 GROUP BY 1, 2)"""
NOW = "'2024-01-25T00:00:00Z'"


def resumed(name: str, limit: str) -> tuple[str, str]:
    """Window of an object from its newest change below ``limit``, cut to seconds."""
    return (
        f"(SELECT date_trunc('second', max(last_modified)) FROM {name} WHERE last_modified < TIMESTAMP '{limit}')",
        JAN[1],
    )


def alive(name: str) -> str:
    """Items of cloud accounts that a scan of the whole window finds."""
    return f"""({SCANS[name]} AND {within(name + '.last_modified', YEARS)}
        AND account IN (SELECT account FROM accounts WHERE platform = '{CLOUD}'))"""


LEAVING = "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
UPSERTED = """SELECT c_custkey AS id, c_name AS name FROM customer
  WHERE c_custkey NOT IN (SELECT s_suppkey * 20 FROM supplier)
  UNION ALL SELECT s_suppkey * 20, s_name FROM supplier"""

FIVE = "range(0, 5)"
DOC_COLUMNS = "type, id, title, body, created_at, created, allow"
ITEM_COLUMNS = "type, id, title, created_at, created, allow"

SQL = {
    "item_window_open": f"""SELECT o_orderkey, o_custkey, {stamp('o_orderdate')} AS modified FROM orders
        WHERE o_orderdate > {ORD[0]} AND o_orderdate < {ORD[1]}""",
    "attachment_window_half_open": f"""SELECT l_orderkey, l_linenumber, {stamp('l_shipdate')} AS modified
        FROM lineitem WHERE {within('l_shipdate', ORD)}""",
    "date_chunks": f"""WITH spans AS (
          SELECT user_id, epoch_us(date_trunc('second', min(ts))) AS s, epoch_us(date_trunc('second', max(ts))) AS e
          FROM events GROUP BY user_id),
        steps AS (SELECT *, CAST(round_even((e - s) / 5, 0) AS BIGINT) AS step FROM spans),
        chunks AS (SELECT *, unnest({FIVE}) AS chunk FROM steps)
        SELECT user_id, CAST(chunk AS INTEGER) AS chunk, {stamp('make_timestamp(s + step * chunk)')} AS chunk_start,
               {stamp('make_timestamp(CASE WHEN chunk = 4 THEN e ELSE s + step * (chunk + 1) END)')} AS chunk_end
        FROM chunks""",
    "items_per_chunk": f"""SELECT event_type, CAST((epoch_us(ts) - epoch_us({JAN[0]})) // (4 * 86400000000) AS INTEGER) AS chunk,
          count(*) AS items FROM events WHERE {within('ts', JAN)} GROUP BY 1, 2""",
    "folder_labels": f"WITH {MAILS} SELECT id, folder, {MAIL_TYPE} AS type FROM mails WHERE {SCANS['mails']}",
    "calendar_main_and_children": f"WITH {CALENDAR} SELECT id, calendar_name, depth FROM calendar WHERE depth <= 1",
    "task_scan": f"WITH {TASKS} SELECT id, account, subject, {stamp('last_modified')} AS modified FROM tasks",
    "contact_class_filter": f"WITH {CONTACTS} SELECT id, display_name FROM contacts WHERE is_contact",
    "directory_accounts": f"""WITH {ACCOUNTS}, {DIRECTORY}
        SELECT mail AS account, timezone, 'Microsoft Exchange' AS platform FROM directory
        WHERE category = 'person' AND class = 'user' AND given_name IS NOT NULL AND entry_type <> 'searchResRef'""",
    "cloud_accounts": f"WITH {ACCOUNTS} SELECT account, timezone, 'Office365' AS platform FROM accounts",
    "platform_accounts": f"WITH {ACCOUNTS} SELECT account, timezone FROM accounts WHERE platform LIKE '%Microsoft Exchange%'",
    "user_mapping": f"""SELECT {user('o_custkey')} AS source, 'target' || max(o_orderkey) AS target FROM orders GROUP BY o_custkey""",
    "account_items_local_time": f"""WITH {ACCOUNTS}, {CALENDAR}
        SELECT id, account, {local('last_modified')} AS local, split_part({local('last_modified')}, 'T', 1) AS day
        FROM calendar JOIN accounts USING (account)""",
    "quarantined_events": """SELECT 'e' || event_id AS id,
          CASE WHEN event_id % 9 = 0 AND event_id % 8 = 0 THEN 'no organizer, no recurrence'
               WHEN event_id % 9 = 0 THEN 'no organizer' ELSE 'no recurrence' END AS reason
        FROM events WHERE event_id % 9 = 0 OR event_id % 8 = 0""",
    "mail_documents": f"WITH {ACCOUNTS}, {MAILS} {item_docs('mails', JAN)}",
    "calendar_documents": f"WITH {ACCOUNTS}, {CALENDAR} {item_docs('calendar', JAN)}",
    "task_documents": f"""WITH {ACCOUNTS}, {TASKS}
        SELECT *, 'Microsoft Exchange' AS platform FROM ({item_docs('tasks', ORD, task_body=ON_PREM_BODY, platform=ON_PREM)})
        UNION ALL SELECT *, 'Office365' AS platform FROM ({item_docs('tasks', ORD)})""",
    "contact_documents": f"WITH {ACCOUNTS}, {CONTACTS} {item_docs('contacts', JAN, allow=chr(39) * 2)}",
    "html_body_text": f"SELECT page_id, {html('html')} AS body FROM pages",
    "attachment_text": f"WITH {ATTACHMENTS} SELECT attachment_id, body FROM attachments",
    "attachment_charsets": """WITH parts AS (SELECT doc_id, text, hex(encode(text)) AS digits, doc_id % 9 AS kind FROM documents)
        SELECT doc_id,
               CASE kind WHEN 2 THEN text || chr(65533) WHEN 3 THEN digits || 'ПР' WHEN 4 THEN digits || '啊' WHEN 5 THEN digits || 'é'
                         WHEN 6 THEN digits || '€' WHEN 8 THEN digits || chr(65533) ELSE text END AS body,
               CASE WHEN kind IN (2, 8) THEN 'undecodable bytes replaced' WHEN kind = 7 THEN 'unknown charset, read as UTF-8' END AS fault
        FROM parts""",
    "encoded_names": """WITH names AS (
          SELECT url FROM pages UNION ALL SELECT p_name || ' ''n'' / ' || p_type || '~*' FROM part)
        SELECT url, replace(url_encode(url), '%27', '''''') AS encoded FROM names""",
    "parsed_rfc3339": """SELECT event_id,
          CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) ELSE -1 END AS tried,
          CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) ELSE -1 END AS parsed
        FROM events""",
    "field_projection": f"""WITH {ACCOUNTS}, {MAILS}, docs AS ({item_docs('mails', JAN)})
        SELECT {DOC_COLUMNS}, 'all' AS rule FROM docs
        UNION ALL SELECT type, id, title, NULL, created_at, created, allow, 'include' FROM docs
        UNION ALL SELECT type, id, title, NULL, created_at, created, allow, 'exclude' FROM docs""",
    "item_attachments": f"{MAILBOXES} SELECT {ITEM_COLUMNS} FROM ({object_docs('tasks', ORD)})",
    "item_attachments_same_chunk": f"""{MAILBOXES} SELECT {ITEM_COLUMNS} FROM (
        {object_docs('tasks', ORD, f"{order_chunk('tasks.last_modified')} = {order_chunk('a.last_modified')}")})""",
    "dedup_documents": "SELECT DISTINCT text, lang, n_chars FROM documents",
    "latest_by_id": f"""SELECT user_id, event_type, event_id, props, {stamp('ts')} AS ts FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
        WHERE n = 1""",
    "registry_merge": f"""WITH {REGISTRY} SELECT id, parent_id, type, platform, object FROM registry
        UNION SELECT CAST(doc_id AS VARCHAR), '', CASE WHEN quality = 1 THEN 'en' ELSE 'zz' END,
          CASE WHEN doc_id % 3 = 0 THEN 'Microsoft Exchange' ELSE 'Office365' END, 'mails' FROM labels""",
    "registry_state": f"""WITH {REGISTRY} SELECT id, type, platform, 'global_keys' AS state FROM registry
        UNION ALL SELECT id, type, platform, 'delete_keys' FROM registry""",
    "deleted_ids": f"""WITH {REGISTRY}, {LIVE} SELECT DISTINCT object, id FROM registry r
        WHERE platform LIKE '%Office365%' AND NOT EXISTS (SELECT 1 FROM live l WHERE l.id = r.id)""",
    "registry_after_delete": f"""WITH {REGISTRY}, {LIVE} SELECT id, type, platform, object FROM registry r
        WHERE platform NOT LIKE '%Office365%' OR EXISTS (SELECT 1 FROM live l WHERE l.id = r.id)""",
    "revoked_identities": f"WITH {IDENTITIES}, {LIVE_ACCOUNTS}, {OVERLAP} {REVOKED}",
    "granted_permissions": f"WITH {ACCOUNTS}, {MAPPING} {grants('accounts')}",
    "round_robin_buckets": f"SELECT p_partkey, pos % 7 AS bucket FROM ({numbered('part', 'p_partkey', 'p_partkey')})",
    "fixed_chunks": f"""SELECT doc_id, source, pos // 10 AS chunk, CAST(pos % 10 AS INTEGER) AS ord
        FROM ({numbered('documents', 'doc_id', 'doc_id, source', 'PARTITION BY source')})""",
    "delete_batches": f"""SELECT o_orderkey, pos // 100 AS chunk, CAST(pos % 100 AS INTEGER) AS ord
        FROM ({numbered('orders', 'o_orderkey', 'o_orderkey')})""",
    "document_sizes": f"WITH {SIZES} SELECT doc_id, size, bare_size FROM sizes",
    "byte_batches": f"""WITH RECURSIVE {SIZES},
        cut AS MATERIALIZED (SELECT pos // 100 AS chunk, CAST(pos % 100 AS INTEGER) AS ord, doc_id, size, bare_size
                FROM ({numbered('sizes', 'doc_id', '*')})),
        {fold('cut', 'chunk', 20000)}
        SELECT chunk, ord, doc_id, batch, body_removed FROM fold""",
    "consumer_batches": f"""WITH RECURSIVE {SIZES},
        messages AS MATERIALIZED (
          SELECT lang, source, count(*) AS n, CAST(sum(size) AS BIGINT) AS chars,
                 row_number() OVER (PARTITION BY lang ORDER BY source) AS place
          FROM sizes GROUP BY lang, source),
        taken AS (
          SELECT lang, source, place, 0 AS gather, n, chars FROM messages WHERE place = 1
          UNION ALL
          SELECT m.lang, m.source, m.place,
                 t.gather + CASE WHEN t.n >= 20 OR 2 + t.chars + 2 * greatest(t.n - 1, 0) >= 60000 THEN 1 ELSE 0 END,
                 m.n + CASE WHEN t.n >= 20 OR 2 + t.chars + 2 * greatest(t.n - 1, 0) >= 60000 THEN 0 ELSE t.n END,
                 m.chars + CASE WHEN t.n >= 20 OR 2 + t.chars + 2 * greatest(t.n - 1, 0) >= 60000 THEN 0 ELSE t.chars END
          FROM taken t JOIN messages m ON m.lang = t.lang AND m.place = t.place + 1),
        placed AS (
          SELECT s.lang, t.gather, s.doc_id, s.size, s.bare_size,
                 row_number() OVER (PARTITION BY s.lang, t.gather ORDER BY s.source, s.doc_id % 4096, s.doc_id) - 1 AS pos
          FROM sizes s JOIN taken t ON t.lang = s.lang AND t.source = s.source),
        cut AS MATERIALIZED (SELECT lang, gather, pos // 20 AS chunk, CAST(pos % 20 AS INTEGER) AS ord, doc_id, size, bare_size FROM placed),
        {fold('cut', 'lang, gather, chunk', 60000)}
        SELECT lang, gather, chunk, ord, doc_id, batch, body_removed FROM fold""",
    "ids_by_type": f"""SELECT pos // 100 AS chunk, type, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
        FROM (SELECT event_id AS id, event_type AS type, row_number() OVER (ORDER BY event_id % 4096, event_id) - 1 AS pos FROM events)
        GROUP BY 1, 2""",
    "index_report": """SELECT lang AS type, count(*) AS total, count(*) FILTER (quality = 0) AS failed,
          count(*) - count(*) FILTER (quality = 0) AS indexed,
          (count(*) - count(*) FILTER (quality = 0)) || ' out of ' || count(*) AS summary
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    "failed_per_batch": """SELECT source AS batch, count(*) AS total, count(*) FILTER (quality = 0) AS failed
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
    "job_counts": f"{MAILBOXES} SELECT object, type, count(*) AS documents FROM ({FULL}) GROUP BY 1, 2",
    "upsert_snapshot": UPSERTED,
    "delete_snapshot": f"SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN ({LEAVING})",
    "permission_snapshot": f"""WITH {ACCOUNTS}, {MAPPING}, {IDENTITIES}, {LIVE_ACCOUNTS}, {OVERLAP}
        SELECT identity, array_to_string(list_sort(permissions), ',') AS permissions FROM identities JOIN kept USING (identity)
        UNION ALL {grants('accounts')}""",
    "permission_runs": f"""WITH {MAPPING}, {IDENTITIES}, {LIVE_ACCOUNTS}, {OVERLAP},
        grants AS ({grants('live_accounts')})
        SELECT identity, array_to_string(list_sort(permissions), ',') AS permissions FROM identities JOIN kept USING (identity)
        UNION ALL SELECT * FROM grants""",
    "keyed_table": f"SELECT * FROM ({UPSERTED}) WHERE id NOT IN ({LEAVING})",
    "checkpoint_windows": f"""WITH {CHECKPOINTS}
        SELECT platform, object, coalesce(checkpoint, '1997-01-01T00:00:00Z') AS start_time, {NOW} AS end_time
        FROM wanted LEFT JOIN stored USING (platform, object)""",
    "next_checkpoints": f"""WITH {CHECKPOINTS},
        firsts AS (SELECT platform, min(object) AS first FROM wanted GROUP BY platform),
        states AS (
          SELECT w.platform, w.object, checkpoint, first, w.platform IN (SELECT platform FROM stored) AS known
          FROM wanted w LEFT JOIN stored s ON s.platform = w.platform AND s.object = w.object
          JOIN firsts f ON f.platform = w.platform)
        SELECT platform, object, 'incremental' AS mode,
               CASE WHEN checkpoint IS NOT NULL THEN {NOW} ELSE '2024-01-05T00:00:00Z' END AS checkpoint FROM states
        UNION ALL
        SELECT platform, object, 'full_sync',
               CASE WHEN checkpoint IS NOT NULL OR (NOT known AND object = first) THEN {NOW}
                    ELSE '2024-01-05T00:00:00Z' END FROM states""",
    "full_sync_docs": f"{MAILBOXES} SELECT {DOC_COLUMNS} FROM ({FULL})",
    "incremental_sync_docs": f"""{MAILBOXES} SELECT {DOC_COLUMNS} FROM ({all_docs({
        'mails': resumed('mails', '2024-01-12'),
        'calendar': resumed('calendar', '2024-01-15'),
        'tasks': resumed('tasks', '2001-01-01'),
        'contacts': YEARS,
    })})""",
    "deletion_sync_plan": f"{MAILBOXES} " + " UNION ALL ".join(
        f"""SELECT '{name}' AS object, id FROM {name} WHERE NOT {alive(name)}"""
        for name in ("mails", "calendar", "tasks", "contacts")
    ) + "".join(
        f""" UNION ALL SELECT DISTINCT '{name}', attachment_id FROM attachments a WHERE a.object = '{name}' AND attachment_id NOT IN (
            SELECT b.attachment_id FROM attachments b JOIN {name} ON b.object = '{name}' AND b.parent_id = {name}.id
            WHERE {alive(name)} AND has_attachments AND {within('b.last_modified', YEARS)})"""
        for name in ATTACHMENT_TYPES
    ),
    "permission_sync_plan": f"""WITH {MAPPING}, {IDENTITIES}, {LIVE_ACCOUNTS}, {OVERLAP}
        SELECT 'revoke' AS action, * FROM ({REVOKED}) UNION ALL SELECT 'grant', * FROM ({grants('live_accounts')})""",
    "incremental_stream": f"SELECT event_id AS id, event_type AS title, {stamp('ts')} AS created_at FROM events",
    "stream_documents": f"""{MAILBOXES} SELECT {DOC_COLUMNS}, TRUE AS registered FROM (
        {item_docs('mails', None)} UNION ALL {attachment_docs('mails', None)})""",
    "stream_attachments": f"""{MAILBOXES} SELECT {DOC_COLUMNS}, TRUE AS registered FROM (
        {item_docs('mails', None)} UNION ALL {attachment_docs('mails', None)})""",
    "object_selection": f"""{MAILBOXES} SELECT object, type, count(*) AS documents FROM ({all_docs({'tasks': YEARS, 'contacts': YEARS})})
        GROUP BY 1, 2""",
    "mapping_file": f"""SELECT {user('o_custkey')} AS source, 'target' || max(o_orderkey) AS target FROM orders
        WHERE o_orderkey % 7 <> 0 AND (o_orderkey % 11 <> 0) GROUP BY o_custkey""",
    "mapping_broken_lines": f"""SELECT {user('o_custkey')} || CASE WHEN o_orderkey % 7 <> 0 THEN ',' ELSE '' END AS line,
        'no target' AS reason FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""",
    "run_outcome": f"""WITH {ACCOUNTS}, {CONTACTS}, 
        docs AS (SELECT * FROM ({item_docs('contacts', YEARS)}) WHERE CAST(substr(id, 2) AS BIGINT) % 50 <> 0 AND CAST(substr(id, 2) AS BIGINT) % 51 <> 0)
        SELECT 'contacts' AS object, id, 'refused' AS kind, 'no 7s' AS reason FROM docs WHERE id LIKE '%7'
        UNION ALL SELECT 'contacts', id, 'registered', '' FROM docs WHERE id NOT LIKE '%7'
        UNION ALL SELECT 'contacts', 'Contacts', 'report', (count(*) - count(*) FILTER (id LIKE '%7')) || ' out of ' || count(*)
          FROM docs HAVING count(*) > 0
        UNION ALL SELECT 'contacts', 'Office365', 'checkpoint', {NOW}
        UNION ALL SELECT 'contacts', id, 'mended', 'unknown time zone, shown in the default one' FROM docs
          WHERE CAST(substr(id, 2) AS BIGINT) % 6 = 2
        UNION ALL SELECT 'contacts', NULL, 'quarantined', 'no id' FROM customer
          WHERE c_custkey % 51 = 0 AND c_custkey % 50 <> 0 AND c_mktsegment <> 'FURNITURE'
        UNION ALL SELECT 'contacts', 'c' || c_custkey, 'quarantined', 'no last_modified' FROM customer
          WHERE c_custkey % 50 = 0 AND c_mktsegment <> 'FURNITURE'""",
}
