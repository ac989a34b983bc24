"""Table schemas and the fixed values every other module shares."""

# The two supported platforms.
PLATFORM_CLOUD = "Office365"
PLATFORM_ON_PREM = "Microsoft Exchange"
PLATFORMS = (PLATFORM_CLOUD, PLATFORM_ON_PREM)

# Object names and the type labels written on documents.
OBJECTS = ("mails", "calendar", "tasks", "contacts")
MAIL_FOLDER_TYPES = {
    "inbox": "Inbox Mails",
    "sent": "Sent Mails",
    "junk": "Junk Mails",
    "archive": "Archive Mails",
}
CALENDAR_TYPE = "Calendar"
TASK_TYPE = "Tasks"
CONTACT_TYPE = "Contacts"
ATTACHMENT_TYPES = {
    "mails": "Mails Attachments",
    "calendar": "Calendar Attachments",
    "tasks": "Tasks Attachments",
}

# Calendar names that get the short birthday body, and the birth
# year that stands for "no year given".
BIRTHDAY_CALENDARS = ("Folder (Birthdays)", "Birthdays (Birthdays)")
NO_BIRTH_YEAR = 1604

# Request limits and default look-back.
BATCH_SIZE = 100
MAX_REQUEST_CHARS = 10_000_000
LOOK_BACK_DAYS = 180

# Text form of an instant, for Spark and for Python.
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RFC3339_PY = "%Y-%m-%dT%H:%M:%SZ"
DEFAULT_TIME_ZONE = "UTC"

# Target field -> source field, used for include/exclude lists.
SOURCE_FIELD = {
    "id": "Id",
    "title": "DisplayName",
    "body": "Description",
    "created_at": "Created",
}

# Optional partition column of item and attachment tables: the UTC date of
# last_modified. Where a table has it, windows prune its folders.
DAY_COLUMN = "modified_day"

ACCOUNTS = "account STRING, timezone STRING, platform STRING"
DIRECTORY = "entry_type STRING, category STRING, class STRING, given_name STRING, mail STRING"
MAILS = (
    "id STRING, account STRING, folder STRING, subject STRING, sender STRING, "
    "to_recipients ARRAY<STRUCT<email_address: STRING>>, "
    "cc_recipients ARRAY<STRUCT<email_address: STRING>>, "
    "bcc_recipients ARRAY<STRUCT<email_address: STRING>>, "
    "importance STRING, categories ARRAY<STRING>, body STRING, "
    "has_attachments BOOLEAN, last_modified TIMESTAMP"
)
CALENDAR = (
    "id STRING, account STRING, calendar_name STRING, depth INT, subject STRING, "
    "type STRING, recurrence_pattern STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, "
    "start_date DATE, end_date DATE, location STRING, organizer STRING, "
    "required_attendees ARRAY<STRUCT<email_address: STRING>>, body STRING, "
    "has_attachments BOOLEAN, last_modified TIMESTAMP, last_modified_date DATE"
)
TASKS = (
    "id STRING, account STRING, subject STRING, status STRING, owner STRING, "
    "start_date DATE, due_date DATE, complete_date DATE, text_body STRING, "
    "companies ARRAY<STRING>, categories ARRAY<STRING>, importance STRING, "
    "has_attachments BOOLEAN, last_modified TIMESTAMP, last_modified_date DATE"
)
CONTACTS = (
    "id STRING, account STRING, item_class STRING, display_name STRING, "
    "company_name STRING, birthday DATE, email_addresses ARRAY<STRUCT<email: STRING>>, "
    "phone_numbers ARRAY<STRUCT<phone_number: STRING>>, "
    "last_modified TIMESTAMP, last_modified_date DATE"
)
ATTACHMENTS = (
    "attachment_id STRING, parent_id STRING, account STRING, object STRING, "
    "name STRING, content_type STRING, content BINARY, last_modified TIMESTAMP"
)
REGISTRY = "id STRING, parent_id STRING, type STRING, platform STRING, object STRING"
REGISTRY_KEYS = ["id", "parent_id", "type", "platform", "object"]
CHECKPOINTS = "platform STRING, object STRING, checkpoint STRING"
IDENTITIES = "identity STRING, permissions ARRAY<STRING>"
USER_MAPPING = "source STRING, target STRING"
RESPONSES = "id STRING, errors ARRAY<STRING>"

# What the index holds for each document.
DOCUMENTS = (
    "type STRING, id STRING, title STRING, body STRING, url STRING, "
    "created_at STRING, created STRING, _allow_permissions ARRAY<STRING>"
)
DOCUMENT_FIELDS = ["type", "id", "title", "body", "url", "created_at", "created", "_allow_permissions"]

# Declared index types of the searchable fields.
TARGET_FIELDS = {"title": "text", "type": "text", "body": "text", "url": "text", "created_at": "date"}
