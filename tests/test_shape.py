import datetime as dt

from itemsync.operators import attachments, quality, shape
from itemsync.options import FieldRule, JobOptions
from itemsync.plans.jobs import Mailboxes, object_documents
from itemsync.schemas import ACCOUNTS, ATTACHMENTS, CALENDAR, CONTACTS, DOCUMENT_FIELDS, MAILS, TASKS

NOW = dt.datetime(2022, 5, 1)
DAY = dt.datetime(2022, 4, 11, 12, 0, 0)
SPAN = (dt.datetime(2022, 4, 1), dt.datetime(2022, 4, 21))
OWNER = "abc@xyz.com"


def accounts(spark, zone="UTC", platform="Office365"):
    return spark.createDataFrame([(OWNER, zone, platform)], ACCOUNTS)


def documents(spark, name, rows, schema, found=(), platform="Office365", zone="UTC", span=SPAN, **options):
    chosen = JobOptions(NOW, platform=platform, **options)
    sources = Mailboxes(
        accounts(spark, zone, platform),
        attachments=spark.createDataFrame(list(found), ATTACHMENTS),
        **{name: spark.createDataFrame(rows, schema)},
    )
    out = object_documents(name, sources, chosen, *span)
    return sorted((r.asDict() for r in out.select(*DOCUMENT_FIELDS).collect()), key=lambda r: r["id"])


def mail(**changes):
    row = {
        "id": "m1", "account": OWNER, "folder": "inbox", "subject": "Hi", "sender": "s@x",
        "to_recipients": [("a@x",), ("b@x",)], "cc_recipients": [], "bcc_recipients": None, "importance": "Normal",
        "categories": ["red", "blue"], "body": "<p>Hello</p>", "has_attachments": True, "last_modified": DAY,
    }
    row.update(changes)
    return tuple(row.values())


def attached(**changes):
    row = {
        "attachment_id": "x1", "parent_id": "m1", "account": OWNER, "object": "mails", "name": "f.txt",
        "content_type": "text/plain", "content": b"demo", "last_modified": DAY,
    }
    row.update(changes)
    return tuple(row.values())


def test_mail_and_attachment(spark):
    got = documents(spark, "mails", [mail()], MAILS, [attached()])
    indent = "\n" + " " * 28
    assert got == [
        {
            "type": "Inbox Mails", "id": "m1", "title": "Hi", "url": None, "created": None,
            "body": indent.join(
                ["Sender Email: s@x", "Receiver Email: a@x, b@x", "CC: ", "BCC: ", "Importance: Normal",
                 "Category: red, blue", "Body: Hello"]
            ),
            "created_at": "2022-04-11T12:00:00Z", "_allow_permissions": [OWNER],
        },
        {
            "type": "Mails Attachments", "id": "x1", "title": "f.txt", "url": None, "created": "2022-04-11T12:00:00Z",
            "body": "demo", "created_at": None, "_allow_permissions": [OWNER],
        },
    ]


def test_mail_with_missing_values(spark):
    row = mail(sender=None, to_recipients=[(None,)], importance=None, categories=None, body="", has_attachments=False)
    got = documents(spark, "mails", [row], MAILS, [attached()], permissions=False)
    assert len(got) == 1 and got[0]["_allow_permissions"] == []
    lines = [line.strip() for line in got[0]["body"].split("\n")]
    assert lines == ["Sender Email:", "Receiver Email:", "CC:", "BCC:", "Importance: None", "Category:", "Body: None"]


def test_folders_accounts_and_copies(spark):
    rows = [mail(), mail(), mail(id="m2", folder="drafts"), mail(id="m3", account="other@x"), mail(id="m4", folder="junk")]
    assert [(d["id"], d["type"]) for d in documents(spark, "mails", rows, MAILS)] == [("m1", "Inbox Mails"), ("m4", "Junk Mails")]


def test_item_and_attachment_windows(spark):
    start, end = SPAN
    stamps = {"a": start, "b": end, "c": start + dt.timedelta(seconds=1)}
    rows = [mail(id=i, last_modified=t) for i, t in stamps.items()]
    found = [attached(attachment_id=f"x{i}", parent_id="c", last_modified=t) for i, t in stamps.items()]
    found.append(attached(attachment_id="none", parent_id="c", last_modified=None))
    assert [d["id"] for d in documents(spark, "mails", rows, MAILS, found)] == ["a", "c", "xa", "xc"]
    assert [d["id"] for d in documents(spark, "mails", rows, MAILS, found, bounds="open")] == ["c", "xa", "xc"]
    table = spark.createDataFrame(found, ATTACHMENTS)
    assert [(r["attachment_id"], r["reason"]) for r in attachments.undated(table).collect()] == [("none", "no last_modified")]


def test_same_chunk(spark):
    bound = dt.datetime(2022, 4, 5)
    rows = [mail(id="m1", last_modified=dt.datetime(2022, 4, 2)), mail(id="m2", last_modified=bound)]
    found = [
        attached(attachment_id="same", last_modified=dt.datetime(2022, 4, 3)),
        attached(attachment_id="later", last_modified=bound),
        attached(attachment_id="bound", parent_id="m2", last_modified=bound),
    ]
    everything = documents(spark, "mails", rows, MAILS, found)
    assert [d["id"] for d in everything] == ["bound", "later", "m1", "m2", "same"]
    faithful = documents(spark, "mails", rows, MAILS, found, same_chunk=True)
    assert [d["id"] for d in faithful] == ["bound", "m1", "m2", "same"]
    assert [d["id"] for d in documents(spark, "mails", rows, MAILS, found, bounds="open", same_chunk=True)] == ["m1", "same"]


def test_local_time_and_unified_created(spark):
    got = documents(spark, "mails", [mail()], MAILS, [attached()], zone="Asia/Kolkata", unify_created=True)
    assert [(d["created_at"], d["created"]) for d in got] == [("2022-04-11T17:30:00Z", None)] * 2


def test_field_rules(spark):
    rule = {"mails": FieldRule(exclude_fields=("Description", "Id"))}
    got = documents(spark, "mails", [mail()], MAILS, objects=rule)[0]
    assert (got["id"], got["title"], got["body"]) == ("m1", "Hi", None)


EVENT = {
    "id": "e1", "account": OWNER, "calendar_name": "Calendar", "depth": 0, "subject": "Meet", "type": "RecurringMaster",
    "recurrence_pattern": "weekly", "start_ts": None, "end_ts": None, "start_date": dt.date(2022, 4, 12),
    "end_date": dt.date(2022, 4, 13), "location": "Room", "organizer": "o@x",
    "required_attendees": [("a@x",), (None,), ("",)], "body": "<b>demo</b>", "has_attachments": False,
    "last_modified": DAY, "last_modified_date": None,
}


def test_calendar_bodies(spark):
    rows = [
        tuple(EVENT.values()),
        tuple({**EVENT, "id": "e2", "calendar_name": "Folder (Birthdays)", "type": "Single"}.values()),
        tuple({**EVENT, "id": "e3", "depth": 2}.values()),
        tuple({**EVENT, "id": "e4", "start_ts": DAY, "organizer": None, "recurrence_pattern": None, "location": None}.values()),
        tuple({**EVENT, "id": "e1"}.values()),
    ]
    got = documents(spark, "calendar", rows, CALENDAR, zone="Asia/Kolkata")
    assert [d["id"] for d in got] == ["e1", "e1", "e2", "e4"]
    indent = "\n" + " " * 16
    assert got[0]["body"] == indent + indent.join(
        ["Start Date: 2022-04-12", "End Date: 2022-04-13", "Location: Room", "Organizer: o@x",
         "Meeting Type: Recurring weekly", "Attendee List: a@x", "Description: demo"]
    )
    assert got[2]["body"] == f"{indent}Date: 2022-04-12{indent}Organizer: o@x\n Meeting Type: Normal\n"
    assert "Start Date: 2022-04-11T17:30:00Z" in got[3]["body"] and "Recurring None" in got[3]["body"]
    assert len(documents(spark, "calendar", rows, CALENDAR, dedup_calendar=True)) == 3


def test_calendar_date_only_stamp(spark):
    items = spark.createDataFrame(
        [tuple({**EVENT, "last_modified": None, "last_modified_date": dt.date(2022, 4, 11)}.values())], CALENDAR
    )
    row = shape.calendar_fields(shape.with_account(items, accounts(spark))).first()
    assert row["created_at"] == "2022-04-11"


def test_quarantine(spark):
    rows = [EVENT, {**EVENT, "id": None}, {**EVENT, "id": "e2", "organizer": None, "recurrence_pattern": None}]
    events = spark.createDataFrame([tuple(r.values()) for r in rows], CALENDAR)
    sound, broken = quality.set_aside(events, quality.event_rules())
    assert [r["id"] for r in sound.collect()] == ["e1"]
    assert sorted(r["reason"] for r in broken.collect()) == ["no id", "no organizer, no recurrence"]


TASK = {
    "id": "t1", "account": OWNER, "subject": "Do", "status": "Open", "owner": None, "start_date": dt.date(2022, 4, 12),
    "due_date": dt.date(2022, 4, 11), "complete_date": dt.date(2022, 4, 16), "text_body": "text",
    "companies": ["one", "two"], "categories": ["red", "blue"], "importance": "High", "has_attachments": False,
    "last_modified": DAY, "last_modified_date": None,
}


def test_task_bodies(spark):
    rows = [tuple(TASK.values())]
    indent = "\n" + " " * 16
    head = ["Due Date: 2022-04-11", "Status: Open", "Owner: None"]
    on_prem = [*head, "Start Date: 2022-04-12", "Complete Date: 2022-04-16", "Body: text", "Companies: one",
               "Categories: red, blue", "Importance: High"]
    cloud = [*head, "Complete Date: 2022-04-16", "Body: text", "Categories: red, blue", "Importance: High"]
    for platform, lines in (("Microsoft Exchange", on_prem), ("Office365", cloud)):
        got = documents(spark, "tasks", rows, TASKS, platform=platform)
        assert got[0]["body"] == indent + indent.join(lines)


def test_contacts(spark):
    contact = {
        "id": "c1", "account": OWNER, "item_class": "Contact", "display_name": "N", "company_name": "Co",
        "birthday": None, "email_addresses": [("e@x",)], "phone_numbers": [("1",), ("2",)], "last_modified": DAY,
        "last_modified_date": None,
    }
    rows = [
        tuple(contact.values()),
        tuple({**contact, "id": "c2", "item_class": "DistributionList"}.values()),
        tuple({**contact, "id": "c3", "birthday": dt.date(1604, 5, 6), "company_name": None}.values()),
    ]
    got = documents(spark, "contacts", rows, CONTACTS)
    assert [d["id"] for d in got] == ["c1", "c3"]
    indent = "\n" + " " * 28
    lines = ["Email Addresses: e@x", "Company Name: Co", "Contact Numbers: 1, 2", "Date of Birth: None"]
    assert got[0]["body"] == indent.join(lines)
    assert got[1]["body"].endswith("Date of Birth: 05-06") and "Company Name: None" in got[1]["body"]


def test_attachment_text(spark):
    rows = [
        attached(attachment_id="html", content_type="text/html", content=b"<p>a &amp; b</p>"),
        attached(attachment_id="csv", content_type="text/csv", content="é,1".encode()),
        attached(attachment_id="bad", content_type="application/json", content=b"a\xffb"),
        attached(attachment_id="pdf", content_type="application/pdf", content=b"%PDF"),
        attached(attachment_id="none", content=None),
    ]
    table = spark.createDataFrame(rows, ATTACHMENTS)
    native = {r["attachment_id"]: r["body"] for r in attachments.with_text(table).collect()}
    assert native == {"html": "a & b", "csv": "é,1", "bad": "a�b", "pdf": None, "none": None}
    parse = attachments.fill_body(lambda content, media: f"{media}:{len(content)}")
    parsed = {r["attachment_id"]: r["body"] for r in attachments.with_text(table, parse).collect()}
    assert parsed == {**native, "pdf": "application/pdf:4"}
    plan = attachments.with_text(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan
