"""Every operator as a query over the test tables."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.functions import sizes, text, times
from itemsync.operators import acl, attachments, batching, checkpoints, dedup, quality, registry, report, shape, windows
from itemsync.options import FieldRule, JobOptions
from itemsync.plans import bindings as b
from itemsync.plans import jobs
from itemsync.plans.jobs import Mailboxes
from itemsync.schemas import ATTACHMENT_TYPES, PLATFORM_CLOUD, PLATFORM_ON_PREM
from itemsync.session import cut_lineage, work_dir
from itemsync.sinks.keyed import KeyedTable, removed, upserted
from itemsync.sources import mapping, tables
from itemsync.streaming.incremental import (
    document_shape,
    item_stream,
    sync_attachments,
    sync_available,
    sync_documents,
    sync_items,
)

NOW = datetime(2024, 1, 25)
# Windows of the order-dated and of the January tables.
ORDER_START, ORDER_END = datetime(1997, 1, 1), datetime(1999, 7, 1)
JANUARY_START, JANUARY_END = datetime(2024, 1, 5), datetime(2024, 1, 25)
CHUNKS = 5
BYTE_LIMIT = 20_000
GATHER_LIMIT = 60_000


def options(**changes) -> JobOptions:
    return JobOptions(**{"now": NOW, "start_time": ORDER_START, "end_time": JANUARY_END, **changes})


def stamp(column: str | Column) -> Column:
    return times.rfc3339(F.col(column) if isinstance(column, str) else column)


def joined(column: str | Column) -> Column:
    return F.array_join(F.array_sort(column), ",")


def shown(documents: DataFrame) -> DataFrame:
    """Document rows with the access list as one text."""
    return documents.select(
        "type", "id", "title", "body", "created_at", "created", joined("_allow_permissions").alias("allow")
    )


# --- windows -----------------------------------------------------------------


def item_window_open(spark, folder):
    items = windows.change_window(b.table(spark, folder, "orders"), "o_orderdate", ORDER_START, ORDER_END, "open")
    return items.select("o_orderkey", "o_custkey", stamp("o_orderdate").alias("modified"))


def attachment_window_half_open(spark, folder):
    rows = windows.change_window(b.table(spark, folder, "lineitem"), "l_shipdate", ORDER_START, ORDER_END)
    return rows.select("l_orderkey", "l_linenumber", stamp("l_shipdate").alias("modified"))


def date_chunks(spark, folder):
    spans = b.table(spark, folder, "events").groupBy("user_id").agg(
        F.date_trunc("second", F.min("ts")).alias("start"), F.date_trunc("second", F.max("ts")).alias("end")
    )
    return windows.split_ranges(spans, "start", "end", CHUNKS).select(
        "user_id", "chunk", stamp("chunk_start").alias("chunk_start"), stamp("chunk_end").alias("chunk_end")
    )


def items_per_chunk(spark, folder):
    items = windows.change_window(b.table(spark, folder, "events"), "ts", JANUARY_START, JANUARY_END)
    chunk = windows.chunk_index(items, "ts", JANUARY_START, JANUARY_END, CHUNKS)
    return items.groupBy("event_type", chunk.alias("chunk")).agg(F.count("*").alias("items"))


# --- scans -------------------------------------------------------------------


def folder_labels(spark, folder):
    mails = tables.mail_items(b.mails(spark, folder))
    return mails.select("id", "folder", shape.folder_type(F.col("folder")).alias("type"))


def calendar_main_and_children(spark, folder):
    return tables.calendar_items(b.calendar(spark, folder)).select("id", "calendar_name", "depth")


def task_scan(spark, folder):
    return tables.scan("tasks", b.tasks(spark, folder)).select("id", "account", "subject", stamp("last_modified").alias("modified"))


def contact_class_filter(spark, folder):
    return tables.contact_items(b.contacts(spark, folder)).select("id", "display_name")


def directory_accounts(spark, folder):
    return acl.directory_accounts(acl.directory_users(b.directory(spark, folder)))


def cloud_accounts(spark, folder):
    return acl.cloud_accounts(acl.cloud_users(b.directory(spark, folder)))


def platform_accounts(spark, folder):
    found = b.accounts(spark, folder)
    return found.filter(acl.on_platform(F.col("platform"), PLATFORM_ON_PREM)).select("account", "timezone")


def user_mapping(spark, folder):
    """Orders as lines of a mapping: the last line of each user wins."""
    lines = b.table(spark, folder, "orders").select(
        b.user(F.col("o_custkey")).alias("source"), b.prefixed("target", F.col("o_orderkey")).alias("target"), "o_orderkey"
    )
    return mapping.last_mapping(lines, "source", "target", ["o_orderkey"])


# --- documents ---------------------------------------------------------------


def account_items_local_time(spark, folder):
    items = b.calendar(spark, folder).select("id", "account", "last_modified")
    local = times.local_text(F.col("last_modified"), F.col("timezone"))
    return shape.with_account(items, b.accounts(spark, folder)).select(
        "id", "account", local.alias("local"), times.date_part(local).alias("day")
    )


def _shaped(spark, folder, name, fields, start=JANUARY_START, end=JANUARY_END, permissions=True):
    sources = Mailboxes(b.accounts(spark, folder), **{name: b.ITEMS[name](spark, folder)})
    items = jobs.window_items(name, sources, options(), start, end)
    return shown(shape.to_documents(fields(items), permissions))


def quarantined_events(spark, folder):
    """Events that lack an organizer or their recurrence, with the reasons."""
    return quality.set_aside(b.calendar(spark, folder), quality.event_rules())[1].select("id", "reason")


def mail_documents(spark, folder):
    return _shaped(spark, folder, "mails", shape.mail_fields)


def calendar_documents(spark, folder):
    return _shaped(spark, folder, "calendar", shape.calendar_fields)


def task_documents(spark, folder):
    """The bodies of both platforms, with and without start date and companies, each for its own accounts."""
    sources = Mailboxes(b.accounts(spark, folder), tasks=b.tasks(spark, folder))
    parts = []
    for platform in (PLATFORM_ON_PREM, PLATFORM_CLOUD):
        items = jobs.window_items("tasks", sources, options(platform=platform), ORDER_START, ORDER_END)
        documents = shape.to_documents(shape.task_fields(items, platform), True)
        parts.append(shown(documents).withColumn("platform", F.lit(platform)))
    return parts[0].unionByName(parts[1])


def contact_documents(spark, folder):
    return _shaped(spark, folder, "contacts", shape.contact_fields, permissions=False)


def html_body_text(spark, folder):
    return b.table(spark, folder, "pages").select("page_id", text.html_to_text(F.col("html")).alias("body"))


def attachment_text(spark, folder):
    return attachments.with_text(b.attachments(spark, folder)).select("attachment_id", "body")


def attachment_charsets(spark, folder):
    """Texts as attachments of several charsets, some stated by a mark or inside the page, some unknown, some broken."""
    data, ascii_form = F.col("text").cast("binary"), F.hex("text").cast("binary")
    kinds = [
        (F.concat(F.unhex(F.lit("EFBBBF")), data), "text/plain; charset=koi8-r"),
        (F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE")), "text/plain"),
        (F.concat(F.encode("text", "UTF-16BE"), F.unhex(F.lit("41"))), "text/plain; charset=utf-16be"),
        (F.concat(ascii_form, F.unhex(F.lit("F0F2"))), 'text/plain; charset="KOI8-R"'),
        (F.concat(ascii_form, F.unhex(F.lit("B0A1"))), "text/plain;charset=gb2312"),
        (F.concat(ascii_form, F.unhex(F.lit("E9"))), "text/plain; charset=us-ascii"),
        (F.concat(F.lit('<meta charset="iso-8859-15"><p>').cast("binary"), ascii_form, F.unhex(F.lit("A4"))), "text/html"),
        (data, "text/plain; charset=x-unheard-of"),
        (F.concat(ascii_form, F.unhex(F.lit("FF"))), "text/plain"),
    ]
    content, stated = F.lit(None).cast("binary"), F.lit(None).cast("string")
    for n, (made, media) in enumerate(kinds):
        content = F.when(F.col("doc_id") % len(kinds) == n, made).otherwise(content)
        stated = F.when(F.col("doc_id") % len(kinds) == n, F.lit(media)).otherwise(stated)
    made = b.table(spark, folder, "documents").select("doc_id", content.alias("content"), stated.alias("content_type"))
    return attachments.with_text(made).select("doc_id", "body", "fault")


def encoded_names(spark, folder):
    urls = b.table(spark, folder, "pages").select("url")
    names = b.table(spark, folder, "part").select(F.concat("p_name", F.lit(" 'n' / "), "p_type", F.lit("~*")).alias("url"))
    return urls.unionByName(names).select("url", text.encode_name(F.col("url")).alias("encoded"))


def parsed_rfc3339(spark, folder):
    raw = F.when(b.every("event_id", 7), "").when(b.every("event_id", 11), F.col("ts").cast("string")).otherwise(stamp("ts"))
    strict = b.every("event_id", 7) | b.every("event_id", 11)
    return b.table(spark, folder, "events").select(
        "event_id",
        F.coalesce(F.unix_timestamp(times.try_parse_rfc3339(raw)), F.lit(-1)).alias("tried"),
        F.coalesce(F.unix_timestamp(F.when(~strict, times.parse_rfc3339(raw))), F.lit(-1)).alias("parsed"),
    )


def field_projection(spark, folder):
    sources = Mailboxes(b.accounts(spark, folder), mails=b.mails(spark, folder))
    items = jobs.window_items("mails", sources, options(), JANUARY_START, JANUARY_END)
    rules = {
        "all": None,
        "include": FieldRule(include_fields=("DisplayName", "Created"), exclude_fields=("Created",)),
        "exclude": FieldRule(exclude_fields=("Id", "Description")),
    }
    parts = [
        shown(shape.to_documents(shape.mail_fields(items), True, rule)).withColumn("rule", F.lit(name))
        for name, rule in rules.items()
    ]
    return jobs.union_all(parts)


def item_attachments(spark, folder):
    """Items and the attachments they own, tagged with their reader."""
    sources = b.mailboxes(spark, folder, ["tasks"])
    return shown(jobs.object_documents("tasks", sources, options(), ORDER_START, ORDER_END)).drop("body")


def item_attachments_same_chunk(spark, folder):
    sources = b.mailboxes(spark, folder, ["tasks"])
    chosen = options(same_chunk=True, time_chunks=CHUNKS)
    return shown(jobs.object_documents("tasks", sources, chosen, ORDER_START, ORDER_END)).drop("body")


# --- dedup, registry, access lists -------------------------------------------


def dedup_documents(spark, folder):
    return dedup.distinct_rows(b.table(spark, folder, "documents").select("text", "lang", "n_chars"))


def latest_by_id(spark, folder):
    events = b.table(spark, folder, "events").select("user_id", "event_type", "event_id", "ts", "props")
    latest = dedup.latest_by_id(events, ["user_id", "event_type"], ["ts", "event_id"])
    return latest.select("user_id", "event_type", "event_id", "props", stamp("ts").alias("ts"))


def _labelled(spark, folder) -> DataFrame:
    """Registry rows of the labelled documents, partly known, partly not, some twice."""
    labels = b.table(spark, folder, "labels")
    rows = labels.select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("").alias("parent_id"),
        F.when(F.col("quality") == 1, "en").otherwise("zz").alias("type"),
        F.when(b.every("doc_id", 3), PLATFORM_ON_PREM).otherwise(PLATFORM_CLOUD).alias("platform"),
        F.lit("mails").alias("object"),
    )
    return rows.unionByName(rows.filter(F.col("type") == "zz"))


def registry_merge(spark, folder):
    return registry.merge_registry(b.registry(spark, folder), _labelled(spark, folder))


def registry_state(spark, folder):
    return registry.loaded_state(b.registry(spark, folder)).select("id", "type", "platform", "state")


def _live(spark, folder) -> DataFrame:
    labels = b.table(spark, folder, "labels")
    return labels.select(F.lit("mails").alias("object"), F.col("doc_id").cast("string").alias("id"))


def deleted_ids(spark, folder):
    return registry.deleted_ids(b.registry(spark, folder), _live(spark, folder), PLATFORM_CLOUD)


def registry_after_delete(spark, folder):
    stored = b.registry(spark, folder)
    gone = registry.deleted_ids(stored, _live(spark, folder), PLATFORM_CLOUD)
    return registry.surviving(stored, gone, PLATFORM_CLOUD).select("id", "type", "platform", "object")


def revoked_identities(spark, folder):
    gone = acl.revoked_identities(b.identities(spark, folder), b.live_accounts(spark, folder))
    return gone.select("identity", joined("permissions").alias("permissions"))


def _mapping(spark, folder) -> DataFrame:
    lines = b.table(spark, folder, "supplier").select(
        b.user(F.col("s_suppkey") * 3).alias("source"), F.col("s_name").alias("target"), "s_suppkey"
    )
    return mapping.last_mapping(lines, "source", "target", ["s_suppkey"])


def granted_permissions(spark, folder):
    grants = acl.granted_permissions(b.accounts(spark, folder), _mapping(spark, folder))
    return grants.select("identity", joined("permissions").alias("permissions"))


# --- batches and reports -----------------------------------------------------


def _slot(column: str) -> Column:
    """Pieces by key, in place of a hash, so that plain SQL can follow."""
    return F.pmod(F.col(column), F.lit(4096))


def round_robin_buckets(spark, folder):
    parts = b.table(spark, folder, "part").select("p_partkey")
    return batching.round_robin_buckets(parts, 7, ["p_partkey"], slot=_slot("p_partkey"))


def fixed_chunks(spark, folder):
    items = b.table(spark, folder, "documents").select("doc_id", "source")
    return batching.fixed_chunks(items, 10, ["doc_id"], within=["source"], slot=_slot("doc_id"))


def delete_batches(spark, folder):
    ids = b.table(spark, folder, "orders").select("o_orderkey")
    return batching.delete_batches(ids, "o_orderkey", slot=_slot("o_orderkey"))


def _printed_size() -> Column:
    return sizes.record_size({"lang": F.col("lang"), "source": F.col("source"), "body": F.col("text")})


def document_sizes(spark, folder):
    size = _printed_size()
    return b.table(spark, folder, "documents").select(
        "doc_id", size.alias("size"), sizes.size_without_body(size, F.col("text")).alias("bare_size")
    )


def byte_batches(spark, folder):
    chunks = batching.fixed_chunks(document_sizes(spark, folder), 100, ["doc_id"], slot=_slot("doc_id"))
    return batching.byte_batches(chunks, BYTE_LIMIT, keep=["doc_id"])


def consumer_batches(spark, folder):
    """Queues by language, messages by source. Texts are read once; what is used twice is narrow."""
    size = _printed_size()
    narrow = b.table(spark, folder, "documents").select(
        "doc_id", "lang", "source", size.alias("size"), sizes.size_without_body(size, F.col("text")).alias("bare_size")
    )
    narrow = cut_lineage(narrow)
    return batching.consumer_batches(
        narrow, "lang", "source", ["doc_id"], limit=GATHER_LIMIT, rows=20, slot=_slot("doc_id")
    )


def ids_by_type(spark, folder):
    events = b.table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("type"))
    batches = batching.fixed_chunks(events, 100, ["id"], slot=_slot("id"))
    listed = report.ids_by_type(batches, ["chunk"])
    return listed.select("chunk", "type", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


def _responses(spark, folder) -> DataFrame:
    """Labelled documents answered; those of low quality with an error, some twice."""
    bad = F.when(F.col("quality") == 0, F.array(F.lit("rejected"))).otherwise(F.array().cast("array<string>"))
    answers = b.table(spark, folder, "labels").select(F.col("doc_id").alias("id"), bad.alias("errors"), "toxic")
    return answers.unionByName(answers.filter("toxic = 1")).drop("toxic")


def index_report(spark, folder):
    documents = b.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("type"))
    return report.index_report(documents, _responses(spark, folder))


def failed_per_batch(spark, folder):
    batches = b.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("batch"))
    return report.failed_per_batch(batches, _responses(spark, folder), ["batch"])


def job_counts(spark, folder):
    """Items and attachments per object and type of one run."""
    documents = full_sync(spark, folder).select("object", "type")
    return documents.groupBy("object", "type").agg(F.count("*").alias("documents"))


# --- sinks and state ---------------------------------------------------------


def _named(spark, folder) -> tuple[DataFrame, DataFrame]:
    target = b.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    rows = b.table(spark, folder, "supplier").select((F.col("s_suppkey") * 20).alias("id"), F.col("s_name").alias("name"))
    return target, rows


def _leaving(spark, folder) -> DataFrame:
    orders = b.table(spark, folder, "orders").filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return orders.select(F.col("o_custkey").alias("id"))


def upsert_snapshot(spark, folder):
    target, rows = _named(spark, folder)
    return upserted(target, rows, ["id"])


def delete_snapshot(spark, folder):
    target, _ = _named(spark, folder)
    return removed(target, _leaving(spark, folder), ["id"])


def permission_snapshot(spark, folder):
    """Stored permissions after revoking and granting."""
    stored, live = b.identities(spark, folder), b.live_accounts(spark, folder)
    left = removed(stored, acl.revoked_identities(stored, live), ["identity"])
    after = upserted(left, acl.granted_permissions(b.accounts(spark, folder), _mapping(spark, folder)), ["identity"])
    return after.select("identity", joined("permissions").alias("permissions"))


def keyed_table(spark, folder):
    """Commits to a stored table, two compactions and a batch that comes again behind them, then its current rows."""
    target, rows = _named(spark, folder)
    table = KeyedTable(spark, f"{work_dir(spark)}/{uuid.uuid4()}", "id BIGINT, name STRING", ["id"])
    table.create()
    table.upsert(target, writer="stream#0")
    table.compact()
    table.upsert(rows, writer="stream#1")
    table.compact()
    table.upsert(target, writer="stream#0")
    table.upsert(rows, writer="stream#1")
    table.delete(_leaving(spark, folder))
    return table.read()


def permission_runs(spark, folder):
    """Stored permissions after three runs: live accounts, all accounts, live ones again, with a compaction between."""
    state = jobs.SyncState(spark, f"{work_dir(spark)}/{uuid.uuid4()}")
    state.create()
    state.permissions.upsert(b.identities(spark, folder))
    everyone = b.table(spark, folder, "customer").select(b.user(F.col("c_custkey")).alias("mail"), "c_acctbal")
    live, users = everyone.filter("c_acctbal > 5000"), _mapping(spark, folder)
    jobs.run_permission_sync(live, users, options(), state)
    state.compact()
    jobs.run_permission_sync(everyone, users, options(), state)
    jobs.run_permission_sync(live, users, options(), state)
    return state.permissions.read().select("identity", joined("permissions").alias("permissions"))


def _checkpoints(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Users as platforms, event types as objects; rare users and one type have nothing stored."""
    events = b.table(spark, folder, "events").withColumn("platform", F.col("user_id").cast("string"))
    wanted = events.select("platform", F.col("event_type").alias("object")).distinct()
    known = events.filter((F.col("event_type") != "signup") & ~b.every("user_id", 5))
    stored = known.groupBy("platform", F.col("event_type").alias("object")).agg(stamp(F.max("ts")).alias("checkpoint"))
    return wanted, stored


def checkpoint_windows(spark, folder):
    return checkpoints.checkpoint_windows(*_checkpoints(spark, folder), options())


def next_checkpoints(spark, folder):
    wanted, stored = _checkpoints(spark, folder)
    chosen = options(end_time=JANUARY_START, reference_rules=True)
    parts = [
        checkpoints.next_checkpoints(wanted, stored, chosen, mode).withColumn("mode", F.lit(mode))
        for mode in (checkpoints.INCREMENTAL, checkpoints.FULL)
    ]
    return parts[0].unionByName(parts[1])


# --- jobs --------------------------------------------------------------------


def full_sync(spark, folder):
    return jobs.full_sync(b.mailboxes(spark, folder), options())


def full_sync_docs(spark, folder):
    return shown(full_sync(spark, folder))


def incremental_sync_docs(spark, folder):
    """Every object resumes from the newest change its stored documents show."""
    sources = b.mailboxes(spark, folder)
    done = [
        sources.table(name).filter(F.col("last_modified") < F.lit(limit).cast("timestamp")).select(
            F.lit(PLATFORM_CLOUD).alias("platform"), F.lit(name).alias("object"), F.col("last_modified").cast("timestamp")
        )
        for name, limit in (("mails", "2024-01-12"), ("calendar", "2024-01-15"), ("tasks", "2001-01-01"))
    ]
    stored = jobs.union_all(done).groupBy("platform", "object").agg(stamp(F.max("last_modified")).alias("checkpoint"))
    return shown(jobs.incremental_sync(sources, options(), stored))


def _known_items(spark, folder) -> DataFrame:
    """A registry that holds every item and attachment of the tables, with and without a known account."""
    return jobs.union_all(
        [
            b.ITEMS[name](spark, folder).select(
                "id",
                F.lit("").alias("parent_id"),
                F.lit(name).alias("type"),
                F.lit(PLATFORM_CLOUD).alias("platform"),
                F.lit(name).alias("object"),
            )
            for name in b.ITEMS
        ]
        + [
            b.ATTACHMENTS[name](spark, folder).select(
                F.col("attachment_id").alias("id"),
                "parent_id",
                F.lit(ATTACHMENT_TYPES[name].lower()).alias("type"),
                F.lit(PLATFORM_CLOUD).alias("platform"),
                F.lit(name).alias("object"),
            )
            for name in b.ATTACHMENTS
        ]
    )


def deletion_sync_plan(spark, folder):
    sources = b.mailboxes(spark, folder)
    return jobs.deletion_sync(sources, _known_items(spark, folder), options(), (ORDER_START, NOW))[0]


def permission_sync_plan(spark, folder):
    revoke, grant = jobs.permission_sync(
        b.live_accounts(spark, folder), b.identities(spark, folder), _mapping(spark, folder), options()
    )
    tagged = revoke.withColumn("action", F.lit("revoke")).unionByName(grant.withColumn("action", F.lit("grant")))
    return tagged.select("action", "identity", joined("permissions").alias("permissions"))


def incremental_stream(spark, folder):
    """New event files as a stream of items, shaped and applied batch by batch, none of them cut by a window."""
    place = f"{work_dir(spark)}/{uuid.uuid4()}"
    schema = b.table(spark, folder, "events").schema
    state = KeyedTable(spark, f"{place}/index", "id BIGINT, title STRING, created_at STRING", ["id"], ["created_at"])
    state.create()

    def shaped(batch: DataFrame) -> DataFrame:
        return batch.select(F.col("event_id").alias("id"), F.col("event_type").alias("title"), stamp("ts").alias("created_at"))

    arriving = item_stream(spark, folder, schema, pathGlobFilter="events.parquet")
    sync_available(arriving, shaped, state, f"{place}/checkpoint")
    return state.read()


def stream_documents(spark, folder):
    """Mails that arrive in several files and two runs, over an index that holds a full sync of some of them."""
    place = f"{work_dir(spark)}/{uuid.uuid4()}"
    state = jobs.SyncState(spark, f"{place}/state")
    state.create()
    texts = b.table(spark, folder, "documents")
    sources = Mailboxes(b.accounts(spark, folder), attachments=b.mail_attachments(spark, folder))
    jobs.run_full_sync(replace(sources, mails=b.mails_of(texts.filter("doc_id % 4 = 0"))), options(), state)
    into = document_shape("mails", sources, options())
    for part in (F.col("doc_id") % 3 < 2, F.col("doc_id") % 3 == 2):
        texts.filter(part).write.mode("append").parquet(f"{place}/arriving")
        arriving = item_stream(spark, f"{place}/arriving", texts.schema, files_per_batch=2)
        sync_documents(arriving, lambda batch: into(b.mails_of(batch)), state, options(), f"{place}/checkpoint")
    found = state.registry.read().select("object", "id", F.lit(True).alias("registered")).distinct()
    known = state.index.read().join(found, ["object", "id"], "left")
    return known.select(
        "type", "id", "title", "body", "created_at", "created", joined("_allow_permissions").alias("allow"), "registered"
    )


def stream_attachments(spark, folder):
    """Attachments that arrive before and after their mails, which arrive in two runs."""
    place = f"{work_dir(spark)}/{uuid.uuid4()}"
    state = jobs.SyncState(spark, f"{place}/state")
    state.create()
    mails, found = b.table(spark, folder, "documents"), b.mail_attachments(spark, folder)
    found = found.withColumn("account", F.lit(None).cast("string"))
    sources = Mailboxes(b.accounts(spark, folder))
    odd = F.pmod(F.xxhash64("attachment_id"), F.lit(2)) == 1
    for part, early in ((F.col("doc_id") % 3 < 2, odd), (F.col("doc_id") % 3 == 2, ~odd)):
        found.filter(early).write.mode("append").parquet(f"{place}/attachments")
        arriving = item_stream(spark, f"{place}/attachments", found.schema)
        sync_attachments(arriving, "mails", sources, state, options(), f"{place}/checkpoint/attachments")
        b.mails_of(mails.filter(part)).write.mode("append").parquet(f"{place}/mails")
        arriving = item_stream(spark, f"{place}/mails", b.mails_of(mails).schema)
        sync_items(arriving, "mails", sources, state, options(), f"{place}/checkpoint/mails")
    known = state.index.read().join(
        state.registry.read().select("object", "id", F.lit(True).alias("registered")).distinct(), ["object", "id"], "left"
    )
    return known.select(
        "type", "id", "title", "body", "created_at", "created", joined("_allow_permissions").alias("allow"), "registered"
    )


def object_selection(spark, folder):
    """Of all tables, only the objects that the options name take part."""
    chosen = options(objects={"tasks": FieldRule(), "contacts": FieldRule()})
    documents = jobs.full_sync(b.mailboxes(spark, folder), chosen).select("object", "type")
    return documents.groupBy("object", "type").agg(F.count("*").alias("documents"))


def _mapping_lines(spark, folder) -> str:
    """A mapping file with a line an order, in their order: some short, some without a target, some too long."""
    place = f"{work_dir(spark)}/{uuid.uuid4()}/mapping"
    source, target = b.user(F.col("o_custkey")), b.prefixed("target", F.col("o_orderkey"))
    line = (
        F.when(b.every("o_orderkey", 7), source)
        .when(b.every("o_orderkey", 11), F.concat(source, F.lit(",")))
        .when(b.every("o_orderkey", 13), F.concat_ws(",", source, target, F.lit("more")))
        .otherwise(F.concat_ws(",", source, target))
    )
    orders = b.table(spark, folder, "orders").select("o_orderkey", line.alias("value")).orderBy("o_orderkey")
    orders.select("value").write.text(place)
    return place


def mapping_file(spark, folder):
    """The user mapping read from a file of a line an order; the last sound line of a user wins."""
    return mapping.read_mapping(spark, _mapping_lines(spark, folder))


def mapping_broken_lines(spark, folder):
    """Lines of the mapping file that map nobody, with the reason."""
    return mapping.broken_lines(spark, _mapping_lines(spark, folder))


def run_outcome(spark, folder):
    """A run over rows without id or time and accounts of unknown zones, sent to an index that refuses some documents.

    Its issues, registry, report and checkpoint.
    """
    place = f"{work_dir(spark)}/{uuid.uuid4()}"
    state = jobs.SyncState(spark, place)
    state.create()
    undated = F.when(~b.every("id_number", 50), F.col("last_modified"))
    found = b.contacts(spark, folder).withColumn("id_number", F.substring("id", 2, 20).cast("bigint"))
    nameless = b.every("id_number", 51) & ~b.every("id_number", 50)
    found = found.withColumn("last_modified", undated).withColumn("id", F.when(~nameless, F.col("id"))).drop("id_number")
    number = F.regexp_extract("account", r"([0-9]+)", 1).cast("bigint")
    owners = b.accounts(spark, folder)
    owners = owners.withColumn("timezone", F.when(number % 6 == 2, F.lit("Mars/Olympus")).otherwise(F.col("timezone")))
    chosen = options(objects={"contacts": FieldRule()})
    outcome = jobs.run_full_sync(Mailboxes(owners, contacts=found), chosen, state, send=_refuse_sevens)
    none = F.lit("")
    registered = state.registry.read().select("object", "id", F.lit("registered").alias("kind"), none.alias("reason"))
    told = outcome.report.select(
        F.lit("contacts").alias("object"), F.col("type").alias("id"), F.lit("report").alias("kind"), F.col("summary").alias("reason")
    )
    reached = state.checkpoints.read().select(
        "object", F.col("platform").alias("id"), F.lit("checkpoint").alias("kind"), F.col("checkpoint").alias("reason")
    )
    return outcome.issues.unionByName(registered).unionByName(told).unionByName(reached)


def _refuse_sevens(rows: list[dict]) -> list[dict]:
    """A stand-in for a remote index."""
    return [{"id": row["id"], "errors": ["no 7s"] if row["id"].endswith("7") else []} for row in rows]


QUERIES = {
    query.__name__: query
    for query in (
        item_window_open,
        attachment_window_half_open,
        date_chunks,
        items_per_chunk,
        folder_labels,
        calendar_main_and_children,
        task_scan,
        contact_class_filter,
        directory_accounts,
        cloud_accounts,
        platform_accounts,
        user_mapping,
        account_items_local_time,
        quarantined_events,
        mail_documents,
        calendar_documents,
        task_documents,
        contact_documents,
        html_body_text,
        attachment_text,
        attachment_charsets,
        encoded_names,
        parsed_rfc3339,
        field_projection,
        item_attachments,
        item_attachments_same_chunk,
        dedup_documents,
        latest_by_id,
        registry_merge,
        registry_state,
        deleted_ids,
        registry_after_delete,
        revoked_identities,
        granted_permissions,
        round_robin_buckets,
        fixed_chunks,
        delete_batches,
        document_sizes,
        byte_batches,
        consumer_batches,
        ids_by_type,
        index_report,
        failed_per_batch,
        job_counts,
        upsert_snapshot,
        delete_snapshot,
        permission_snapshot,
        permission_runs,
        keyed_table,
        checkpoint_windows,
        next_checkpoints,
        full_sync_docs,
        incremental_sync_docs,
        deletion_sync_plan,
        permission_sync_plan,
        incremental_stream,
        stream_documents,
        stream_attachments,
        object_selection,
        mapping_file,
        mapping_broken_lines,
        run_outcome,
    )
}
