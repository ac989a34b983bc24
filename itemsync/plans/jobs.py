"""The sync jobs. Plans return DataFrames; ``run_*`` writes them in a safe order.

A run writes the index first, sends the change to a remote index if there is
one, then writes the registry, then the checkpoint. A failure anywhere leaves the checkpoint where it was, and repeating the run with the same
commit number is harmless.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.functions.sizes import document_size, size_without_body
from itemsync.operators import acl, batching, checkpoints, quality, registry, shape
from itemsync.operators.attachments import Extractor, attachment_documents, attachment_rules
from itemsync.operators.dedup import distinct_computed, latest_computed
from itemsync.operators.joins import skew_join
from itemsync.operators.report import index_report, observed
from itemsync.operators.windows import change_window, chunk_index, off_bounds
from itemsync.options import JobOptions
from itemsync.schemas import (
    ATTACHMENTS,
    ATTACHMENT_TYPES,
    BATCH_SIZE,
    CHECKPOINTS,
    DAY_COLUMN,
    DOCUMENT_FIELDS,
    DOCUMENTS,
    IDENTITIES,
    MAX_REQUEST_CHARS,
    OBJECTS,
    REGISTRY,
    REGISTRY_KEYS,
    RFC3339_PY,
)
from itemsync.session import cut_lineage
from itemsync.sinks.keyed import UPSERT, KeyedTable
from itemsync.sinks.remote import Send, send_batches
from itemsync.sources.tables import scan

REQUEST = ["queue", "gather", "chunk", "batch"]
OVERSIZED = "oversized"
#: ``mark`` is the id, or a hash of the row where it has none.
ISSUES = "object STRING, mark STRING, kind STRING, id STRING, reason STRING"
REFUSED, QUARANTINED, MENDED, UNBODIED = "refused", "quarantined", "mended", "oversized"
INDEX_SCHEMA = DOCUMENTS + ", account STRING, object STRING, parent_id STRING, last_modified TIMESTAMP, has_attachments BOOLEAN, fault STRING"


@dataclass(frozen=True)
class Mailboxes:
    """Source tables. A table left out takes no part."""

    accounts: DataFrame
    mails: DataFrame | None = None
    calendar: DataFrame | None = None
    tasks: DataFrame | None = None
    contacts: DataFrame | None = None
    attachments: DataFrame | None = None

    def table(self, name: str) -> DataFrame | None:
        return getattr(self, name)


class SyncState:
    """The tables a target keeps: index, registry, permissions, checkpoints."""

    def __init__(self, spark: SparkSession, path: str):
        self.index = KeyedTable(spark, f"{path}/index", INDEX_SCHEMA, ["id"], ["last_modified"])
        self.registry = KeyedTable(spark, f"{path}/registry", REGISTRY, REGISTRY_KEYS)
        self.permissions = KeyedTable(spark, f"{path}/permissions", IDENTITIES, ["identity"])
        self.checkpoints = KeyedTable(spark, f"{path}/checkpoints", CHECKPOINTS, ["platform", "object"])
        self.issues = KeyedTable(spark, f"{path}/issues", ISSUES, ["object", "mark", "kind"], ["reason"])
        #: Attachments that arrived in a stream before their items.
        self.waiting = KeyedTable(spark, f"{path}/waiting", ATTACHMENTS, ["object", "attachment_id"], ["last_modified"])
        self.tables = (self.index, self.registry, self.permissions, self.checkpoints, self.issues, self.waiting)

    def create(self) -> None:
        for table in self.tables:
            table.create()

    def compact(self) -> None:
        """Fold the commits of every table into its base; any number of times, between runs."""
        for table in self.tables:
            table.compact()

    def next_commit(self) -> int:
        """A number that is free in every table."""
        return max(table.number(None, "") for table in self.tables)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def selected(sources: Mailboxes, options: JobOptions) -> list[str]:
    return [name for name in OBJECTS if name in options.objects and sources.table(name) is not None]


def day_of(table: DataFrame) -> str | None:
    return DAY_COLUMN if DAY_COLUMN in table.columns else None


def changed_items(
    name: str, sources: Mailboxes, options: JobOptions, start: datetime | None, end: datetime | None
) -> DataFrame:
    """Items of one object inside the window; all without a start. Items without an id are no documents."""
    table = scan(name, sources.table(name)).filter(F.col("id").isNotNull())
    if start is None:
        return table
    items = change_window(table, "last_modified", start, end, options.bounds, day_of(table))
    if options.bounds == "open":
        items = off_bounds(items, "last_modified", start, end, options.time_chunks)
    return items


def window_items(name: str, sources: Mailboxes, options: JobOptions, start: datetime, end: datetime) -> DataFrame:
    """Changed items of known accounts, with the time zone."""
    accounts = acl.accounts_on(sources.accounts, options.platform)
    return shape.with_account(changed_items(name, sources, options, start, end), accounts)


def object_documents(
    name: str,
    sources: Mailboxes,
    options: JobOptions,
    start: datetime | None,
    end: datetime | None,
    extractor: Extractor | None = None,
    dedup: bool = True,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Documents of one object: shaped items and the attachments they own.

    Whole-row copies are dropped; calendar rows keep theirs unless the options
    say otherwise. ``dedup=False`` leaves all of them to a later upsert by id,
    which saves shuffling the bodies twice. ``sized_by`` is a narrow table of as many
    rows as there are items, where one is stored.
    """
    changed = changed_items(name, sources, options, start, end)
    items = shape.with_account(changed, acl.accounts_on(sources.accounts, options.platform))
    if name == "mails":
        fields = shape.mail_fields(items)
    elif name == "calendar":
        fields = shape.calendar_fields(items)
    elif name == "tasks":
        fields = shape.task_fields(items, options.platform)
    else:
        fields = shape.contact_fields(items)
    documents = shape.to_documents(fields, options.permissions, options.objects[name])
    if options.unify_created:
        documents = documents.withColumn("created", F.lit(None).cast("string"))
    if name in ATTACHMENT_TYPES and sources.attachments is not None:
        documents = documents.unionByName(
            attachment_documents(
                items, sources.attachments, name, start, end, options, extractor, changed if sized_by is None else sized_by
            )
        )
    whole = options.dedup_calendar if name == "calendar" else True
    return distinct_computed(documents) if whole and dedup else documents


def full_sync(
    sources: Mailboxes, options: JobOptions, extractor: Extractor | None = None, dedup: bool = True
) -> DataFrame:
    """Documents of all objects from the configured start until now."""
    span = (options.start_time, options.now)
    return union_all(
        [object_documents(n, sources, options, *span, extractor, dedup) for n in selected(sources, options)]
    )


def incremental_windows(stored: DataFrame, options: JobOptions) -> dict[str, tuple[datetime, datetime]]:
    """Each object's window: a lookup of at most one row per object."""
    spark = stored.sparkSession
    wanted = spark.createDataFrame([(options.platform, name) for name in options.objects], "platform STRING, object STRING")
    rows = checkpoints.checkpoint_windows(wanted, stored, options).collect()
    return {r["object"]: tuple(datetime.strptime(r[c], RFC3339_PY) for c in ("start_time", "end_time")) for r in rows}


def incremental_sync(
    sources: Mailboxes,
    options: JobOptions,
    stored: DataFrame,
    extractor: Extractor | None = None,
    dedup: bool = True,
) -> DataFrame:
    """Documents changed since each object's checkpoint."""
    return windowed_sync(sources, options, incremental_windows(stored, options), extractor, dedup)


def windowed_sync(
    sources: Mailboxes,
    options: JobOptions,
    windows: dict[str, tuple[datetime, datetime]],
    extractor: Extractor | None = None,
    dedup: bool = True,
) -> DataFrame:
    return union_all(
        [object_documents(n, sources, options, *windows[n], extractor, dedup) for n in selected(sources, options)]
    )


def live_ids(
    sources: Mailboxes, options: JobOptions, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Ids that exist in the source: (object, id), from pruned scans without any shaping.

    Without bounds the whole history counts, so that old items do not look deleted.
    """
    frames = []
    accounts = acl.accounts_on(sources.accounts, options.platform).select("account").distinct()
    for name in selected(sources, options):
        items = scan(name, sources.table(name))
        if start is not None:
            items = change_window(items, "last_modified", start, end, options.bounds, day_of(items))
        owned = skew_join(items, accounts, "account", "left_semi", spread=F.col("id"), sized_by=sources.accounts)
        frames.append(owned.select(F.lit(name).alias("object"), F.col("id").cast("string").alias("id")))
        if name in ATTACHMENT_TYPES and sources.attachments is not None:
            parents = owned.filter("has_attachments").select(F.col("id").alias("parent_id"))
            children = sources.attachments.filter(F.col("object") == name)
            if start is not None:
                children = change_window(children, "last_modified", start, end, day=day_of(children))
            found = skew_join(
                children.select("parent_id", "attachment_id"),
                parents,
                "parent_id",
                "left_semi",
                spread=F.col("attachment_id"),
                sized_by=items.select("id"),
            )
            frames.append(found.select(F.lit(name).alias("object"), F.col("attachment_id").cast("string").alias("id")))
    return union_all(frames)


def require_scanned(accounts: DataFrame, scanned: DataFrame) -> None:
    """Refuse to go on where an account was not scanned: its items would look deleted."""
    missing = accounts.select("account").join(scanned.select("account"), "account", "left_anti")
    if not missing.isEmpty():
        raise RuntimeError("the live scan is incomplete; nothing was deleted")


def deletion_sync(
    sources: Mailboxes,
    stored: DataFrame,
    options: JobOptions,
    scan_window: tuple[datetime, datetime] | None = None,
    cascade: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Ids to delete and the registry that remains, for all selected objects in one plan."""
    considered = stored.filter(F.col("object").isin(*selected(sources, options)))
    if sources.attachments is None:
        # a table left out takes no part: its documents are neither live nor gone
        considered = considered.filter(~F.col("type").isin(*(label.lower() for label in ATTACHMENT_TYPES.values())))
    live = live_ids(sources, options, *(scan_window or (None, None)))
    scanned = [sources.table(name) for name in selected(sources, options)] + [sources.attachments]
    # stored tables, which are counted without reading rows
    live_rows = sum(table.count() for table in scanned if table is not None)
    gone = registry.deleted_ids(considered, live, options.platform, live_rows=live_rows)
    if cascade:
        gone = registry.cascade(considered, gone)
    return gone, registry.surviving(stored, gone, options.platform)


def permission_sync(
    accounts: DataFrame, identities: DataFrame, mapping: DataFrame, options: JobOptions
) -> tuple[DataFrame, DataFrame]:
    """Identities to revoke and permissions to grant."""
    if not options.permissions:
        raise ValueError("permission sync needs the permissions option")
    return acl.revoked_identities(identities, accounts), acl.granted_permissions(accounts, mapping)


def index_requests(
    documents: DataFrame,
    start: datetime,
    end: datetime,
    chunks: int,
    limit: int = MAX_REQUEST_CHARS,
    rows: int = BATCH_SIZE,
    unique: bool = False,
    drop_oversized: bool = False,
) -> DataFrame:
    """Documents grouped into requests for a remote index, for ``send_batches``.

    The body of a document above the limit stays, in a request of its own, unless
    ``drop_oversized``; ``oversized`` marks it either way.

    Of several documents with one id the latest is sent; ``unique`` says that
    there is one row per id already, as in a stored commit.
    A queue per object, a message per time chunk. Sizes are taken once, batches
    are formed from narrow rows, and bodies are joined back by id.
    """
    if not unique:
        documents = latest_computed(documents, ["id"], ["last_modified"])
    size = document_size()
    narrow = documents.select(
        F.col("object").alias("queue"),
        chunk_index(documents, "last_modified", start, end, chunks).alias("message"),
        "id",
        size.alias("size"),
        size_without_body(size, F.col("body")).alias("bare_size"),
    )
    placed = batching.consumer_batches(cut_lineage(narrow), "queue", "message", ["id"], limit, rows)
    met = documents.join(placed.withColumnRenamed("body_removed", OVERSIZED), "id")
    if drop_oversized:
        met = met.withColumn("body", F.when(~F.col(OVERSIZED), F.col("body")))
    else:
        # the marked rows leave the batch they were counted into without their body
        alone = F.when(F.col(OVERSIZED), -1 - F.col("ord")).otherwise(F.col("batch"))
        met = met.withColumn("batch", alone.cast("bigint"))
    return met.select(*DOCUMENT_FIELDS, *REQUEST, "ord", OVERSIZED)


@dataclass(frozen=True)
class Outcome:
    """What a run did: documents extracted, the report of a remote index, and the issues stored under its commit."""

    commit: int
    documents: int
    report: DataFrame | None
    issues: DataFrame


def quarantined(
    sources: Mailboxes, options: JobOptions, windows: dict[str, tuple[datetime, datetime]] | None = None
) -> DataFrame:
    """Items and attachments of selected objects that no run can place, with the reason.

    With ``windows`` only rows of each object's window are looked at; rows without a time are
    in none, so that a full sync lists them once and incremental runs need not read all history.
    """

    def listed(rows: DataFrame, name: str, rules: dict, key: str) -> DataFrame:
        if windows is not None:
            rows = change_window(rows, "last_modified", *windows[name], options.bounds, day_of(rows))
        known = F.col(key).cast("string")
        mark = F.coalesce(known, F.concat(F.lit("row "), F.hex(F.xxhash64(*rows.columns))))
        broken = quality.set_aside(rows.withColumn("mark", mark), rules)[1]
        return broken.select(F.lit(name).alias("object"), "mark", F.lit(QUARANTINED).alias("kind"), known.alias("id"), "reason")

    frames = []
    for name in selected(sources, options):
        frames.append(listed(scan(name, sources.table(name)), name, quality.item_rules(), "id"))
        if name in ATTACHMENT_TYPES and sources.attachments is not None:
            own = sources.attachments.filter(F.col("object") == name)
            frames.append(listed(own, name, attachment_rules(), "attachment_id"))
    return union_all(frames)


def send_changes(state: SyncState, commit: int, options: JobOptions, send: Send) -> tuple[DataFrame, DataFrame]:
    """Send what a commit wrote to the remote index: the report per type, and the issues.

    Requests are made from the stored rows and the answers are stored before
    they are counted, so nothing is sent for the sake of a count.
    """
    rows = state.index.changes(commit).filter(F.col("op") == UPSERT).drop("op")
    span = (options.start_time, options.now)
    requests = index_requests(rows, *span, options.time_chunks, unique=True, drop_oversized=options.drop_oversized)
    requests = cut_lineage(requests)
    responses = cut_lineage(send_batches(requests.drop(OVERSIZED), REQUEST, send, options.retries, "ord"))
    refused = responses.filter(F.size("errors") > 0).select("id", F.array_join("errors", ", ").alias("reason"))
    issues = rows.select("object", "id").join(refused, "id").select(
        "object", "id", F.lit(REFUSED).alias("kind"), "reason"
    )
    large = requests.filter(OVERSIZED).select(
        F.col("queue").alias("object"),
        "id",
        F.lit(UNBODIED).alias("kind"),
        F.lit("sent without body" if options.drop_oversized else "sent alone").alias("reason"),
    )
    return index_report(rows, responses), issues.unionByName(large)


def send_deletes(ids: DataFrame, options: JobOptions, send: Send) -> DataFrame:
    """Send ids to delete, so many per request; the stored answers."""
    batches = batching.delete_batches(ids.select("id").distinct())
    return cut_lineage(send_batches(batches, ["chunk"], send, options.retries, "ord"))


def _commit_documents(
    documents: DataFrame,
    sources: Mailboxes,
    state: SyncState,
    options: JobOptions,
    commit: int,
    mode: str,
    send: Send | None,
    windows: dict[str, tuple[datetime, datetime]] | None = None,
) -> Outcome:
    watched, seen = observed(documents, "documents")
    state.index.upsert(watched, commit, mode)
    # what was mended on the way is read back from what was written
    mended = state.index.changes(commit).filter((F.col("op") == UPSERT) & F.col("fault").isNotNull()).select(
        "object", F.col("id").alias("mark"), F.lit(MENDED).alias("kind"), "id", F.col("fault").alias("reason")
    )
    issues, report = quarantined(sources, options, windows).unionByName(mended), None
    if send is not None:
        report, refused = send_changes(state, commit, options, send)
        issues = issues.unionByName(refused.withColumn("mark", F.col("id")))
    state.issues.upsert(issues, commit, mode)
    found = state.issues.changes(commit).select("object", "id", "kind", "reason")
    # The registry reads back what was written; nothing is extracted twice. Refused documents stay out of it.
    sent = state.index.changes(commit)
    if send is not None:
        sent = sent.join(found.filter(F.col("kind") == REFUSED).select("object", "id"), ["object", "id"], "left_anti")
    written = registry.registry_rows(sent, options.platform)
    state.registry.upsert(registry.new_rows(state.registry.read(commit), written), commit, mode)
    stored = state.checkpoints.read(commit)
    spark = documents.sparkSession
    wanted = spark.createDataFrame(
        [(options.platform, name, OBJECTS.index(name)) for name in options.objects],
        "platform STRING, object STRING, place INT",
    )
    state.checkpoints.upsert(checkpoints.next_checkpoints(wanted, stored, options, mode, "place"), commit, mode)
    return Outcome(commit, seen.get["rows"], report, found)


def run_full_sync(
    sources: Mailboxes,
    options: JobOptions,
    state: SyncState,
    commit: int | None = None,
    extractor=None,
    send: Send | None = None,
) -> Outcome:
    """Apply a full sync. Without a number the next free commit is taken."""
    commit = state.next_commit() if commit is None else commit
    documents = full_sync(sources, options, extractor, dedup=False)
    return _commit_documents(documents, sources, state, options, commit, checkpoints.FULL, send)


def run_incremental_sync(
    sources: Mailboxes,
    options: JobOptions,
    state: SyncState,
    commit: int | None = None,
    extractor=None,
    send: Send | None = None,
) -> Outcome:
    """Apply an incremental sync. Without a number the next free commit is taken."""
    commit = state.next_commit() if commit is None else commit
    windows = incremental_windows(state.checkpoints.read(commit), options)
    documents = windowed_sync(sources, options, windows, extractor, dedup=False)
    return _commit_documents(documents, sources, state, options, commit, checkpoints.INCREMENTAL, send, windows)


def require_owners(state: SyncState, stored: DataFrame, accounts: DataFrame) -> None:
    """Refuse a scan without accounts, or without an account that owns indexed rows of the run."""
    if accounts.isEmpty():
        raise RuntimeError("the scan has no accounts; nothing was deleted")
    owned = state.index.read().select("object", "id", "account")
    owners = owned.join(stored.select("object", "id").distinct(), ["object", "id"], "left_semi").select("account").distinct()
    missing = owners.join(accounts.select("account").distinct(), "account", "left_anti")
    if not missing.isEmpty():
        raise RuntimeError("an account that owns indexed documents is not in the scan; nothing was deleted")


DELETION, PERMISSION = "deletion", "permission"


def run_deletion_sync(
    sources: Mailboxes,
    options: JobOptions,
    state: SyncState,
    commit: int | None = None,
    scan_window: tuple[datetime, datetime] | None = None,
    cascade: bool = False,
    scanned_accounts: DataFrame | None = None,
    send: Send | None = None,
    accounts_removed: bool = False,
) -> int:
    """Apply a deletion sync; returns the number of deleted ids.

    ``accounts_removed`` says that accounts missing from the scan are truly gone;
    without it their documents are never taken for deleted.
    """
    commit = state.next_commit() if commit is None else commit
    accounts = acl.accounts_on(sources.accounts, options.platform)
    if scanned_accounts is not None:
        require_scanned(accounts, scanned_accounts)
    stored = state.registry.read(commit)
    own = stored.filter(F.col("platform").contains(options.platform))
    if not accounts_removed:
        require_owners(state, own.filter(F.col("object").isin(*selected(sources, options))), accounts)
    gone = cut_lineage(deletion_sync(sources, stored, options, scan_window, cascade)[0])
    state.index.delete(gone, commit, DELETION)
    if send is not None:
        send_deletes(gone, options, send)
    state.registry.delete(own.join(gone, ["object", "id"], "left_semi"), commit, DELETION)
    return gone.count()


def run_permission_sync(
    directory: DataFrame, mapping: DataFrame, options: JobOptions, state: SyncState, commit: int | None = None
) -> int:
    """Revoke what the runs before granted and no account has now, then grant, as one commit; returns its number.

    Without a number every run takes the next free commit, so it sees all runs before it.
    """
    commit = state.permissions.number(commit, "" if commit is None else PERMISSION)
    accounts = acl.accounts_of(directory, options.platform)
    revoke, grant = permission_sync(accounts, state.permissions.read(commit), mapping, options)
    return state.permissions.change(grant, revoke, commit, PERMISSION)
