"""Incremental sync as Structured Streaming jobs.

What arrives is applied whole: no window cuts it, as the file source counts a file
as read whatever becomes of its rows. Each micro-batch is one commit of the table,
which keeps the stream's name and the batch number as the commit's writer; a batch
repeated after a failure gets its own number again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.operators import acl, registry, shape
from itemsync.operators.attachments import Extractor, attachment_documents
from itemsync.options import JobOptions
from itemsync.plans.jobs import Mailboxes, SyncState, object_documents
from itemsync.session import cut_lineage, kept
from itemsync.sinks.keyed import UPSERT, KeyedTable

Shape = Callable[[DataFrame], DataFrame]


def item_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000, **options) -> DataFrame:
    """New files of a folder as a stream; the stream's own checkpoint remembers what was read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**options).parquet(path)


def document_shape(name: str, sources: Mailboxes, options: JobOptions) -> Shape:
    """How arriving items of one object become documents, with the attachments that are there already.

    Ids and accounts of a batch are stored first, narrow, and only the accounts among them take
    part, so that a batch meets tables of any size without shuffling them.
    """

    def run(batch: DataFrame) -> DataFrame:
        narrow = kept(batch.select("id", "account"), "arrived")
        owners = sources.accounts.join(narrow.select("account").distinct(), "account", "left_semi")
        met = replace(sources, accounts=kept(owners, "owners"), **{name: batch})
        return object_documents(name, met, options, None, None, dedup=False, sized_by=narrow)

    return run


def attachment_shape(
    name: str, state: SyncState, sources: Mailboxes, options: JobOptions, extractor: Extractor | None = None
) -> Shape:
    """How attachments that arrive after their items become documents: they meet the items in the index.

    For attachments that may come before their items see ``sync_attachments``.
    """

    def run(batch: DataFrame) -> DataFrame:
        stored = state.index.read().filter((F.col("object") == name) & (F.coalesce("parent_id", F.lit("")) == ""))
        parents = stored.select("id", "account", "last_modified", F.coalesce("has_attachments", F.lit(True)).alias("has_attachments"))
        items = shape.with_account(parents, acl.accounts_on(sources.accounts, options.platform))
        return attachment_documents(items, batch, name, None, None, options, extractor)

    return run


def _each_batch(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, str], None]) -> None:
    """Hand over everything that has arrived, batch by batch with its writer's name, then stop."""
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: apply(batch, f"{checkpoint}#{number}"))
        .start()
    )
    query.awaitTermination()


def sync_available(items: DataFrame, shape: Shape, table: KeyedTable, checkpoint: str) -> None:
    """Upsert everything that has arrived into one table."""
    _each_batch(items, checkpoint, lambda batch, writer: table.upsert(shape(batch), writer=writer))


def sync_documents(items: DataFrame, shape: Shape, state: SyncState, options: JobOptions, checkpoint: str) -> None:
    """Upsert everything that has arrived into the index, and register it."""

    def apply(batch: DataFrame, writer: str) -> None:
        _register(state, options, state.index.upsert(shape(batch), writer=writer), writer)

    _each_batch(items, checkpoint, apply)


def _parents(name: str, state: SyncState, of: DataFrame) -> DataFrame:
    """Indexed items of one object that own one of the attachments: a narrow scan, cut by the ids that are asked for."""
    stored = state.index.read().filter((F.col("object") == name) & (F.coalesce("parent_id", F.lit("")) == ""))
    narrow = stored.select("id", "account", "last_modified", F.coalesce("has_attachments", F.lit(True)).alias("has_attachments"))
    asked = of.select(F.col("parent_id").cast("string").alias("id")).distinct()
    return narrow.join(asked, "id", "left_semi")


def _register(state: SyncState, options: JobOptions, commit: int, writer: str) -> None:
    changed = state.index.changes(commit).filter(F.col("op") == UPSERT)
    number = state.registry.number(None, writer)
    rows = registry.registry_rows(changed, options.platform)
    state.registry.upsert(registry.new_rows(state.registry.read(number, rows), rows), number, writer)


def sync_attachments(
    stream: DataFrame,
    name: str,
    sources: Mailboxes,
    state: SyncState,
    options: JobOptions,
    checkpoint: str,
    extractor: Extractor | None = None,
) -> None:
    """Index attachments as they arrive; those whose item is not there yet wait in ``state.waiting``.

    Of both orders of arrival the outcome is the same, if items arrive by ``sync_items``. The
    waiting attachments are stored last, so a batch that breaks off is repeated whole.
    """

    def apply(batch: DataFrame, writer: str) -> None:
        mine = batch.filter((F.col("object") == name) & F.col("attachment_id").isNotNull())
        items = cut_lineage(_parents(name, state, mine))
        owned = shape.with_account(items, acl.accounts_on(sources.accounts, options.platform))
        commit = state.index.upsert(attachment_documents(owned, mine, name, None, None, options, extractor), writer=writer)
        _register(state, options, commit, writer)
        known = items.select(F.col("id").alias("parent_id"))
        early = mine.withColumn("parent_id", F.col("parent_id").cast("string")).join(known, "parent_id", "left_anti")
        state.waiting.upsert(early, writer=writer)

    _each_batch(stream, checkpoint, apply)


def sync_items(
    stream: DataFrame, name: str, sources: Mailboxes, state: SyncState, options: JobOptions, checkpoint: str
) -> None:
    """Index items as they arrive, together with the attachments that wait for them."""

    def apply(batch: DataFrame, writer: str) -> None:
        number = state.waiting.number(None, writer)
        waiting = state.waiting.read(before=number).filter(F.col("object") == name)
        met = replace(sources, **{name: batch, "attachments": waiting})
        commit = state.index.upsert(object_documents(name, met, options, None, None, dedup=False), writer=writer)
        _register(state, options, commit, writer)
        done = state.index.changes(commit).filter((F.col("op") == UPSERT) & (F.col("parent_id") != ""))
        state.waiting.delete(done.select("object", F.col("id").alias("attachment_id")), number, writer)

    _each_batch(stream, checkpoint, apply)


def delete_available(keys: DataFrame, table: KeyedTable, checkpoint: str) -> None:
    """Apply a stream of deleted keys in the same manner."""
    _each_batch(keys, checkpoint, lambda batch, writer: table.delete(batch, writer=writer))
