import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from itemsync.options import JobOptions
from itemsync.plans import jobs
from itemsync.plans.jobs import Mailboxes, SyncState
from itemsync.schemas import ACCOUNTS, ATTACHMENTS, CONTACTS, MAILS, RFC3339_PY, TARGET_FIELDS
from itemsync.operators.attachments import fill_body
from itemsync.sinks.keyed import KeyedTable
from itemsync.sinks.remote import send_batches, with_retry
from itemsync.streaming.incremental import (
    attachment_shape,
    delete_available,
    document_shape,
    item_stream,
    sync_attachments,
    sync_available,
    sync_documents,
    sync_items,
)
from tests.test_shape import OWNER, attached, mail

NOW = dt.datetime(2024, 2, 1)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def boxes(spark, mails, found=()):
    return Mailboxes(
        spark.createDataFrame([(OWNER, "UTC", "Office365")], ACCOUNTS),
        mails=spark.createDataFrame(mails, MAILS),
        contacts=spark.createDataFrame([], CONTACTS),
        attachments=spark.createDataFrame(list(found), ATTACHMENTS),
    )


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def checkpoint(state, name):
    return {r["object"]: r["checkpoint"] for r in state.checkpoints.read().collect()}.get(name)


def test_keyed_table(spark, folder):
    table = KeyedTable(spark, folder + "/t", "id INT, v STRING, t INT", ["id"], ["t"])
    table.create()
    assert table.read().count() == 0
    rows = lambda data: spark.createDataFrame(data, "id int, v string, t int")
    table.upsert(rows([(1, "a", 1), (1, "b", 2), (2, "c", 1)]), 1)
    table.upsert(rows([(2, "d", 0), (3, "e", 1)]), 2)
    table.delete(rows([(3, None, None), (9, None, None)]), 3)
    expected = [(1, "b", 2), (2, "d", 0)]
    assert sorted(map(tuple, table.read().collect())) == expected
    table.create()
    table.compact(4)
    assert sorted(map(tuple, table.read().collect())) == expected
    table.upsert(rows([(3, "f", 1)]), 5)
    assert sorted(map(tuple, table.read().collect())) == [*expected, (3, "f", 1)]
    assert sorted(map(tuple, table.read(before=5).collect())) == expected
    table.upsert(rows([(3, "g", 1)]), 5)
    assert sorted(map(tuple, table.read().collect())) == [*expected, (3, "g", 1)]
    # A commit that broke off before its mark is not seen.
    rows([(7, "x", 1)]).withColumn("op", F.lit("upsert")).write.parquet(folder + "/t/changes/commit=6/attempt=a")
    assert 7 not in [r["id"] for r in table.read().collect()]


def test_commit_numbers_are_the_tables_own(spark, folder):
    table = KeyedTable(spark, folder + "/t", "id INT, v STRING", ["id"])
    table.create()
    rows = lambda data: spark.createDataFrame(data, "id int, v string")
    assert table.upsert(rows([(1, "a")]), writer="job") == 1
    assert table.upsert(rows([(2, "b")]), writer="stream#0") == 2
    assert table.upsert(rows([(2, "c")]), writer="stream#0") == 2  # the batch is repeated
    with pytest.raises(ValueError):
        table.upsert(rows([(9, "x")]), 1, writer="stream#1")  # another writer's number
    table.compact(50)
    for number in (2, 50):  # at or below the base
        with pytest.raises(ValueError):
            table.upsert(rows([(9, "x")]), number, writer="late")
    assert table.upsert(rows([(3, "d")])) == 51
    with pytest.raises(ValueError):
        table.upsert(rows([(9, "x")]), 49)
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert table.change(rows([(1, "z")]), rows([(1, None), (3, None)])) == 52
    assert sorted(map(tuple, table.read().collect())) == [(1, "z"), (2, "c")]


def test_a_read_is_one_scan_of_all_commits(spark, folder):
    table = KeyedTable(spark, folder + "/t", "id INT, v STRING", ["id"])
    table.create()
    scans = []
    for n in range(4):
        table.upsert(spark.createDataFrame([(n, f"v{n}"), (9, f"v{n}"), (None, f"v{n}")], "id int, v string"))
        scans.append(table.read()._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
    assert scans == [scans[0]] * 4
    table.delete(spark.createDataFrame([(1,)], "id int"))
    asked = spark.createDataFrame([(0,), (1,), (9,), (9,), (None,), (77,)], "id int")
    assert sorted(map(str, table.read(keys=asked).collect())) == sorted(
        str(r) for r in table.read().collect() if r["id"] in (0, 9, None)
    )
    assert table.read(before=3, keys=asked).filter("id = 9").first()["v"] == "v1"


def test_state_survives_compactions_and_replays(spark, folder):
    table = KeyedTable(spark, folder + "/t", "id INT, v STRING", ["id"])
    table.create()
    rows = lambda data: spark.createDataFrame(data, "id int, v string")
    current = lambda: sorted(map(tuple, table.read().collect()))
    assert table.upsert(rows([(1, "a"), (2, "a")]), writer="stream#0") == 1
    assert [table.compact(), table.compact()] == [2, 3]
    assert table.upsert(rows([(2, "b")]), writer="stream#1") == 4
    assert table.compact() == 5
    # the stream's batches come again: they are in a base, so nothing is computed or written
    never = rows([(9, "x")]).withColumn("v", F.raise_error(F.lit("computed")).cast("string"))
    assert table.upsert(never, writer="stream#1") == 4 and table.upsert(never, writer="stream#0") == 1
    assert table.upsert(never, 4, writer="stream#1") == 4
    assert current() == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        table.upsert(rows([(9, "x")]), 4, writer="another")
    assert table.upsert(rows([(3, "c")]), writer="stream#2") == 6
    assert current() == [(1, "a"), (2, "b"), (3, "c")] and sorted(map(tuple, table.read(before=6).collect())) == [(1, "a"), (2, "b")]


def test_permission_runs_see_each_other(spark, folder):
    state = SyncState(spark, folder)
    state.create()
    mapping = spark.createDataFrame([("y@x", "why")], "source string, target string")
    run = lambda *mails: jobs.run_permission_sync(
        spark.createDataFrame([(m,) for m in mails], "mail string"), mapping, JobOptions(NOW), state
    )
    granted = lambda: {r["identity"]: r["permissions"] for r in state.permissions.read().collect()}
    first = run("x@x", "y@x")
    assert granted() == {"x@x": ["x@x"], "why": ["y@x"]}
    second = run("x@x", "z@x")
    assert second > first and granted() == {"x@x": ["x@x"], "z@x": ["z@x"]}
    gone = state.permissions.changes(second).filter("op = 'delete'")
    assert [r["identity"] for r in gone.collect()] == ["why"]
    state.compact()
    third = run("z@x")
    assert third > second and granted() == {"z@x": ["z@x"]}


def test_no_row_ends_a_run(spark, folder):
    """Unknown zones, broken bytes, a parser that raises and rows without ids are listed; all others are indexed."""
    state = SyncState(spark, folder)
    state.create()
    mails = [
        mail(id="a", last_modified=at(2)),
        mail(id="far", account="far@x", last_modified=at(3)),
        mail(id=None, last_modified=at(3)),
        mail(id=None, subject="other", last_modified=at(3)),
    ]
    pieces = [("bad", b"\xe9\x81", "text/plain; charset=us-ascii"), ("odd", b"abc", "text/plain; charset=utf-16le"),
              ("strange", b"ok", "text/plain; charset=no-such"), ("pdf", b"x", "application/pdf")]
    found = [attached(attachment_id=i, parent_id="a", content=c, content_type=m, last_modified=at(2)) for i, c, m in pieces]
    sources = boxes(spark, mails, found)
    owners = spark.createDataFrame([("far@x", "Mars/Olympus", "Office365")], ACCOUNTS)
    sources = replace(sources, accounts=sources.accounts.unionByName(owners))

    def parse(content, media):
        raise RuntimeError("broken file")

    outcome = jobs.run_full_sync(sources, JobOptions(NOW, start_time=at(1)), state, extractor=fill_body(parse))
    issues = sorted((r["id"] or "", r["kind"], r["reason"]) for r in outcome.issues.collect())
    assert issues == [
        ("", "quarantined", "no id"),
        ("", "quarantined", "no id"),
        ("bad", "mended", "undecodable bytes replaced"),
        ("far", "mended", "unknown time zone, shown in the default one"),
        ("odd", "mended", "undecodable bytes replaced"),
        ("pdf", "mended", "extractor: RuntimeError"),
        ("strange", "mended", "unknown charset, read as UTF-8"),
    ]
    assert ids(state.index.read()) == ["a", "bad", "far", "odd", "pdf", "strange"]
    texts = {r["id"]: r["body"] for r in state.index.read().collect()}
    assert texts["strange"] == "ok" and texts["bad"].startswith("é") and texts["pdf"] is None
    # an incremental run looks only at its window
    later = jobs.run_incremental_sync(sources, JobOptions(NOW, start_time=at(1)), state)
    assert later.issues.count() == 0


def test_a_repeat_that_breaks_off_keeps_what_was_done(spark, folder):
    table = KeyedTable(spark, folder + "/t", "id INT, v STRING", ["id"])
    table.create()
    good = spark.createDataFrame([(n, "a") for n in range(5)], "id int, v string")
    table.upsert(good, 1)
    with pytest.raises(Exception):
        table.upsert(good.withColumn("v", F.raise_error(F.lit("down")).cast("string")), 1)
    assert table.read().count() == 5


def test_full_incremental_and_deletion(spark, folder):
    state = SyncState(spark, folder)
    state.create()
    options = JobOptions(at(20), start_time=at(1))
    first = [mail(id="a", last_modified=at(2)), mail(id="b", last_modified=at(3)), mail(id="old", last_modified=at(1) - dt.timedelta(9))]
    found = [attached(attachment_id="x", parent_id="a", last_modified=at(2))]
    assert jobs.run_full_sync(boxes(spark, first, found), options, state, 1) .documents == 3
    assert ids(state.index.read()) == ["a", "b", "x"]
    registered = {(r["id"], r["parent_id"], r["type"]) for r in state.registry.read().collect()}
    assert registered == {("a", "", "inbox mails"), ("b", "", "inbox mails"), ("x", "a", "mails attachments")}
    assert checkpoint(state, "mails") == at(20).strftime(RFC3339_PY)

    # A later run reads on from the checkpoint; running it twice changes nothing.
    later = JobOptions(NOW, start_time=at(1))
    second = boxes(spark, [*first, mail(id="b", subject="new", last_modified=at(21)), mail(id="c", last_modified=at(22))], found)
    for _ in range(2):
        jobs.run_incremental_sync(second, later, state, 2)
        assert ids(state.index.read()) == ["a", "b", "c", "x"]
        assert state.index.read().filter("id = 'b'").first()["title"] == "new"
        assert state.registry.read().count() == 4
        assert checkpoint(state, "mails") == NOW.strftime(RFC3339_PY)

    # Mail a and its attachment vanish.
    gone = [mail(id="b", last_modified=at(21)), mail(id="c", last_modified=at(22))]
    without = boxes(spark, gone)
    assert ids(jobs.deletion_sync(replace(without, attachments=None), state.registry.read(), later)[0]) == ["a"]
    left = boxes(spark, gone)
    for _ in range(2):
        assert jobs.run_deletion_sync(left, later, state, 3) == 2
        assert ids(state.index.read()) == ["b", "c"] and ids(state.registry.read()) == ["b", "c"]


def test_deletion_window_and_guard(spark, folder):
    state = SyncState(spark, folder)
    state.create()
    options = JobOptions(NOW, start_time=at(1))
    mails = boxes(spark, [mail(id="a", last_modified=at(2)), mail(id="b", last_modified=at(10))])
    jobs.run_full_sync(mails, options, state, 1)
    with pytest.raises(RuntimeError):
        jobs.run_deletion_sync(mails, options, state, 2, scanned_accounts=spark.createDataFrame([], ACCOUNTS))
    nobody = replace(mails, accounts=spark.createDataFrame([], ACCOUNTS))
    other = replace(mails, accounts=spark.createDataFrame([("other@x", "UTC", "Office365")], ACCOUNTS))
    for partial in (nobody, other):
        with pytest.raises(RuntimeError):
            jobs.run_deletion_sync(partial, options, state, 2)
    gone, left = jobs.deletion_sync(mails, state.registry.read(), options)
    assert ids(gone) == [] and ids(left) == ["a", "b"]
    gone, left = jobs.deletion_sync(mails, state.registry.read(), options, (at(5), NOW))
    assert ids(gone) == ["a"] and ids(left) == ["b"]


def test_failed_run_keeps_the_checkpoint(spark, folder):
    state = SyncState(spark, folder)
    state.create()
    options = JobOptions(NOW, start_time=at(1))
    broken = boxes(spark, [mail(last_modified=at(2))], [attached(content_type="application/pdf", last_modified=at(2))])

    def fail(batches):
        raise ValueError("no text")
        yield

    with pytest.raises(Exception, match="no text"):
        jobs.run_full_sync(broken, options, state, 1, extractor=fail)
    assert state.index.read().count() == 0 and checkpoint(state, "mails") is None
    jobs.run_full_sync(broken, options, state, 1)
    assert ids(state.index.read()) == ["m1", "x1"]


def test_object_selection(spark):
    options = JobOptions(NOW, start_time=at(1), objects={})
    assert jobs.selected(boxes(spark, []), options) == []
    options = JobOptions(NOW, start_time=at(1))
    assert jobs.selected(boxes(spark, []), options) == ["mails", "contacts"]


def test_permission_sync(spark, folder):
    state = SyncState(spark, folder)
    state.create()
    state.permissions.upsert(
        spark.createDataFrame([("user1", ["a@x"]), ("gone", ["z@x"]), ("empty", [])], "identity string, permissions array<string>"), 1
    )
    directory = spark.createDataFrame([("a@x",), ("b@x",)], "mail string")
    mapping = spark.createDataFrame([("b@x", "bee")], "source string, target string")
    options = JobOptions(NOW)
    for _ in range(2):
        jobs.run_permission_sync(directory, mapping, options, state, 2)
        got = {r["identity"]: r["permissions"] for r in state.permissions.read().collect()}
        assert got == {"user1": ["a@x"], "a@x": ["a@x"], "bee": ["b@x"]}
    with pytest.raises(ValueError):
        jobs.permission_sync(directory, directory, mapping, JobOptions(NOW, permissions=False))


def test_target_fields():
    assert TARGET_FIELDS == {"title": "text", "type": "text", "body": "text", "url": "text", "created_at": "date"}


def test_stream_reads_each_file_once(spark, folder):
    schema = "id LONG, v STRING"
    seen = []

    def shape(batch):
        seen.append(batch.count())
        return batch

    table = KeyedTable(spark, folder + "/index", schema, ["id"])
    table.create()

    def step(rows):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        sync_available(item_stream(spark, folder + "/in", schema), shape, table, folder + "/checkpoint")
        return sorted(map(tuple, table.read().collect()))

    assert step([(n, "a") for n in range(50)]) == [(n, "a") for n in range(50)]
    assert step([(n, "b") for n in range(45, 52)]) == [(n, "b" if n >= 45 else "a") for n in range(52)]
    step([])
    assert seen == [50, 7]


def test_send_batches(spark, folder):
    docs = spark.range(250).select(
        F.col("id").cast("string").alias("id"), F.floor(F.col("id") / 100).alias("chunk"), F.lit(0).alias("batch")
    )

    def send(rows):
        with open(f"{folder}/{rows[0]['id']}", "w") as out:
            out.write(str(len(rows)))
        return [{"id": r["id"], "errors": ["bad"] if r["id"] == "7" else []} for r in rows]

    got = send_batches(docs, ["chunk", "batch"], send).collect()
    assert len(got) == 250 and [r["id"] for r in got if r["errors"]] == ["7"]
    import os

    assert sorted(int(open(f"{folder}/{f}").read()) for f in os.listdir(folder)) == [50, 100, 100]


def test_index_requests(spark, folder):
    mails = [mail(id=f"m{n}", body="x" * (n % 7) * 40, last_modified=at(2 + n % 20)) for n in range(230)]
    options = JobOptions(NOW, start_time=at(1))
    documents = jobs.full_sync(boxes(spark, mails), options)
    requests = jobs.index_requests(documents, at(1), NOW, 5, limit=6000)
    rows = requests.collect()
    assert sorted(r["id"] for r in rows) == sorted(m[0] for m in mails)
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[c] for c in jobs.REQUEST), []).append(r["id"])
    assert max(map(len, groups.values())) <= 100
    sent = []

    def send(batch):
        printed = [{k: v for k, v in d.items() if v is not None or k == "body"} for d in batch]
        assert sum(len(str(d)) for d in printed) < 6000
        return [{"id": d["id"], "errors": []} for d in batch]

    sent = send_batches(requests.drop("oversized"), jobs.REQUEST, send, order="ord").collect()
    assert len(sent) == 230
    small = jobs.index_requests(documents, at(1), NOW, 5, limit=100, drop_oversized=True)
    assert small.filter("body IS NOT NULL").count() == 0 and small.count() == 230
    # whole bodies, each oversized document in a request of its own
    whole = jobs.index_requests(documents, at(1), NOW, 5, limit=100)
    assert whole.filter("body IS NULL").count() == 0 and whole.filter("oversized").count() == 230
    assert whole.select(*jobs.REQUEST).distinct().count() == 230


def test_requests_hold_each_id_once(spark):
    copies = [mail(id="a", subject=t, last_modified=at(d)) for t, d in (("x", 2), ("y", 3), ("y", 3))]
    options = JobOptions(NOW, start_time=at(1))
    documents = jobs.full_sync(boxes(spark, copies), options, dedup=False)
    rows = jobs.index_requests(documents, at(1), NOW, 5).collect()
    assert [(r["id"], r["title"]) for r in rows] == [("a", "y")]


def test_remote_runs(spark, folder):
    import os

    state = SyncState(spark, folder + "/state")
    state.create()
    os.makedirs(folder + "/sent")

    def send(rows):
        for row in rows:
            with open(f"{folder}/sent/{row['id']}", "a") as out:
                out.write("body" if "body" in row else "delete")
        return [{"id": row["id"], "errors": []} for row in rows]

    options = JobOptions(NOW, start_time=at(1))
    full = boxes(spark, [mail(id="a", last_modified=at(2)), mail(id="b", last_modified=at(3))])
    assert jobs.run_full_sync(full, options, state, 1, send=send).documents == 2
    report, issues = jobs.send_changes(state, 1, options, lambda rows: [{"id": r["id"], "errors": ["no"]} for r in rows])
    assert [tuple(r) for r in report.collect()] == [("Inbox Mails", 2, 2, 0, "0 out of 2")]
    assert sorted(map(tuple, issues.collect())) == [("mails", "a", "refused", "no"), ("mails", "b", "refused", "no")]
    left = boxes(spark, [mail(id="b", last_modified=at(3))])
    assert jobs.run_deletion_sync(left, options, state, 2, send=send) == 1
    assert {f: open(f"{folder}/sent/{f}").read() for f in os.listdir(folder + "/sent")} == {"a": "bodydelete", "b": "body"}

    def down(rows):
        raise OSError("down")

    with pytest.raises(Exception, match="down"):
        jobs.run_full_sync(full, JobOptions(NOW, start_time=at(1), retries=1), state, 3, send=down)
    assert ids(state.registry.read()) == ["b"]


def test_streams_over_a_full_sync(spark, folder):
    state = SyncState(spark, folder + "/state")
    state.create()
    options = JobOptions(NOW, start_time=at(1))
    found = [attached(attachment_id="x", parent_id="a", last_modified=at(2))]
    sources = boxes(spark, [mail(id="kept", last_modified=at(2))], found)
    jobs.run_full_sync(sources, options, state)
    later = NOW + dt.timedelta(days=9)  # after the run's end, and long before its start: nothing is windowed away
    steps = [
        ([mail(id="a", last_modified=at(2)), mail(id="a", last_modified=at(2))], ["a", "kept", "x"]),
        ([mail(id="b", last_modified=later), mail(id="c", last_modified=dt.datetime(2001, 1, 1))], ["a", "b", "c", "kept", "x"]),
    ]
    for rows, expected in steps:
        spark.createDataFrame(rows, MAILS).write.mode("append").parquet(folder + "/mails")
        stream = item_stream(spark, folder + "/mails", MAILS)
        sync_documents(stream, document_shape("mails", sources, options), state, options, folder + "/checkpoint")
        assert ids(state.index.read()) == expected == ids(state.registry.read())
    # an attachment that comes after its mail, and one of an unknown mail
    late = [attached(attachment_id=n, parent_id=p, last_modified=later) for n, p in (("y", "b"), ("z", "nowhere"))]
    spark.createDataFrame(late, ATTACHMENTS).write.parquet(folder + "/attachments")
    stream = item_stream(spark, folder + "/attachments", ATTACHMENTS)
    sync_documents(stream, attachment_shape("mails", state, sources, options), state, options, folder + "/checkpoint2")
    assert ids(state.index.read()) == ["a", "b", "c", "kept", "x", "y"] == ids(state.registry.read())
    assert state.index.read().filter("id = 'y'").first()["_allow_permissions"] == [OWNER]
    spark.createDataFrame([("a",)], "id string").write.parquet(folder + "/gone")
    delete_available(item_stream(spark, folder + "/gone", "id STRING"), state.index, folder + "/checkpoint3")
    assert ids(state.index.read()) == ["b", "c", "kept", "x", "y"]


@pytest.mark.parametrize("early", [True, False])
def test_attachments_in_either_order(spark, folder, early):
    state = SyncState(spark, folder + "/state")
    state.create()
    options, sources = JobOptions(NOW, start_time=at(1)), boxes(spark, [])
    mails = [mail(id="a", last_modified=at(2)), mail(id="none", has_attachments=False, last_modified=at(2))]
    found = [attached(attachment_id=i, parent_id=p, last_modified=at(3)) for i, p in (("x", "a"), ("y", "none"), ("z", "never"))]

    def items():
        spark.createDataFrame(mails, MAILS).write.mode("append").parquet(folder + "/mails")
        sync_items(item_stream(spark, folder + "/mails", MAILS), "mails", sources, state, options, folder + "/c1")

    def attachments():
        spark.createDataFrame(found, ATTACHMENTS).write.mode("append").parquet(folder + "/found")
        sync_attachments(item_stream(spark, folder + "/found", ATTACHMENTS), "mails", sources, state, options, folder + "/c2")

    for step in (attachments, items) if early else (items, attachments):
        step()
    assert ids(state.index.read()) == ids(state.registry.read()) == ["a", "none", "x"]
    waiting = sorted(r["attachment_id"] for r in state.waiting.read().collect())
    assert waiting == (["y", "z"] if early else ["z"])
    # arriving again changes nothing
    attachments()
    assert ids(state.index.read()) == ["a", "none", "x"]


def test_platforms_are_kept_apart(spark, folder):
    state = SyncState(spark, folder)
    state.create()
    options = JobOptions(NOW, start_time=at(1))
    both = boxes(spark, [mail(id="a", last_modified=at(2)), mail(id="p", account="prem@x", last_modified=at(3))])
    both = replace(both, accounts=both.accounts.unionByName(spark.createDataFrame([("prem@x", "UTC", "Microsoft Exchange")], ACCOUNTS)))
    jobs.run_full_sync(both, options, state)
    assert ids(state.index.read()) == ["a"]
    jobs.run_full_sync(both, replace(options, platform="Microsoft Exchange"), state)
    assert ids(state.index.read()) == ["a", "p"]
    assert {(r["id"], r["platform"]) for r in state.registry.read().collect()} == {("a", "Office365"), ("p", "Microsoft Exchange")}
    assert jobs.run_deletion_sync(both, options, state) == 0


def test_outcome_keeps_refused_and_undated(spark, folder):
    state = SyncState(spark, folder)
    state.create()
    options = JobOptions(NOW, start_time=at(1))
    mails = [mail(id="a", last_modified=at(2)), mail(id="b", last_modified=at(3)), mail(id="c", last_modified=None)]
    found = [attached(attachment_id="x", parent_id="a", last_modified=None)]
    refuse = lambda rows: [{"id": r["id"], "errors": ["no"] * (r["id"] == "b")} for r in rows]
    outcome = jobs.run_full_sync(boxes(spark, mails, found), options, state, send=refuse)
    assert sorted(map(tuple, outcome.issues.collect())) == [
        ("mails", "b", "refused", "no"),
        ("mails", "c", "quarantined", "no last_modified"),
        ("mails", "x", "quarantined", "no last_modified"),
    ]
    assert ids(state.registry.read()) == ["a"] and outcome.documents == 2
    assert [r["summary"] for r in outcome.report.collect()] == ["1 out of 2"]


def test_retry():
    pauses, calls = [], []

    def flaky(value):
        calls.append(value)
        if len(calls) < 3:
            raise OSError("down")
        return value

    assert with_retry(flaky, 3, pauses.append)(5) == 5 and pauses == [2, 4]
    calls.clear()
    with pytest.raises(OSError):
        with_retry(flaky, 2, pauses.append)(5)
