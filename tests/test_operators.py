import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from itemsync.operators import acl, checkpoints, dedup, joins, registry, report, windows
from itemsync.options import FieldRule, JobOptions
from itemsync.operators.shape import kept_fields
from itemsync.sources.mapping import read_mapping
from itemsync.sources.tables import read_or_empty
from itemsync.schemas import CHECKPOINTS, IDENTITIES, REGISTRY, RESPONSES

NOW = dt.datetime(2024, 2, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def timed(spark, texts, kind="timestamp"):
    return spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "id int, t string").withColumn(
        "t", F.col("t").cast(kind)
    )


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_change_window_bounds(spark, kind):
    df = timed(spark, ["2024-01-01 00:00:00", "2024-01-01 00:00:00.000001", "2024-01-02", None, "2023-12-31"], kind)
    span = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert [r["id"] for r in windows.change_window(df, "t", *span).collect()] == [0, 1]
    assert [r["id"] for r in windows.change_window(df, "t", *span, "open").collect()] == [1]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_change_window_is_pushed_down(spark, kind, folder):
    timed(spark, ["2024-01-01"], kind).write.parquet(folder + "/t")
    df = windows.change_window(spark.read.parquet(folder + "/t"), "t", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert "GreaterThanOrEqual(t" in plan_of(df) and "LessThan(t" in plan_of(df)


def test_change_window_prunes_folders(spark, folder):
    df = timed(spark, [f"2024-01-0{d} 12:00:00" for d in range(1, 9)])
    df.withColumn("modified_day", F.to_date("t")).write.partitionBy("modified_day").parquet(folder + "/t")
    span = (dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 5, 13))
    stored = spark.read.parquet(folder + "/t")
    got = windows.change_window(stored, "t", *span, day="modified_day")
    assert sorted(r["id"] for r in got.collect()) == [2, 3, 4]
    text = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(modified_day" in text


def test_chunk_bounds_golden(spark):
    start, end = dt.datetime(2022, 4, 1), dt.datetime(2022, 4, 10)
    expected = ["04-01T00:00:00", "04-02T19:12:00", "04-04T14:24:00", "04-06T09:36:00", "04-08T04:48:00", "04-10T00:00:00"]
    assert [b.isoformat()[5:] for b in windows.chunk_bounds(start, end, 5)] == expected
    df = spark.createDataFrame([(start, end)], "s timestamp, e timestamp")
    got = windows.split_ranges(df, "s", "e", 5).orderBy("chunk").collect()
    assert [r["chunk_start"].isoformat()[5:] for r in got] + [got[-1]["chunk_end"].isoformat()[5:]] == expected
    assert all(a["chunk_end"] == b["chunk_start"] for a, b in zip(got, got[1:]))


def test_split_ranges_equals_bounds(spark):
    pairs = [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)) for s in (1, 7, 20, 100, 86399, 31536001)]
    df = spark.createDataFrame([(n, *p) for n, p in enumerate(pairs)], "id int, s timestamp, e timestamp")
    for chunks in (1, 3, 6, 7):
        got = windows.split_ranges(df, "s", "e", chunks).orderBy("id", "chunk").collect()
        for n, pair in enumerate(pairs):
            bounds = windows.chunk_bounds(*pair, chunks)
            assert [(r["chunk_start"], r["chunk_end"]) for r in got if r["id"] == n] == list(zip(bounds, bounds[1:]))


def test_chunk_index(spark):
    start, end = dt.datetime(2022, 4, 1), dt.datetime(2022, 4, 10)
    bounds = windows.chunk_bounds(start, end, 5)
    df = timed(spark, [b.isoformat() for b in bounds[:-1]] + ["2022-04-02T19:11:59.999999"])
    got = df.select("id", windows.chunk_index(df, "t", start, end, 5).alias("c")).orderBy("id").collect()
    assert [r["c"] for r in got] == [0, 1, 2, 3, 4, 0]
    assert [r["id"] for r in windows.off_bounds(df, "t", start, end, 5).collect()] == [0, 5]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_join_gives_the_same_rows(spark, how):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 400).alias("k"))
    big = big.unionByName(spark.createDataFrame([(9999, None)], "id long, k long"))
    small = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    expected = rows_of(big.join(small, "k", how).fillna(-1))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "hot" not in plan_of(joins.skew_join(big, small, "k", how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.skew_join(big, small, "k", how, salts=16)
        assert "_salt" in plan_of(joined)
        assert rows_of(joined.fillna(-1)) == expected
        hot = [r["k"] for r in joins.hot_keys(big, "k", 0.1).collect()]
        assert hot == [7]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_distinct_and_latest(spark):
    rows = [("a", ["x"], 1), ("a", ["x"], 1), ("b", [], 1), ("b", ["y"], 2), ("c", None, None)]
    df = spark.createDataFrame(rows, "id string, p array<string>, t int")
    assert dedup.distinct_rows(df).count() == 4
    got = {r["id"]: (r["p"], r["t"]) for r in dedup.latest_by_id(df, ["id"], ["t"]).collect()}
    assert got == {"a": (["x"], 1), "b": (["y"], 2), "c": (None, None)}


def reg(spark, rows):
    return spark.createDataFrame(rows, REGISTRY)


ROW = ("abc123", "xyz123", "inbox mail", "Microsoft Exchange", "mails")


def test_registry_insert_is_idempotent(spark):
    base = reg(spark, [ROW])
    assert rows_of(registry.merge_registry(base, reg(spark, [ROW, ROW]))) == [ROW]
    other = ("abc123", "", "inbox mail", "Microsoft Exchange", "mails")
    assert rows_of(registry.merge_registry(base, reg(spark, [other, ROW, other]))) == sorted([ROW, other])
    assert rows_of(registry.new_rows(base, reg(spark, [other, ROW]))) == [other]


def test_loaded_state(spark):
    got = registry.loaded_state(reg(spark, [ROW])).collect()
    assert sorted(r["state"] for r in got) == ["delete_keys", "global_keys"] and {r["id"] for r in got} == {"abc123"}


def test_deletion(spark):
    stored = reg(
        spark,
        [
            ("1", "", "inbox mails", "Office365", "mails"),
            ("2", "", "inbox mails", "Office365", "mails"),
            ("2", "", "sent mails", "Office365", "mails"),
            ("3", "2", "mails attachments", "Office365", "mails"),
            ("4", "", "inbox mails", "Microsoft Exchange", "mails"),
            ("1", "", "tasks", "Office365", "tasks"),
        ],
    )
    live = spark.createDataFrame([("mails", "1"), ("mails", "1"), ("mails", "3")], "object string, id string")
    gone = registry.deleted_ids(stored, live, "Office365")
    assert rows_of(gone) == [("mails", "2"), ("tasks", "1")]
    assert rows_of(registry.cascade(stored, gone)) == [("mails", "2"), ("mails", "3"), ("tasks", "1")]
    assert [(r["object"], r["id"]) for r in registry.surviving(stored, gone, "Office365").orderBy("id").collect()] == [
        ("mails", "1"),
        ("mails", "3"),
        ("mails", "4"),
    ]
    assert "NestedLoop" not in plan_of(gone)


def test_deletion_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(registry, "TASK_ROWS", 10)
    ids = [(str(n), "", "tasks", "Office365", "tasks") for n in range(100)]
    stored = reg(spark, [*ids, *ids[:3], (None, "", "tasks", "Office365", "tasks")])
    live = spark.createDataFrame([("tasks", str(n)) for n in range(0, 100, 2)] * 2 + [("tasks", None)], "object string, id string")
    gone = registry.deleted_ids(stored, live, "Office365", live_rows=101)
    # a missing id is never live
    assert sorted(str(r["id"]) for r in gone.collect()) == sorted([*map(str, range(1, 100, 2)), "None"])
    # dealt once by key, into as many pieces as there are rows for, without sorting either side
    assert gone.rdd.getNumPartitions() == registry.pieces(104 + 101) == 21
    plan = plan_of(gone).split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert registry.pieces(10**9) == 500 and registry.pieces(0) == 1


def test_revoke_and_grant(spark):
    accounts = spark.createDataFrame([("user1",), ("user3",)], "account string")
    listed = [("user1", ["user1"]), ("user2", ["user2"]), ("none", []), ("null", None), ("both", ["x", "user3"])]
    identities = spark.createDataFrame(listed, IDENTITIES)
    gone = acl.revoked_identities(identities, accounts)
    assert sorted(r["identity"] for r in gone.collect()) == ["none", "null", "user2"]
    assert "NestedLoop" not in plan_of(gone)
    mapping = spark.createDataFrame([("user3", "target")], "source string, target string")
    assert rows_of(acl.granted_permissions(accounts, mapping)) == [("target", ["user3"]), ("user1", ["user1"])]


def test_mapping_file(spark, folder):
    def write(text):
        with open(folder + "/m.csv", "w") as out:
            out.write(text)

    assert read_mapping(spark, folder + "/missing.csv").count() == 0
    write("dummy,dummy\n")
    assert rows_of(read_mapping(spark, folder + "/m.csv")) == [("dummy", "dummy")]
    write('a,1\nb,"x ""q"", y"\na,2\nbroken\n')
    assert rows_of(read_mapping(spark, folder + "/m.csv")) == [("a", "2"), ("b", 'x "q", y')]
    lines = [f"u{n % 97},t{n}\n" for n in range(5000)]
    write("".join(lines))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = {r["source"]: r["target"] for r in read_mapping(spark, folder + "/m.csv").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == dict(line.strip().split(",") for line in lines)
    write("")
    assert read_mapping(spark, folder + "/m.csv").count() == 0


def test_directory(spark):
    rows = [
        ("searchResEntry", "person", "user", "A", "a@x"),
        ("searchResRef", "person", "user", "B", "b@x"),
        ("searchResEntry", "person", "user", None, "c@x"),
        ("searchResEntry", "group", "user", "D", "d@x"),
    ]
    directory = spark.createDataFrame(rows, "entry_type string, category string, class string, given_name string, mail string")
    assert rows_of(acl.accounts_of(directory, "Microsoft Exchange")) == [("a@x", "UTC", "Microsoft Exchange")]
    assert [r["account"] for r in acl.accounts_of(directory, "Office365").collect()] == ["a@x", "b@x", "c@x", "d@x"]


def test_reports(spark):
    docs = spark.createDataFrame([("0", "text", 0), ("1", "text", 0), ("2", "other", 1)], "id string, type string, batch int")
    ok = spark.createDataFrame([("0", []), ("1", [])], RESPONSES)
    assert [r["summary"] for r in report.index_report(docs.filter("type = 'text'"), ok).collect()] == ["2 out of 2"]
    bad = spark.createDataFrame([("0", ["e"]), ("0", ["f"]), ("1", [])], RESPONSES)
    assert rows_of(report.index_report(docs, bad).select("type", "total", "failed", "indexed")) == [
        ("other", 1, 0, 1),
        ("text", 2, 1, 1),
    ]
    assert rows_of(report.ids_by_type(docs, ["batch"])) == [(0, "text", ["0", "1"]), (1, "other", ["2"])]
    assert rows_of(report.failed_per_batch(docs, bad, ["batch"])) == [(0, 2, 1), (1, 1, 0)]
    watched, seen = report.observed(docs, "docs")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 3


def test_field_rules():
    assert kept_fields(None) == ["id", "title", "body", "created_at"]
    assert kept_fields(FieldRule(include_fields=("DisplayName",))) == ["id", "title"]
    assert kept_fields(FieldRule(include_fields=("Id", "Created"), exclude_fields=("Created",))) == ["id", "created_at"]
    assert kept_fields(FieldRule(exclude_fields=("Id", "Description"))) == ["id", "title", "created_at"]


def test_options():
    options = JobOptions(NOW)
    assert (options.start_time, options.end_time) == (NOW - dt.timedelta(days=180), NOW)
    for wrong in (
        {"platform": "Other"},
        {"start_time": NOW},
        {"end_time": NOW + dt.timedelta(1)},
        {"bounds": "closed"},
        {"objects": {"notes": FieldRule()}},
        {"time_chunks": 0},
    ):
        with pytest.raises(ValueError):
            JobOptions(NOW, **wrong)


def test_checkpoints(spark):
    options = JobOptions(NOW, start_time=dt.datetime(2024, 1, 1), end_time=dt.datetime(2024, 1, 20))
    wanted = spark.createDataFrame(
        [("Office365", o, n) for n, o in enumerate(["mails", "calendar", "tasks"])], "platform string, object string, place int"
    )
    stored = spark.createDataFrame([("Office365", "mails", "2024-01-29T00:00:00Z"), ("Office365", "tasks", "")], CHECKPOINTS)
    got = {r["object"]: (r["start_time"][:10], r["end_time"][:10]) for r in checkpoints.checkpoint_windows(wanted, stored, options).collect()}
    assert got == {
        "mails": ("2024-01-29", "2024-02-01"),
        "calendar": ("2024-01-01", "2024-01-20"),
        "tasks": ("2024-01-01", "2024-01-20"),
    }
    with pytest.raises(PySparkException):
        bad = spark.createDataFrame([("Office365", "mails", "yesterday")], CHECKPOINTS)
        checkpoints.checkpoint_windows(wanted, bad, options).collect()

    def stores(table, mode, **extra):
        chosen = JobOptions(NOW, start_time=options.start_time, end_time=options.end_time, **extra)
        found = checkpoints.next_checkpoints(wanted, table, chosen, mode, "place").collect()
        return {r["object"]: r["checkpoint"][8:10] for r in found}

    none = spark.createDataFrame([], CHECKPOINTS)
    assert stores(stored, "incremental") == {"mails": "01", "calendar": "20", "tasks": "20"}
    assert stores(none, "incremental") == {"mails": "20", "calendar": "20", "tasks": "20"}
    assert stores(none, "full_sync") == {"mails": "01", "calendar": "01", "tasks": "01"}
    assert stores(none, "full_sync", reference_rules=True) == {"mails": "01", "calendar": "20", "tasks": "20"}
    assert stores(stored, "full_sync", reference_rules=True) == {"mails": "01", "calendar": "20", "tasks": "20"}


def test_read_or_empty(spark, folder):
    assert read_or_empty(spark, folder + "/none", REGISTRY).count() == 0


def test_long_permission_lists_stay_out_of_the_pairs(spark):
    from itemsync.operators import acl

    rows = [("big", [f"u{n}@x" for n in range(10_000)]), ("gone", [f"v{n}@x" for n in range(10_000)]), ("big", ["v1@x"])]
    identities = spark.createDataFrame(rows, "identity string, permissions array<string>")
    accounts = spark.createDataFrame([("u5@x",), ("u7@x",)], "account string")
    gone = acl.revoked_identities(identities, accounts)
    assert sorted((r["identity"], len(r["permissions"])) for r in gone.collect()) == [("big", 1), ("gone", 10_000)]


def test_upsert_plan_takes_one_row_per_key(spark):
    from itemsync.sinks.keyed import upserted

    target = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    rows = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    assert sorted(map(tuple, upserted(target, rows, ["id"]).collect())) == [(1, "c"), (2, "a")]


def test_rows_without_a_partner_never_shuffle(spark):
    """Broadcasting off: wide rows meet a bitmap of keys before the exchange, and the join is that of plain Spark."""
    from itemsync.operators.joins import may_match, skew_join

    big = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("n"), F.lit("wide").alias("content"))
    big = big.unionByName(spark.createDataFrame([(None, -1, "wide")], "k bigint, n bigint, content string"))
    small = spark.range(0, 5000, 50).select(F.col("id").alias("k"), F.lit(1).alias("zone"))
    kept = may_match(big, small, "k")
    assert 400 <= kept.count() <= 440 and kept.columns == big.columns
    assert may_match(big, small.limit(0), "k").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left_semi"):
            found = skew_join(big, small, "k", how, spread=F.col("n"))
            assert sorted(map(tuple, found.collect())) == sorted(map(tuple, big.join(small, "k", how).collect()))
        lines = skew_join(big, small, "k", spread=F.col("n"))._jdf.queryExecution().executedPlan().toString().split("\n")
        held = next(i for i, line in enumerate(lines) if "shiftright" in line)
        # a plan is printed from the top, so what is done first stands below
        assert any("Exchange hashpartitioning(k" in line for line in lines[:held])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def wide_rows(spark, n=3000):
    """Versions with missing keys and times, ties, and whole copies."""
    rng = random.Random(2)
    pick = lambda *values: rng.choice(values)
    rows = [(pick(None, *range(40)), pick(None, 1, 2, 3), pick(None, 5, 6), pick(None, "a", "b"), pick("body", None)) for _ in range(n)]
    return spark.createDataFrame(rows + rows[:50], "k int, t int, u bigint, x string, body string").repartition(4)


@pytest.mark.parametrize("order", [["t"], ["t", "u"], []])
def test_latest_of_a_stored_table(spark, order):
    df = wide_rows(spark)
    found = dedup.latest_by_id(df, ["k"], order)
    assert found.columns == df.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, dedup.latest_computed(df, ["k"], order).collect()))


def test_distinct_of_a_stored_table(spark):
    df = wide_rows(spark, 400)
    assert sorted(map(repr, dedup.distinct_rows(df).collect())) == sorted(map(repr, df.distinct().collect()))
    assert dedup.distinct_rows(df.limit(0)).count() == 0


def test_bodies_move_late(spark, tmp_path):
    """Broadcasting off: no body below an exchange except those of winners and copies, none in a sort of winners."""
    df = wide_rows(spark).select("k", "t", "u", F.col("body").alias("wide_body"))
    df.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dedup.latest_by_id(df, ["k"], ["t", "u"])._jdf.queryExecution().executedPlan().toString()
        untied = plan.split("Union")[1].split("SortAggregate")[0]
        assert "SortAggregate" not in untied and "ShuffledHashJoin" in untied
        assert "Sort [k" not in untied.split("ShuffledHashJoin")[0]
        once = dedup.distinct_rows(df)._jdf.queryExecution().executedPlan().toString().split("Union")[1]
        first = once.split("Aggregate(keys=[k")[0]
        # the rows without copies meet the bitmap in a broadcast join; what is exchanged is their digests
        assert all("wide_body" not in line for line in first.split("\n") if "Exchange hashpartitioning" in line)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
