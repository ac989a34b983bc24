import random

import pytest
from pyspark.sql import functions as F

from itemsync.operators import batching, numbering


def next_fit(sizes, limit):
    """Plain restatement: (batch, removed) of each (size, bare_size)."""
    out, batch, room, open_rows = [], 0, limit, 0
    for size, bare in sizes:
        removed = False
        if size < room:
            room -= size
        else:
            batch += 1 if open_rows else 0
            removed = size > limit
            room = limit - (bare if removed else size)
        open_rows += 1
        out.append((batch, removed))
    return out


def test_position_is_dense_and_spread(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)))
    rows = numbering.with_position(df, ["id"], within=["g"]).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["g"], []).append(r["position"])
    assert all(sorted(p) == list(range(len(p))) for p in groups.values())
    whole = [r["position"] for r in numbering.with_position(df, ["id"]).collect()]
    assert sorted(whole) == list(range(5000))


def test_position_keeps_missing_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    rows = numbering.with_position(df, ["id"], ["g"], slot=F.lit(0)).collect()
    assert sorted((r["id"], r["position"]) for r in rows) == [(1, 0), (2, 1), (3, 0)]


def test_position_plan_has_no_single_task_window_over_rows(spark):
    df = spark.range(1000)
    plan = numbering.with_position(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_piece" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("rows,buckets,expected", [(9, 3, [3, 3, 3]), (2, 5, [1, 1]), (10, 4, [2, 2, 3, 3]), (0, 3, [])])
def test_round_robin(spark, rows, buckets, expected):
    got = batching.round_robin_buckets(spark.range(rows), buckets, ["id"]).groupBy("bucket").count().collect()
    assert sorted(r["count"] for r in got) == expected
    assert sorted(r["bucket"] for r in got) == list(range(len(expected)))


def test_round_robin_in_order(spark):
    got = batching.round_robin_buckets(spark.range(9), 3, ["id"], slot=F.lit(0)).collect()
    assert {r["id"]: r["bucket"] for r in got} == {n: n % 3 for n in range(9)}


def test_fixed_chunks(spark):
    got = batching.fixed_chunks(spark.range(1, 11), 5, ["id"], slot=F.lit(0)).orderBy("id").collect()
    assert [(r["chunk"], r["ord"]) for r in got] == [(n // 5, n % 5) for n in range(10)]
    sizes = batching.delete_batches(spark.range(250)).groupBy("chunk").count().collect()
    assert sorted(r["count"] for r in sizes) == [50, 100, 100]


def run_batches(spark, groups, limit):
    rows = [(g, n, n, s, b) for g, sizes in enumerate(groups) for n, (s, b) in enumerate(sizes)]
    df = spark.createDataFrame(rows, "chunk int, ord int, id int, size long, bare_size long")
    got = batching.byte_batches(df, limit).collect()
    assert len(got) == len(rows)
    return {(r["chunk"], r["ord"]): (r["batch"], r["body_removed"]) for r in got}


@pytest.mark.parametrize("limit,expected", [(140, [(0, False)] * 3 + [(1, False)] * 3), (1, [(n, True) for n in range(6)])])
def test_byte_batches_golden(spark, limit, expected):
    got = run_batches(spark, [[(41, 28)] * 6], limit)
    assert [got[0, n] for n in range(6)] == expected


def test_byte_batches_random(spark):
    rng = random.Random(3)
    groups = []
    for _ in range(200):
        sizes = [rng.choice([5, 20, 60, 99, 100, 101, 400]) for _ in range(rng.randint(1, 100))]
        groups.append([(s, rng.randint(3, s)) for s in sizes])
    got = run_batches(spark, groups, 100)
    for g, sizes in enumerate(groups):
        assert [got[g, n] for n in range(len(sizes))] == next_fit(sizes, 100)


def test_big_document_between_small_ones(spark):
    got = run_batches(spark, [[(10, 9), (500, 20), (10, 9)]], 100)
    assert [got[0, n] for n in range(3)] == [(0, False), (1, True), (1, False)]


def test_empty_input_makes_no_batch(spark):
    assert run_batches(spark, [[]], 100) == {}


def gathered(messages, rows, limit):
    """Plain restatement: gather number of each (message, [sizes])."""
    out, gather, held = {}, 0, []
    for message, sizes in messages:
        printed = 2 + sum(held) + 2 * max(len(held) - 1, 0)
        if len(held) >= rows or printed >= limit:
            gather, held = gather + 1, []
        held += sizes
        out[message] = gather
    return out


def test_consumer_batches(spark):
    rng = random.Random(5)
    queues = {q: [(m, [rng.randint(5, 60) for _ in range(rng.choice([1, 4, 9, 25]))]) for m in range(6)] for q in "abcd"}
    rows = [(q, m, f"{q}{m}-{n}", s, s // 2) for q, ms in queues.items() for m, ss in ms for n, s in enumerate(ss)]
    df = spark.createDataFrame(rows, "queue string, message int, id string, size long, bare_size long")
    gathers = {(r["queue"], r["message"]): r["gather"] for r in batching.gather_messages(df, "queue", "message", 10, 150).collect()}
    assert gathers == {(q, m): g for q, ms in queues.items() for m, g in gathered(ms, 10, 150).items()}
    got = batching.consumer_batches(df, "queue", "message", ["id"], limit=150, rows=10).collect()
    assert sorted(r["id"] for r in got) == sorted(r[2] for r in rows)
    sizes = {r[2]: (r[3], r[4]) for r in rows}
    place = {r[2]: (r[0], r[1]) for r in rows}
    chunks = {}
    for r in got:
        assert r["gather"] == gathers[place[r["id"]]]
        chunks.setdefault((r["queue"], r["gather"], r["chunk"]), []).append(r)
    for members in chunks.values():
        members.sort(key=lambda r: r["ord"])
        assert len(members) <= 10
        expected = next_fit([sizes[r["id"]] for r in members], 150)
        assert [(r["batch"], r["body_removed"]) for r in members] == expected
        assert [place[r["id"]][1] for r in members] == sorted(place[r["id"]][1] for r in members)


def test_a_queue_of_very_many_messages(spark):
    """The gathering of 100,000 messages, against a plain loop; no list is built."""
    sizes = spark.range(100_000).select(
        F.lit("q").alias("queue"), F.col("id").cast("int").alias("message"), (F.col("id") * 7919 % 40_000).alias("size")
    )
    other = spark.range(5).select(F.lit("r").alias("queue"), F.col("id").cast("int").alias("message"), F.lit(10).alias("size"))
    found = batching.gather_messages(sizes.unionByName(other), "queue", "message", rows=100, limit=500_000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    got = {(r["queue"], r["message"]): r["gather"] for r in found.collect()}
    gather, n, chars = 0, 0, 0
    for m in range(100_000):
        if n >= 100 or 2 + chars + 2 * max(n - 1, 0) >= 500_000:
            gather, n, chars = gather + 1, 0, 0
        n, chars = n + 1, chars + m * 7919 % 40_000
        assert got["q", m] == gather
    assert [got["r", m] for m in range(5)] == [0] * 5
