"""Every registered query against its SQL twin, and the plans they get."""

import os

import pytest

import __spark_entry__ as contract
from itemsync.plans.queries import QUERIES
from tests.compare import connect, rows_of_df, rows_of_sql

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")

@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns, got = rows_of_df(df)
    expected_columns, expected = rows_of_sql(duck, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert got == expected
    for unwanted in ("NestedLoop", "CartesianProduct", "Python", "MapInPandas", "CollectLimit"):
        assert unwanted not in plan_of(df)


def test_windows_reach_the_scan(spark):
    assert "GreaterThan(o_orderdate" in plan_of(QUERIES["item_window_open"](spark, FOLDER))
    plan = plan_of(QUERIES["item_attachments"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "l_extendedprice" not in plan and "o_clerk" not in plan


def test_id_scans_carry_no_bodies(spark):
    plan = plan_of(QUERIES["deletion_sync_plan"](spark, FOLDER))
    assert "html" not in plan and "o_totalprice" not in plan


def test_large_sides_are_not_broadcast(spark):
    """Beyond the broadcast limit the joins are salted; results stay the same."""
    names = ["full_sync_docs", "item_attachments", "revoked_identities", "account_items_local_time"]
    small = {name: rows_of_df(QUERIES[name](spark, FOLDER))[1] for name in names}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            df = QUERIES[name](spark, FOLDER)
            assert "_salt" in plan_of(df)
            assert rows_of_df(df)[1] == small[name]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["type", "id", "title", "body", "created_at", "created", "allow"] and not df.isEmpty()
