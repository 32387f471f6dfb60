"""Registered queries: agreement with their SQL on the smallest tables, and their plans."""

import os
import re

import pytest

from checks import all_queries, all_sql
from checks.compare import compare, oracle_connection
from waymend.session import shared_folder

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_same_as_sql(spark, connection, name):
    ok, message, _ = compare(spark, connection, FOLDER, name, all_queries()[name], all_sql().get(name))
    assert ok, message


@pytest.mark.parametrize("name", list(all_queries()))
def test_plan(spark, name):
    """No pairwise join, no Python."""
    plan = all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InArrow", "InPandas"):
        assert word not in plan


SCANS = {
    "audit_flag_counts": {"lineitem": 2}, "audit_summary": {"lineitem": 3}, "audit_ordered_flags": {"lineitem": 1},
    # Both sibling tables are made of the line items.
    "overlap_resolution": {"lineitem": 2}, "merge_sources": {"lineitem": 4}, "merge_log": {"lineitem": 4},
    "chain_fill": {"lineitem": 3}, "chain_log": {"lineitem": 3}, "move_rows": {"lineitem": 4}, "fill_log": {"lineitem": 4},
    "validate_stops": {"lineitem": 1}, "quality_score": {"lineitem": 1, "orders": 1}, "schedule_status": {"lineitem": 4},
}


@pytest.mark.parametrize("name", list(SCANS))
def test_scans(spark, name):
    """How often a table is read, before Spark reuses what it finds to be the same."""
    plan = all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"InMemoryFileIndex[^\]]*?/(\w+)\.parquet", plan)
    assert {t: read.count(t) for t in SCANS[name]} == SCANS[name]


def test_the_audit_writes_nothing_and_shuffles_by_train_once(spark):
    before = set(os.listdir(shared_folder(spark)))
    plan = all_queries()["audit_flag_counts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert set(os.listdir(shared_folder(spark))) == before
    assert len(re.findall(r"Exchange hashpartitioning\(train_no", plan)) == 1
    assert len(re.findall(r"Exchange ", plan)) - len(re.findall(r"REPARTITION", plan)) <= 8


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())


def test_ranks_are_limited_before_the_shuffle(spark):
    """Keeping the first rows of a key must not gather the key."""
    from waymend.operators.keyed import drop_duplicates_keep_first, top_per_key

    df = spark.range(100).selectExpr("id", "id % 3 as k")
    for out in (drop_duplicates_keep_first(df, ["k"], ["id"]), top_per_key(df, ["k"], ["id"], 5, "r")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_only_needed_columns_are_read(spark):
    plan = all_queries()["dup_stop"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey" in plan and "l_shipdate" not in plan and "l_quantity" not in plan
