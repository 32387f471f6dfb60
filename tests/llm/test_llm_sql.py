"""The registered queries against their SQL on the smallest tables."""

import os

import pytest

from checks.compare import compare, oracle_connection
from waymend.llm.oracle import ORACLE
from waymend.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, name):
    query = QUERIES[name]
    if name == "op7_exact_dedup":
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
    ok, message, _ = compare(spark, oracle_connection(FOLDER), FOLDER, name, query, ORACLE.get(name))
    assert ok, message
