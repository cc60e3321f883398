"""Every registered query beside its checking SQL on the smallest tables, and rules all plans keep."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check import compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no supplied tables here")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_its_sql(spark, name):
    """Queries without SQL only have to run here; other tests hold them against plain versions."""
    assert compare(spark, FOLDER, name).startswith("ok" if name in entry.oracle_sql() else "rows only")


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["query_id", "rank", "doc_id", "_similarity_score"] and out.count() > 0


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith("stream_")))
def test_no_pairs_of_all_rows(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
