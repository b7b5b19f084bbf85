"""Every registered query against its SQL, and rules that hold for all plans."""

import re

import pytest
from conftest import SF, plan_of
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from sparkroute.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    assert name in oracle_sql(), "no SQL for this query"
    _, problem = compare(spark, con, SF, queries()[name], oracle_sql()[name])
    assert not problem


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 20
    assert set(df.columns) == {"chunk_id", "shard", "n_rows", "min_hash", "max_hash"}


PYTHON_ALLOWED = {"bson_scan"}


@pytest.mark.parametrize("name", ["route_hash", "route_range", "route_many_chunks", "batches", "file_plan",
                                  "dedup_first", "diff_rows", "fingerprint", "anti_existing", "add_id"])
def test_plans_scale(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert not re.search("CartesianProduct|NestedLoopJoin|Python|ArrowEval|MapInArrow", plan)
    assert "SinglePartition" not in plan
