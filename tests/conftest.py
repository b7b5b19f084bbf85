import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkroute.session import build_session

    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    session = build_session("tests", "local[8]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def load_table(spark, sf):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
