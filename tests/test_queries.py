"""Every registered query against DuckDB on the smallest tables, and plan invariants."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not present")
NAMES = list(entry.queries())


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    ok, message, _ = compare(df, entry.oracle_sql().get(name), con)
    assert ok, message


@pytest.mark.parametrize("name", ["a1_daily_stats", "j4_tiered_linking", "scd2_history", "m15_adc"])
def test_result_does_not_depend_on_partitions(spark, name):
    found = []
    for n in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = entry.queries()[name](spark, FOLDER)
        found.append(rows_of([tuple(r) for r in df.collect()], df.columns))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]
