"""Every registered query against its SQL, and what its plan may not contain."""

import re

import pytest

import __spark_entry__ as contract
import compare
from casebook import SMALL
from ledgerlight.testbed import oracle
from ledgerlight.testbed import queries as registry

QUERIES = registry.registered()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(SMALL)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry_is_the_flagship(spark):
    df = contract.entry(spark)
    assert "query_attributed_dollars_estimation" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql_and_plans_well(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert compare.differs(df, duck, name) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan
    # a window without a partition key would put all rows in one task
    assert not re.search(r"Window \[.*\], \[\], \[", plan)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    """A fact over stored feeds reads a few columns of the rows of its product."""
    from ledgerlight.plans.billing_facts import index_cost_fact
    from ledgerlight.testbed.feeds import LINES_AS_OF, Feeds

    feeds = Feeds(spark, SMALL)
    stored = {}
    for name in ("billing_lines", "list_prices", "workspaces"):
        getattr(feeds, name).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    fact = index_cost_fact(stored["billing_lines"], stored["list_prices"], stored["workspaces"], LINES_AS_OF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = fact._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.split("== Physical Plan ==")[1].split("\n") if "FileScan" in line]
    billing = next(line for line in scans if "billing_lines" in line or "billing_origin_product" in line)
    assert "EqualTo(billing_origin_product,VECTOR_INDEX)" in billing
    assert "GreaterThanOrEqual(usage_start_time" in billing
    assert "identity_metadata" not in billing and "assistant" not in billing
    assert any("EqualTo(currency_code,USD)" in line for line in scans)
