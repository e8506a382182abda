"""Every registered query against its SQL in DuckDB, on whole tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from plateful import queries as registered
from plateful.plans import customers
from plateful.plans.staging import lazy

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OWN = {q.__name__ for q in registered.QUERIES}
QUERIES = {name: query for name, query in contract.queries().items() if name in OWN}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}
ORDERED = ["view_segment_counts", "view_churn_counts", "view_customer_roster", "view_revenue_timeline",
           "view_hourly_demand", "view_location_league"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    want = normal(expected.fetchall(), names)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    assert len(got) == len(want) and len(want) > 0
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    assert not differing, differing[:5]

    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "windowspecdefinition(specified"):
        assert forbidden not in plan
    # Nothing but one-row aggregates and per-task results of a limit may meet in one partition.
    single = plan.count("Exchange SinglePartition")
    assert single <= plan.count("HashAggregate(keys=[]") + plan.count("LocalLimit")


@pytest.mark.parametrize("name", ORDERED)
def test_same_order(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(SQL[name])
    names = [d[0] for d in expected.description]
    assert [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()] == expected.fetchall()


def test_whole_plans_of_the_customer_tables(spark):
    """Nothing written in between, so the plan reaches from the scans to the result."""
    lines = registered.items(spark, SF_DIR)
    options = registered.options(spark, SF_DIR)
    values = customers.customer_lifetime_value(lines, options, stage=lazy)
    for df in (values, customers.customer_segments(lines, stage=lazy)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan or "Scan parquet" in plan
        for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "windowspecdefinition(specified"):
            assert forbidden not in plan


def test_every_query_has_a_statement():
    assert set(SQL) == set(QUERIES)


def test_test_tables_have_no_missing_partners(duck):
    """The mapping joins only the tables its columns need, which this makes safe."""
    lines = duck.execute("SELECT count(*) FROM lineitem").fetchone()
    joined = duck.execute("""SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""").fetchone()
    assert lines == joined
