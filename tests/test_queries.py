"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from wageledger.plans import oracle
from wageledger.plans.reports import REPORTS
from wageledger.plans.stateful import STATEFUL

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(REPORTS) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    result = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())
    got = sorted(repr([row[c] for c in columns]) for row in df.collect())
    assert got == want
    assert got
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_plans_of_large_tables_have_no_nested_loops(spark):
    """As when no table is small enough to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # the others return what they have stored
        for name in sorted(set(REPORTS) - set(STATEFUL)):
            plan = REPORTS[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    assert contract.entry(spark).count() > 0
