"""Every registered query against its SQL counterpart, and what its plan must not contain."""

import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

from stallkeep.queries.built import warehouse
from stallkeep.queries.registry import all_queries, all_sql
from stallkeep.queries.roles import DRIVER_TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in DRIVER_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    connection.execute("SET TimeZone = 'UTC'")
    return connection


@pytest.fixture(scope="module")
def results(request, spark):
    """The selected queries, four at a time: most of a small run is planning on the driver."""
    names = [i.callspec.params["name"] for i in request.session.items if i.fspath == request.fspath and hasattr(i, "callspec")]
    pool = ThreadPoolExecutor(max_workers=4)
    warehouse(spark, SF_DIR)

    def run(name):
        df = QUERIES[name](spark, SF_DIR)
        columns = sorted(df.columns)
        got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
        return columns, got, df._jdf.queryExecution().executedPlan().toString()

    yield {name: pool.submit(run, name) for name in names}
    pool.shutdown(cancel_futures=True)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(results, sql, name):
    columns, got, plan = results[name].result()
    relation = sql.sql(SQL[name])
    assert sorted(relation.columns) == columns
    positions = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(r[p] for p in positions) for r in relation.fetchall()), key=repr)
    assert got == expected
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert unwanted not in plan
