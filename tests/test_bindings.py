"""Every bound query against its SQL statement on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from bindings.registry import QUERIES, SQL

SF = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(int(value)) if isinstance(value, bool) else str(value)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = db.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == expected
    assert got


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_no_python_workers_and_no_nested_loops(spark):
    for name, query in QUERIES.items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
            assert operator not in plan, (name, operator)
