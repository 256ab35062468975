"""Every registered query against its DuckDB oracle at sf0.001 (exact values)."""
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUERIES, ORACLE = E.queries(), E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan_ok(spark, df):
    """No cross join, no nested-loop join, no row-at-a-time Python UDF."""
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "simple")
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{bad} in plan:\n{plan}"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    _plan_ok(spark, df)
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), ocols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    _plan_ok(spark, df)
    assert df.count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["pickup_hour", "trips"] and df.count() == 24
