"""Every registered query against its SQL on DuckDB, over whole tables, and what its plan must not hold."""

import duckdb
import pytest

import __spark_entry__ as registered
from marketlake.registry import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
    conversations""".split()
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
QUERIES, ORACLES = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def as_rows(columns, rows):
    """Rows with their columns in order of name; the order of rows does not matter."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, plan_of, name):
    df = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in answer.description}
    assert as_rows(df.columns, df.collect()) == as_rows(columns, answer.fetchall())
    plan = plan_of(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_entry_runs(spark):
    assert registered.entry(spark).count() == 10
