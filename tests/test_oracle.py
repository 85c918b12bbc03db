"""Every registered query against its SQL on the small tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from '{SF_DIR}/{table}.parquet'"
        )
    yield connection
    connection.close()


KINDS = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


def in_order(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


# those of the llm subpackage have tests of their own beside it
OWN = sorted(n for n, q in queries().items() if q.__module__ == "brindle.plans.queries")


@pytest.mark.parametrize("name", OWN)
def test_query(spark, sql, name):
    result = queries()[name](spark, SF_DIR)
    got = [tuple(row) for row in result.collect()]
    assert got
    relation = sql.sql(oracle_sql()[name])
    types = {c: KINDS[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert dict(result.dtypes) == types
    assert in_order(result.columns, got) == in_order(relation.columns, relation.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 150


def test_sql_has_no_orphans():
    assert set(oracle_sql()) <= set(queries())
