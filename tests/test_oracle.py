"""Every registered query against its SQL twin."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidemark.acceptance import ORACLES as OWN_ORACLES
from tidemark.acceptance import QUERIES as OWN_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
# The library's own queries; those of optional subpackages have tests of their own.
QUERIES = OWN_QUERIES
ORACLES = OWN_ORACLES
# Spark types and the DuckDB types they compare with.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SAME_TYPE[t] for c, t in result.dtypes} == kinds
    expected = relation.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    found = [tuple(r) for r in result.select(*columns).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["jan_orders", "jan_revenue"]
    assert result.count() == 1
