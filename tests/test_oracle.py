"""Every query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from verification import oracle, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module", autouse=True)
def released(spark):
    yield
    queries.release(spark)
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("verification_")]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(found):
    return sorted(found, key=lambda row: tuple(map(str, row)))


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_its_twin(spark, database, name):
    df = queries.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = database.sql(oracle.oracle_sql()[name])
    assert sorted(result.columns) == columns
    types = dict(zip(result.columns, map(str, result.types)))
    assert set(types.values()) <= {"BIGINT", "DOUBLE", "VARCHAR", "BOOLEAN", "TIMESTAMP"}
    expected = result.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert ordered(map(tuple, df.select(columns).collect())) == ordered(expected)


def test_every_query_has_a_twin():
    assert queries.queries().keys() == oracle.oracle_sql().keys()
    assert queries.queries().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).where(F.col("total_orders") > 0).count() > 0
