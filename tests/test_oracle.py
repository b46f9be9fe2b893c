"""Every query against its SQL twin on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from registrar.plans.checked import spark_queries, sql_twins

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
]
QUERIES = spark_queries()
TWINS = sql_twins()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(TWINS) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(TWINS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(TWINS[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    places = [names.index(c) for c in columns]
    expected = sorted(repr([r[i] for i in places]) for r in cursor.fetchall())
    assert got == expected
    assert got, "an empty result proves nothing"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year_group", "date", "upn", "surname_forename_id", "n", "cum_sum"]
