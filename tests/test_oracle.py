"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from nestline.sample.queries import ORACLE, QUERIES
from tools.check_oracle import TABLES, rows as as_text


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, db, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = db.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert as_text(got) == as_text(want)


def test_entry(spark):
    df = entry.entry(spark)
    assert "listing_id" in df.columns and df.count() > 0
