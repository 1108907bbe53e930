import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.catalogue.QUERIES))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = db.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.normal(got) == check.normal(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
