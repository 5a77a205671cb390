"""Every registered query beside its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    if name not in entry.oracle_sql():
        assert len(got)
        return
    want = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got).equals(normal(want))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
