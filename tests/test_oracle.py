"""Every query with SQL against DuckDB on the smallest data."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows

# The five most frequent departments name columns; the SQL names those of the larger data.
# Group calibration lies on a rounding edge of the sixth decimal at this size.
LARGER_DATA = {"i6_yield_features", "q4_group_calibration"}


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - LARGER_DATA))
def test_matches_sql(spark, folder, duck, name):
    df = entry.queries()[name](spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    found = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
