"""Every registered query gives the rows of its SQL."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import multiset


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    found = duck.execute(oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert multiset(df.columns, [tuple(r) for r in df.collect()]) == multiset(names, found.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
