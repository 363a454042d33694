"""Every registered query against DuckDB, on whole tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registered
from linkrank import workload

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = workload.queries(), workload.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def test_same_names():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got, want = normal(QUERIES[name](spark, SF_DIR).toPandas()), normal(duck.sql(ORACLE[name]).df())
    assert len(want) > 0
    assert list(got.columns) == list(want.columns)
    assert [str(t) for t in got.dtypes] == [str(t) for t in want.dtypes]
    pd.testing.assert_frame_equal(got, want, check_exact=True)


def test_entry(spark):
    ranks = registered.entry(spark)
    assert ranks.columns == ["page", "pagerank"] and ranks.count() == 1476
