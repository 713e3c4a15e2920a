"""Every query against its SQL on the same tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from rowtide.workload.oracle import ORACLE
from rowtide.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows_of(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    values = df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)
    return sorted(values, key=lambda row: [(v is not None, str(v)) for v in row])


def kind_of(series: pd.Series) -> str:
    kind = series.dtype.kind
    return "M" if kind == "M" else kind


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert len(want) > 0
    assert rows_of(got) == rows_of(want)
    for column in want.columns:
        if want[column].notna().any():
            assert kind_of(got[column]) == kind_of(want[column]), column
