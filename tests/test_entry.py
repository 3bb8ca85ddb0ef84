"""The driver's contract: names, guards, and every query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
OWN = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(OWN) > 95


@pytest.fixture(scope="module")
def duck():
    import duckdb

    if not os.path.isdir(SF):
        pytest.skip("no tables here")
    c = duckdb.connect()
    for name in os.listdir(SF):
        if name.endswith(".parquet"):
            c.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return c


@pytest.mark.parametrize("name", [n for n in OWN if n in entry.oracle_sql()])
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got) == len(want)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    for c in columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def test_flagship(spark):
    if os.path.isdir(SF):
        assert entry.entry(spark).count() > 0
