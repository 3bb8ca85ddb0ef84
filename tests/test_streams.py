import random

import pandas as pd
import pytest
from genoframe.operators.streams import map_groups, whole_groups


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_groups_stay_whole_for_any_cut(size):
    rng = random.Random(size)
    rows = sorted((rng.choice("ab"), rng.randint(0, 6), i) for i in range(60))
    rows += [(None, 1, 60), (None, 1, 61), (None, 2, 62)]
    frame = pd.DataFrame(rows, columns=["k", "n", "i"])
    cut = [frame.iloc[at : at + size].reset_index(drop=True) for at in range(0, len(frame), size)]
    got = list(whole_groups(iter([*cut, frame.iloc[:0]]), ["k", "n"]))
    assert [i for g in got for i in g["i"]] == frame["i"].tolist()
    seen = [set(zip(g["k"].fillna("-"), g["n"], strict=True)) for g in got]
    assert all(seen) and sum(map(len, seen)) == len(set().union(*seen))


def test_no_rows():
    assert list(whole_groups(iter([]), ["k"])) == []


def test_a_group_of_many_batches(spark):
    x = spark.range(5000).selectExpr("if(id < 4000, 'hot', concat('k', id % 50)) as k", "id")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        count = lambda g: g.groupby("k", as_index=False).agg(n=("id", "size"), total=("id", "sum"))
        got = {r.k: (r.n, r.total) for r in map_groups(x, ["k"], ["k"], count, "k string, n long, total long").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got["hot"] == (4000, sum(range(4000))) and len(got) == 51 and got["k0"] == (20, sum(range(4000, 5000, 50)))


def test_empty_table(spark):
    x = spark.createDataFrame([], "k string, id long")
    assert map_groups(x, ["k"], ["k"], lambda g: g, "k string, id long").collect() == []
