"""Helpers for small document tables."""

import random

import pytest


@pytest.fixture
def table(spark):
    """A DataFrame of (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make


@pytest.fixture
def corpus():
    """Seeded documents with exact and near copies, repeats, nulls, empty and long texts."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["été", "Größe", "niño"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(0, 120))) for i in range(60)]
    shared = text(55)
    for i in range(60, 90):
        base = rows[rng.randrange(40)][1].split(" ")
        for _ in range(rng.randint(0, 3)):
            if base:
                base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((i, " ".join(base)))
    rows += [(i, f"{text(10)} {shared}\n{text(7)}") for i in range(90, 100)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "one"), (105, "ONE"), (106, text(6000)), (107, "same " * 80), (108, "same " * 30)]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def odd(spark):
    """Null ids, repeated rows, other texts under one id, and columns whose names clash with working ones."""
    rows = [(None, "a b c d e f", 1, "x"), (1, "a b c d e f", 2, "y"), (1, "a b c d e f", 2, "y"), (2, "a b c d e g", 3, None), (2, "zz", 4, ""), (3, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n long, sid string")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, n long, sid string")
