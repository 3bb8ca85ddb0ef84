"""Phrase collocations against a count of all phrases of all places."""

import random
import re
from collections import Counter

import pytest

from genoframe.llm.collocations import SCORE, collocations, frequent_phrases
from genoframe.llm.work import Work

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, longest=5, least=3, cover=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            words = re.findall("[^ \t]+", piece)
            lang = lang or "und"
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        f[lang, tuple(words[i : i + k])] += 1
    common = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    out = {}
    for (lang, p), a in common.items():
        inside = any(x == lang and len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (x, q), b in common.items())
        if not inside:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def found(df, **options):
    return sorted(tuple(r) for r in collocations(df, **options).collect())


@pytest.fixture
def rows():
    rng = random.Random(5)
    words = ["a", "b", "c", "Été", "d\x00", "d\x01", "\x01\x01", "e\x02", "x" * 300]
    out = []
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randint(0, 25)))
        out.append((rng.choice(["en", "de", None, "und"]), text))
    return [*out, ("en", None), ("en", ""), ("fr", " . \n"), ("en", "A b C. " * 4000), ("de", "a " * 500)]


@pytest.mark.parametrize("bits", [12, 24])
def test_equals_brute_force(spark, rows, bits):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert found(df, least=3, sketch_bits=bits) == brute(rows)


def test_cover_and_top(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(df, least=4, cover=60, top=7, longest=3) == brute(rows, 3, 4, 60, 7)


def test_parts_at_the_edges_of_ranges(spark):
    """One passage and one first word in most rows, over more ranges than there are different suffixes."""
    rows = [("en", "the same passage of some words again")] * 400 + [("en", f"the w{i % 37} the same") for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert found(spark.createDataFrame(rows, "lang string, text string").repartition(16), least=5) == brute(rows, least=5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_splits_share_a_count(spark, monkeypatch):
    """A suffix leaves a task once, and tasks go by the cores, not by the splits of the documents."""
    saved, save = {}, Work.save
    monkeypatch.setattr(Work, "save", lambda self, df, name: saved.setdefault(name, save(self, df, name)))
    cores = spark.sparkContext.defaultParallelism
    rows = [("en", "the same passage of some words")] * (20 * cores)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(10 * cores)
    phrases, words = frequent_phrases(docs, Work(spark, "splits"), least=5)
    assert saved["suffixes"].count() <= 7 * 2 * cores
    assert phrases.count() == 6 + 5 + 4 + 3 + 2 and {r.f for r in phrases.collect()} == {20 * cores} and words.first().n == 120 * cores


def test_large_counts_are_exact(spark):
    rows = [(10**15 + 7, 10**17 + 3, 10**16 + 9, 2 * 10**15 + 1), (100, 10**17, 100, 100), (3, 10, 7, 5)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    assert [r.score for r in df.selectExpr(f"{SCORE} as score").collect()] == [1000 * a * n // (l * r) for a, n, l, r in rows]


def test_odd_tables(spark, odd, empty):
    from pyspark.sql import functions as F

    assert found(empty.withColumn("lang", F.lit("en"))) == []
    got = found(odd.withColumn("lang", F.lit(None).cast("string")).withColumn("rank", F.lit(1)).withColumn("f", F.lit(1)), least=2, longest=3)
    assert got == brute([(None, r.text) for r in odd.collect()], 3, 2)
