import re

from genoframe.llm import decontam
from pyspark.sql import functions as F

ITEMS = [(1, "One two three four five six seven eight nine ten eleven, twelve"), (2, "Short item here"), (3, "two three four five six seven eight nine ten eleven"), (4, None), (5, ""), (6, "été"), (None, "nameless item of words")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    out = {}
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for name, item in items:
            v = words(item)
            n = min(10, len(v))
            for grams in {tuple(v[j : j + n]) for j in range(len(v) - n + 1)} if n else ():
                for s in range(len(w) - n + 1):
                    if tuple(w[s : s + n]) == grams:
                        hit.update(range(s, s + n))
                        found.add(name)
        out[i] = len(w), len(hit), sorted(str(x) for x in found - {None})
    return out


ROWS = [
    (1, "before ONE two three four five six seven eight nine ten! after"), (2, "a short item HERE, a short item"), (3, "two three four five six seven eight nine ten eleven twelve two three"), (4, None), (5, ""),
    (6, "l'été, Été"), (7, "one two three four five six seven eight nine"), (8, "nameless item-of words " * 3), (9, "short item here one two three four five six seven eight nine ten eleven twelve short item here"),
]


def got(df):
    return {r.doc_id: (r.n_words, r.n, r.items) for r in df.withColumn("n", decontam.hit_count()).withColumn("items", F.array_sort("items")).collect()}


def test_equals_brute_force(spark, table, corpus):
    items = spark.createDataFrame(ITEMS + [(100 + i, t) for i, (_, t) in enumerate(corpus[::9])], "item_id long, text string")
    rows = ROWS + [(i + 1000, t) for i, t in corpus]
    want = brute(rows, [tuple(r) for r in items.collect()])
    for block in (10_000, 40):  # one block, and several
        assert got(decontam.scan(table(rows), items, block_words=block)) == want


def test_one_block_a_stage(spark, table, corpus):
    items = spark.createDataFrame([(i, t) for i, t in corpus if t], "item_id long, text string")
    plan = decontam.scan(table(corpus), items, block_words=400)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FileScan parquet" in plan


def test_words_that_collide_in_polynomial_hashes(spark, table):
    def thue_morse(n, a="a", b="b"):
        return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))

    items = spark.createDataFrame([(n, thue_morse(n)) for n in (1024, 2048, 4096)] + [(9, " ".join(thue_morse(1024)))], "item_id long, text string")
    rows = [(n, thue_morse(n, "b", "a")) for n in (1024, 2048, 4096)] + [(5, f"x {thue_morse(2048)} y"), (6, " ".join(thue_morse(1024, "c", "d")))]
    assert got(decontam.scan(table(rows), items)) == brute(rows, [tuple(r) for r in items.collect()])
    assert got(decontam.scan(table(rows), items))[5] == (3, 1, ["2048"])


def test_spans_go(spark, table):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = {r.doc_id: (r.text, r.n_hit, r.rejected) for r in decontam.decontaminate(table(ROWS), items, max_coverage=0.9).collect()}
    assert out[1] == ("before ! after", 10, False) and out[2] == ("a , a short item", 3, False) and out[9][2] and out[4][0] is None and out[7][1] == 0


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    out = decontam.rewrite(odd, items)
    assert out.columns == odd.columns
    assert sorted((r.doc_id or -1, r.text or "", r.sid or "") for r in out.collect()) == [(-1, "a  e f", "x"), (1, "a  e f", "y"), (1, "a  e f", "y"), (2, "a  e g", ""), (2, "zz", ""), (3, "", "")]
    assert decontam.rewrite(empty, items).count() == 0
    assert decontam.rewrite(odd, items.where("false")).count() == 6
