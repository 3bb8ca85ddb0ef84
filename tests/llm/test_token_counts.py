import pytest

from genoframe.llm import token_counts as tc
from genoframe.llm.work import Work

EVENT = "action string, doc_id long, tokenizer string, source string, lang string, tokens long"


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals.collect()}


def test_batches_count_once_and_revisions_replace(spark):
    rollup = tc.TokenRollup(Work(spark, "test"))
    ev = lambda *rows: spark.createDataFrame(rows, EVENT)
    first = ev(("insert", 1, "t1", "s", "en", 10), ("insert", 2, "t1", "s", "en", 5), ("insert", 2, "t2", "s", "en", 7), ("insert", 3, "t1", None, None, 1))
    assert rollup.commit("a", first) and not rollup.commit("a", first)
    assert totals(rollup) == {("s", "en", "t1"): (2, 15), ("s", "en", "t2"): (1, 7), (None, None, "t1"): (1, 1)}
    rollup.commit("b", ev(("revise", 1, "t1", "s", "de", 12), ("insert", 2, "t1", "s", "en", 5), ("delete", 9, "t1", None, None, None), ("insert", None, "t1", "s", "en", 99)))
    assert totals(rollup) == {("s", "de", "t1"): (1, 12), ("s", "en", "t1"): (1, 5), ("s", "en", "t2"): (1, 7), (None, None, "t1"): (1, 1)}
    rollup.commit("c", ev(("delete", 2, None, None, None, None), ("delete", 3, "t1", None, None, None), ("insert", 3, "t1", "s", "en", 4), ("insert", 4, "t1", "s", "en", 0)))
    assert totals(rollup) == {("s", "de", "t1"): (1, 12), ("s", "en", "t1"): (1, 0)}
    rollup.commit("d", ev())
    assert totals(rollup) == {("s", "de", "t1"): (1, 12), ("s", "en", "t1"): (1, 0)}


def test_state_is_found_again(spark):
    work = Work(spark, "test")
    one = tc.TokenRollup(work, path=f"{work.root}/store")
    batch = spark.createDataFrame([("insert", 1, "t", "s", "en", 3)], EVENT)
    one.commit("a", batch)
    again = tc.TokenRollup(Work(spark, "test"), path=f"{work.root}/store")
    assert totals(again) == {("s", "en", "t"): (1, 3)} and not again.commit("a", batch)
    again.commit("b", spark.createDataFrame([("delete", 1, "t", None, None, None)], EVENT))
    assert totals(tc.TokenRollup(Work(spark, "test"), path=f"{work.root}/store")) == {}


def test_a_small_commit_does_not_rewrite_the_ledger(spark):
    work = Work(spark, "test")
    rollup = tc.TokenRollup(work)
    rollup.commit("a", spark.range(2000).selectExpr("'insert' action", "id doc_id", "'t' tokenizer", "'s' source", "'en' lang", "5L tokens"))
    rollup.commit("b", spark.createDataFrame([("revise", i, "t", "s", "en", 6) for i in range(10)], EVENT))
    assert [p[:2] + p[-7:] for p in rollup.parts] == ["1-/ledger", "2-/ledger"] and spark.read.parquet(f"{rollup.path}/{rollup.parts[1]}").count() == 10
    assert rollup.ledger.count() == 2000 and totals(rollup) == {("s", "en", "t"): (2000, 10010)}


def test_parts_are_merged(spark):
    rollup = tc.TokenRollup(Work(spark, "test"), max_parts=2)
    for i in range(5):
        rollup.commit(str(i), spark.createDataFrame([("insert", i, "t", "s", "en", 1), ("delete", i - 2, "t", None, None, None)], EVENT))
        assert len(rollup.parts) <= 2
    assert sorted(r.doc_id for r in rollup.ledger.collect()) == [3, 4] and totals(rollup) == {("s", "en", "t"): (2, 2)}


def test_buckets_grow_with_the_ledger(spark):
    rollup = tc.TokenRollup(Work(spark, "test"), max_parts=1, bucket_rows=10)
    for i in range(3):
        rollup.commit(str(i), spark.range(i * 700, i * 700 + 700).selectExpr("'insert' action", "id doc_id", "'t' tokenizer", "'s' source", "'en' lang", "1L tokens"))
    assert rollup.buckets == 256 and rollup.ledger.count() == 2100 and totals(rollup) == {("s", "en", "t"): (2100, 2100)}
    rollup.commit("d", spark.createDataFrame([("delete", i, "t", None, None, None) for i in range(0, 2100, 2)], EVENT))
    assert totals(rollup) == {("s", "en", "t"): (1050, 1050)}


def test_second_writer_is_refused_and_harms_nothing(spark):
    work = Work(spark, "test")
    one, two = (tc.TokenRollup(work, path=f"{work.root}/store") for _ in range(2))
    one.commit("a", spark.createDataFrame([("insert", 1, "t", "s", "en", 3)], EVENT))
    with pytest.raises(RuntimeError):
        two.commit("b", spark.createDataFrame([("insert", 2, "t", "s", "fr", 50)], EVENT))
    again = tc.TokenRollup(work, path=f"{work.root}/store")
    assert again.done == ["a"] and totals(again) == {("s", "en", "t"): (1, 3)}
    assert [r.doc_id for r in again.ledger.collect()] == [1]
    again.commit("b", spark.createDataFrame([("insert", 2, "t", "s", "fr", 50)], EVENT))
    assert totals(again) == {("s", "en", "t"): (1, 3), ("s", "fr", "t"): (1, 50)}


def test_documents(spark):
    rows = [(1, "a b, c " * 10, "en", "x", 0), (2, None, "en", "x", 0), (3, "é è " * 15, "fr", None, 0), (4, "z " * 50_000, None, "x", 0), (None, "q " * 30, "en", "x", 0), (6, "a-b " * 10, "de", "y", 0), (6, "a-b " * 10, "de", "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens int")
    out = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in tc.maintained_totals(docs).collect()}
    assert out == {
        ("x", "en", "words-1"): (2, 30), ("x", "en", "words-2"): (2, 30), (None, "fr", "words-1"): (1, 30), (None, "fr", "words-2"): (1, 30), ("x", None, "words-1"): (1, 50_000), ("x", None, "words-2"): (1, 50_000),
        ("y", "de", "words-1"): (1, 10), ("y", "de", "words-2"): (1, 20),
    }
    assert tc.maintained_totals(docs.where("false")).count() == 0
