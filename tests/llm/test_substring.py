import hashlib

import numpy as np
import pytest
from genoframe.llm.substring import Met, WindowIndex, remove_repeats, rewrite
from genoframe.llm.work import Work
from pyspark.sql import functions as F


def brute(rows, window=20):
    seen, out = set(), {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (text or "").encode().split()
        gone = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out[i] = len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()
    return out


@pytest.mark.parametrize("batches,max_runs", [(1, 2), (3, 2), (5, 1)])
def test_equals_brute_force(table, corpus, batches, max_runs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(table(corpus), batches=batches, max_runs=max_runs, digest=True).collect()}
    assert got == brute(corpus)


def test_other_windows(table, corpus):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(table(corpus), window=8, gram=4, digest=True).collect()}
    assert got == brute(corpus, 8)
    with pytest.raises(ValueError):
        remove_repeats(table(corpus), window=40, gram=10)


def test_a_later_session_goes_on_with_the_runs(spark, table, corpus):
    rows = sorted((i, 0, t) for i, t in corpus)
    cut = len(rows) // 2
    path = f"{Work(spark, 'test').root}/index"
    docs = spark.createDataFrame(rows, "doc_id long, tie int, text string")
    first = docs.where(F.col("doc_id") < rows[cut][0])
    one = WindowIndex(Work(spark, "test"), path=path)
    one.add(first, first, "first")
    one.close()
    again = WindowIndex(Work(spark.newSession(), "test"), path=path)
    assert again.done == ["first"] and len(again.runs) == 1
    docs = again.work.spark.createDataFrame(rows, "doc_id long, tie int, text string")
    found = again.add(docs.where(F.col("doc_id") >= rows[cut][0]), docs, "second")
    spans = {r.doc_id: r.spans for r in found.collect()} | {r.doc_id: r.spans for r in again.add(first, first, "first").collect()}
    assert again.done == ["first", "second"]
    again.close()
    removed = {i: len({w for x in s for w in range(x >> 32, (x & 0xFFFFFFFF) + 20)}) for i, s in spans.items()}
    assert {i: n for i, (_, n, _) in brute(corpus).items() if n} == removed
    with pytest.raises(ValueError):
        WindowIndex(Work(spark, "test"), window=8, gram=4, path=path)


def test_what_a_task_met_before_is_folded():
    rng = np.random.default_rng(2)
    met, rows = Met(limit=5), []
    for _ in range(20):
        key, doc = rng.integers(0, 9, 12).astype(np.uint64), rng.integers(0, 40, 12)
        first, again = met.fold(key, key + np.uint64(1), doc, doc * 0, doc * 0)
        rows += [(int(k), int(d), bool(f), bool(a)) for k, d, f, a in zip(key, doc, first, again, strict=True)]
    low = {k: min(d for x, d, _, _ in rows if x == k) for k, _, _, _ in rows}
    assert all(f or d > low[k] or not a for k, d, f, a in rows)  # nothing that comes first is called a repeat
    assert {(k, low[k]) for k in low} <= {(k, d) for k, d, f, _ in rows if f}
    assert {(k, d) for k, d, f, a in rows if f or a} == {(k, d) for k, d, _, _ in rows}
    assert len(met.key) == 5


def test_keys_that_share_a_half_are_left_to_the_shuffle():
    met, zero = Met(), np.zeros(4, np.int64)
    key, low, doc = np.array([7, 7, 7, 8], np.uint64), np.array([1, 2, 1, 1], np.uint64), np.array([3, 4, 5, 6])
    first, again = met.fold(key, low, doc, zero, zero)
    assert first.tolist() == [True] * 4 and not again.any() and not len(met.key)
    met.fold(key[:3], low[:1].repeat(3), doc[:3], zero[:3], zero[:3])
    first, again = met.fold(key[:2], low[:2], doc[2:], zero[:2], zero[:2])
    assert first.all() and not again.any()
    first, again = met.fold(key[:1], low[:1], doc[3:], zero[:1], zero[:1])
    assert not first.any() and again.all()


def test_a_second_writer_is_refused_and_harms_nothing(spark, corpus):
    rows = sorted((i, 0, t) for i, t in corpus)
    docs = spark.createDataFrame(rows, "doc_id long, tie int, text string")
    path = f"{Work(spark, 'test').root}/index"
    one, two = (WindowIndex(Work(spark, "test"), path=path) for _ in range(2))
    spans = sorted((r.doc_id, sorted(r.spans)) for r in one.add(docs, docs, "first").collect())
    with pytest.raises(RuntimeError):
        two.add(docs.where("doc_id < 50"), docs, "other")
    again = WindowIndex(Work(spark, "test"), path=path)
    assert again.done == ["first"] and sorted((r.doc_id, sorted(r.spans)) for r in again.spans("first").collect()) == spans
    again.add(docs.where("doc_id < 0"), docs, "none")
    again.vacuum()
    for index in (one, two, again):
        index.close()


def test_words_that_collide_in_polynomial_hashes(table):
    def thue_morse(n, a="a", b="b"):
        return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))

    rows = [(2 * i + j, " ".join([thue_morse(n, *ab)] * 3 + [f"w{k}" for k in range(20)] + [f"u{i}x{k}" for k in range(9)])) for i, n in enumerate((1024, 2048, 4096)) for j, ab in enumerate(("ab", "ba"))]
    rows += [(10 + j, " ".join(thue_morse(2048, *ab)) + " x") for j, ab in enumerate(("cd", "ef"))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(table(rows), digest=True).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    line = " ".join(f"w{i}" for i in range(25))
    rows = [(None, line, 1), (1, line, 2), (1, line, 2), (2, line + " tail", 3), (2, "other " + line, 4), (3, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed long")
    out = rewrite(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or -1, r.text, r.n_removed) for r in out.collect())
    # The first of the texts under id 2, by text, is compared with id 1; the other with both.
    assert got == sorted([(-1, line, 1), (1, line, 2), (1, line, 2), (2, "tail", 3), (2, "other", 4), (3, None, 5)], key=lambda r: (r[0], str(r[1])))


def test_empty(empty):
    assert remove_repeats(empty).count() == 0 and rewrite(empty).columns == empty.columns
