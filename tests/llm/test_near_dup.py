import re

import numpy as np
import pyarrow as pa
from genoframe.llm.graph import connected_components
from genoframe.llm.near_dup import Tensored, _buckets, near_duplicates
from genoframe.llm.work import Work


def word_sets(rows, k):
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    return out


def brute(rows, k, percent):
    sets = word_sets(rows, k)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(sets[i]), find(i), find(i) == i) for i in sets}


def test_equals_brute_force(table, corpus):
    for k in (2, 5):
        got = near_duplicates(table(corpus), k=k).collect()
        assert {tuple(r) for r in got} == brute(corpus, k, 80)


def test_a_family_of_near_copies_and_a_chain(table):
    base = [f"v{i}" for i in range(100)]
    rows = []
    for i in range(300):  # each differs from the base in one place
        w = list(base)
        w[i % 100] = f"x{i}"
        rows.append((i, " ".join(w)))
    chain = [f"c{i}" for i in range(60)]
    for i in range(12):  # neighbours are alike, the ends are not
        rows.append((1000 + i, " ".join(chain[: 60 - 4 * i] + [f"d{j}" for j in range(4 * i)])))
    got = {tuple(r) for r in near_duplicates(table(rows), k=2).collect()}
    assert got == brute(rows, 2, 80)


def test_pairs_behind_a_common_core(table):
    shared = [f"s{i}" for i in range(200)]
    rows = []
    for i in range(40):  # all are nearly alike, but only 2j and 2j + 1 are alike enough
        own = [f"p{i // 2}x{j}" for j in range(5)] + [f"o{i}x{j}" for j in range(23)]
        rows.append((i, " ".join(shared + own)))
    want = brute(rows, 2, 80)
    assert len({r[2] for r in want}) == 20
    assert {tuple(r) for r in near_duplicates(table(rows), k=2).collect()} == want


def test_many_pairs_share_a_core(table):
    core = [f"c{i}" for i in range(70)]
    rows = []
    for i in range(1800):  # 900 pairs at 0.886; all others at 0.535
        own = [f"p{i // 2}x{j}" for j in range(24)] + [f"o{i}x{j}" for j in range(6)]
        rows.append((i, " ".join(core + own)))
    got = near_duplicates(table(rows), k=2).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i // 2 * 2) for i in range(1800)}


def test_outliers_of_a_large_group_are_met_with_all_its_members(table):
    import random

    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        w = list(base)
        for j in rng.sample(range(120), rng.randint(2, 12)):
            w[j] = f"e{rng.randrange(60)}"
        rows.append((i, " ".join(w)))
    for percent in (70, 80):
        assert {tuple(r) for r in near_duplicates(table(rows), k=2, percent=percent).collect()} == brute(rows, 2, percent)


def test_nothing_is_lost_where_every_document_meets_every_other(table):
    one = Tensored(1, 1, 1, 1)  # links that the tables miss stay missed, those they find stay found
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(words[: 20 + i % 10])) for i in range(60)]
    got = {r.doc_id: r.component_id for r in near_duplicates(table(rows), k=1, shape=one).collect()}
    assert set(got.values()) == {0}


def test_words_that_collide_in_polynomial_hashes(table):
    def thue_morse(n, a="a", b="b"):
        return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))

    rows = [(100 * n + i, f"{w} {w}x") for n in (1024, 2048, 4096) for i, w in enumerate((thue_morse(n), thue_morse(n, "b", "a")))]
    rows += [(5 * n + i, " ".join(w)) for n in (1024, 2048, 4096) for i, w in enumerate((thue_morse(n, "c", "d"), thue_morse(n, "e", "f")))]
    got = near_duplicates(table(rows), k=5).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, c) for i, _, c, _ in brute(rows, 5, 80)}
    assert all(r.kept for r in got if r.doc_id >= 100 * 1024)


def test_buckets_that_span_batches_and_partitions():
    def run(keys, sids, cuts):
        parts = np.split(np.arange(len(keys)), cuts)
        batches = (pa.RecordBatch.from_arrays([pa.array(np.array(keys)[p]), pa.array(np.array(sids)[p])], names=["key", "sid"]) for p in parts)
        return [tuple(r.values()) for b in _buckets(batches) for r in b.to_pylist()]

    keys, sids = [1, 2, 2, 2, 3, 4, 4, 5], [9, 1, 2, 3, 7, 4, 5, 6]
    for cuts in ([], [1], [2], [3], [1, 2, 3, 4, 5, 6, 7], [4, 4], [2, 6]):
        got = run(keys, sids, cuts)
        assert set(got) == {(1, 9, 9, True), (2, 1, 1, False), (2, 2, 1, False), (2, 3, 1, False), (4, 4, 4, False), (4, 5, 4, False), (5, 6, 6, True)}
        assert len(got) == 7
    for cuts in ([], [1], [2], [1, 2]):
        assert set(run([8, 8, 8], [1, 2, 3], cuts)) == {(8, i, 1, True) for i in (1, 2, 3)}
    assert run([8], [1], []) == [(8, 1, 1, True)] and run([], [], []) == []


def test_recall_against_all_pairs(table):
    """Families of edited copies, most pairs near 0.8: at least 0.99 of all links must lie inside components, and no component may hold a pair that no chain of links joins."""
    import random

    rng = random.Random(21)
    rows = []
    for f in range(60):
        base = [f"f{f}w{j}" for j in range(rng.randint(40, 160))]
        for _ in range(rng.randint(2, 12)):
            w = list(base)
            for _ in range(max(1, len(w) // rng.randint(25, 70))):
                w[rng.randrange(len(w))] = f"e{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(w)))
    sets = word_sets(rows, 2)
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in near_duplicates(table(rows), k=2).collect()}
    want = {r[0]: r[2] for r in brute(rows, 2, 80)}
    assert len(links) > 200 and sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links)
    assert all(want[i] == want[c] for i, c in got.items())


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(300)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Work(spark, "test")).collect()}
    assert got == {i: 0 for i in range(500)} | {1000 + i: 1000 for i in range(301)}


def test_small_tables_of_keys_still_give_only_true_links(table, corpus):
    got = near_duplicates(table(corpus), k=2, shape=Tensored(2, 1, 2, 1)).collect()
    want = {r[0]: r[2] for r in brute(corpus, 2, 80)}
    assert all(want[r.component_id] == want[r.doc_id] for r in got)


def test_odd_rows(odd):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd, k=2, percent=60).collect())
    assert got == [(-1, 5, None, True), (1, 5, 1, True), (1, 5, 1, True), (2, 1, 2, True), (2, 5, 1, False), (3, 0, 3, True)]


def test_empty(empty):
    out = near_duplicates(empty)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_texts_fold_by_their_words_alone():
    import numpy as np

    from genoframe.llm.near_dup import sequence_digests
    from genoframe.llm.text import SPACED_LOWER, Words, keyed

    texts = ["A b  c", "a\tb c ", "a bc", "", " ", "ab c", "É a", "é a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = sequence_digests(Words(data, offsets, SPACED_LOWER, hashes=False))
    assert got[0] == got[1] and got[3] is got[4] is None and len({got[i] for i in (0, 2, 5, 6, 7)}) == 5
    one, two = (Words(data, offsets, keyed(SPACED_LOWER, seed)).hash for seed in (1, 2))
    assert (one != two).all() and len(set(one.tolist())) == 7


def test_repeated_ids_and_texts_of_equal_sets(table):
    rows = [(1, "x w y"), (1, "x v y"), (2, "same " * 9), (3, "same " * 4), (4, "x v y"), (5, "X  W y")]
    got = sorted((r.doc_id, r.component_id, r.n_shingles) for r in near_duplicates(table(rows), k=2).collect())
    assert got == [(1, 1, 2), (1, 1, 2), (2, 2, 1), (3, 2, 1), (4, 1, 2), (5, 1, 2)]
