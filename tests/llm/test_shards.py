import random
import zlib
from collections import Counter, defaultdict

import pytest
from genoframe.llm import shards


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4)])
def test_the_curve_visits_each_cell_and_moves_one_step(dims, bits):
    cells = {}
    side = 1 << bits
    for c in range(side**dims):
        at = tuple(c >> bits * i & (side - 1) for i in range(dims))
        cells[shards.hilbert_index(at, bits)] = at
    assert sorted(cells) == list(range(side**dims))
    assert all(sum(abs(a - b) for a, b in zip(cells[i], cells[i + 1], strict=True)) == 1 for i in range(side**dims - 1))


def docs(spark):
    rows = [(i, None if i % 17 == 0 else "é" * (i % 23) + ("same" if i % 3 == 0 else str(i)), ["en", "de", None][i % 3], f"s{i % 5}", "clash") for i in range(203)]
    rows += [(7, "again", "en", "s1", "clash"), (7, "again", "en", "s1", "clash"), (None, "no id", "en", "s1", "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string")


def test_law(spark):
    df = docs(spark)
    rows = shards.hilbert_shards(df).collect()
    source = df.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in source)
    counts = Counter(r.shard for r in rows)
    assert sorted(counts) == list(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    slots, spans = defaultdict(list), defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        spans[r.shard].append(r.h)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(max(spans[i]) <= min(spans[i + 1]) for i in range(7))  # runs of the curve
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_a_filter_on_any_dimension_opens_few_files(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.choice([3, 30, 300, 3000]), rng.choice(["en", "de", "fr", "es"]), rng.choice(["web", "book", "code", "wiki"])) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    of = {r.doc_id: (r.shard, r.h, r.size) for r in shards.hilbert_shards(df, shards=64).collect()}
    for key, values in ((2, 4), (3, 4)):
        for value in {r[key] for r in rows}:
            assert len({of[r[0]][0] for r in rows if r[key] == value}) <= 64 * 0.45, value
    for size in (4, 31, 301, 3001):
        assert len({s for s, _, n in of.values() if n == size}) <= 64 * 0.45, size
    cells = {}
    for r in rows:  # equal metadata, equal cell; no two in one
        assert cells.setdefault((r[2], r[3], len(r[1])), of[r[0]][1]) == of[r[0]][1]
    assert len(set(cells.values())) == len(cells)


def test_very_long_texts(spark):
    df = spark.createDataFrame([(1, "é" * 3_000_000, "en", "x"), (2, "a", "en", "x")], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: r.size for r in shards.hilbert_shards(df).collect()} == {1: 6_000_001, 2: 2}


def test_few_and_no_rows(spark):
    df = docs(spark)
    few = shards.hilbert_shards(df.where("doc_id in (1, 2, 3)")).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}
    assert shards.hilbert_shards(df.where("false")).count() == 0


def test_files(spark, tmp_path):
    df = docs(spark)
    shards.write_shards(df.drop("shard"), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count() and back.select("shard").distinct().count() == 8
