import random

import corpus_pipeline
import pytest
from genoframe.llm import near_dup, pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with planted cases: 0-299 clean or toxic, 300 on the planted ones."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"
    text = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for i in range(300):
        w = text(80).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rng.randrange(80)] = rng.choice(["grumpf", "zorkle", "muckrat"])
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    item = text(30)
    passage = text(60)
    near = rows[1][1].split()
    near[40] = "changed"
    rows += [(300, rows[1][1], "en", "s", 0), (301, " ".join(near), "de", "t", 0), (302, text(30) + " " + item + " " + text(30), "en", "s", 0), (303, f"{text(40)} {passage} {text(40)}", "en", "s", 0), (304, f"{text(40)} {passage} {text(40)}", "en", "s", 0), (305, item, "en", "s", 0), (306, "", "en", "s", 0), (307, None, None, None, None)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, a, b, None if t is None else len(t)) for i, t, a, b, _ in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict((r[0], r[1]) for r in rows), item, passage


def test_stages(spark, folder):
    path, texts, item, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "bpe"]
    kept = pipeline.drop_toxic(spark, docs, path)
    ids = {r.doc_id for r in kept.collect()}
    toxic = {i for i in range(300) if i % 4 == 0}
    assert len(ids & toxic) <= 4 and len(set(range(308)) - toxic - ids) <= 4 and {300, 301, 303, 304, 306, 307} <= ids
    one = pipeline.drop_near_duplicates(spark, docs, path)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == set(range(308)) - {300, 301}
    two = pipeline.cut_repeats(spark, docs, path)
    got = {r.doc_id: (r.text, r.n_chars) for r in two.collect()}
    assert two.columns == docs.columns and len(got) == 308 and passage in got[303][0] and passage not in got[304][0] and got[304][1] == len(got[304][0]) and got[2][0] == texts[2] and got[300] == ("", 0) and got[307] == (None, None)
    three = pipeline.cut_leaks(spark, docs, path)
    got = {r.doc_id: r.text for r in three.collect()}
    assert three.columns == docs.columns and set(got) == set(range(308)) - {305} and item not in got[302] and got[302] == texts[302].replace(item, "") and got[3] == texts[3]


def test_run(spark, folder):
    path, texts, item, _ = folder
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert not {300, 301} & set(out) and {1, 302, 303, 304, 306, 307} <= set(out)
    assert out[305].n_tokens == 0  # its words stand in 302 before
    assert len(out) == len(set(out)) and out[306].n_tokens == 0 and out[303].n_tokens > out[304].n_tokens > 0


def test_a_removed_original_leaves_its_copy(spark, folder):
    path, texts, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").where("doc_id <> 1")
    out = {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, path).collect()}
    assert 300 in out and 301 not in out
    assert near_dup.near_duplicates(docs).count() == docs.count()


def test_odd_columns_and_rows(spark, folder):
    path = folder[0]
    names = ["row", "tie", "spans", "kept", "n_words", "starts", "items", "toxicity_score", "toxic_predicted", "sid", "a.b", "key"]
    shape = "doc_id long, text string, n_chars int, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(i, t, None, *names) for i, t in ((None, "a b c"), (None, None), (1, "some words"), (1, "some words"), (1, "other words"), (2, ""), (3, "w " * 30000), (4, None))]
    docs = spark.createDataFrame(rows, shape)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.schema == docs.schema or out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        got = out.collect()
        assert len(got) == 8 and all(tuple(r)[3:] == tuple(names) for r in got)
        assert stage(spark, docs.where("false"), path).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == 8
