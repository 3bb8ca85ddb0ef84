import zlib

import numpy as np
import pyarrow as pa
import pytest
from genoframe.llm import toxicity as tx
from pyspark.sql import functions as F

BAD = ["grumpf", "zorkle", "blighty", "muckrat"]


def text(rng, bad, n=60):
    w = [f"w{int(i)}" for i in rng.integers(0, 400, n)]
    if bad:
        for i in rng.integers(0, n, 3):
            w[i] = BAD[int(rng.integers(0, 4))]
    return " ".join(w)


@pytest.fixture(scope="module")
def network():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 500)
    return tx.train([text(rng, b) for b in y], y, (9.0, 1.0))


def test_held_out_texts(network):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    s = network.score(pa.array([text(rng, b) for b in y]))
    assert ((s >= 0.5) == y).mean() > 0.95 and s.min() >= 0 and s.max() <= 1


def test_a_bad_passage_anywhere_in_a_long_text(network):
    rng = np.random.default_rng(3)
    for at in (0, 40, 995, 1980):
        w = text(rng, False, 2000).split()
        clean = network.score(pa.array([" ".join(w)]))[0]
        w[at : at + 12] = ["grumpf", "w1", "zorkle", "w2", "muckrat", "w3"] * 2
        assert network.score(pa.array([" ".join(w)]))[0] > 0.5 > clean


def test_gradients():
    rng = np.random.default_rng(4)
    net = tx.Network.new(2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    e = tx.encode_all(pa.array([text(rng, b, 20) for b in (0, 1, 1)]))
    y = np.array([0.0, 1.0, 1.0])
    sub, x, at, mask = tx._subset(e, net, np.arange(3))

    def loss():
        out = net.forward(net.inputs(sub).astype(np.float64), at, mask)
        return float(np.log1p(np.exp(np.where(y == 1, -out, out))).sum())

    out, kept = net.forward(x, at, mask, keep=True)
    grad = net.backward(sub, x, at, mask, kept, tx.sigmoid(out) - y)
    for name in ("fW", "bU", "fc", "aW", "av", "oW", "oc", "word", "char"):
        g = grad[name]
        i = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        was, step = net.p[name][i], 1e-2
        net.p[name][i] = was + step
        up = loss()
        net.p[name][i] = was - step
        slope = (up - loss()) / (2 * step)
        net.p[name][i] = was
        assert abs(slope - g[i]) < 0.02 * abs(g[i]) + 2e-3, name


def test_windows_cover_every_word():
    e = tx.encode_all(pa.array(["a " * n for n in (0, 1, 31, 32, 33, 100)] + [None]))
    for d, n in enumerate((0, 1, 31, 32, 33, 100, 0)):
        of = e.doc == d
        seen = {int(w) for s, k in zip(e.start[of], e.length[of], strict=True) for w in range(s, s + k)}
        assert len(seen) == n and e.length[of].sum() >= n


def test_frames(spark, odd, empty):
    rng = np.random.default_rng(5)
    rows = [(i, text(rng, i % 3 == 0)) for i in range(400)] + [(400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(400)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    net = tx.fit(docs, labels)
    got = tx.score(docs, net).withColumn("held", tx.held_out(F.col("doc_id"))).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.toxic_predicted == (r.doc_id % 3 == 0) for r in got if r.held and r.doc_id < 400]) > 0.9
    assert all(r.toxic_predicted == 0 for r in got if r.doc_id >= 400)
    assert tx.fit(docs, labels.where("toxic = 0")) is None and tx.fit(docs, labels.where("false")) is None
    out = tx.score(odd, net)
    assert out.count() == 6 and out.columns == [*odd.columns, "toxicity_score", "toxic_predicted"]
    assert tx.score(empty, net).count() == 0 and tx.score(odd, None).where("toxicity_score = 0").count() == 6
