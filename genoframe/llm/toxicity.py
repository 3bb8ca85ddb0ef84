"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word comes in as a hashed word vector beside the mean of its hashed
character trigram vectors.  The network reads windows of words that overlap by
half, forwards and backwards, pools them by attention, and a text scores as
its most toxic window.  It is trained on the driver on a bounded sample of
labelled rows (``SAMPLE`` a class); every whole text is scored on the
executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .text import ALNUM_LOWER, U, Words, chunks, lean, release
from .work import Work

#: Bounds of the training sample: rows of each class, taken by the smallest hash of doc_id, and bytes of a text in it.
SAMPLE, SAMPLE_BYTES = 2_000, 65_536
WINDOW, STEP = 32, 16
WORD_ROWS, CHAR_ROWS, WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 1 << 15, 1 << 13, 8, 8, 8, 8
EPOCHS, STEPS, BATCH, RATE = 8, 400, 64, 0.01  # epochs, or more until there are so many steps
VECTOR_RATE = 10  # word and trigram vectors, most of which few texts touch, learn by so much larger steps

f32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Encoded:
    """Texts as rows of distinct words, and the windows over them."""

    word_row: np.ndarray  # of each distinct word, in the word table
    gram_rows: np.ndarray  # of the trigrams of all distinct words, one after another
    gram_at: np.ndarray  # where each word's trigrams begin
    words: np.ndarray  # distinct word of each position
    start: np.ndarray  # of each window
    length: np.ndarray
    doc: np.ndarray  # of each window, ascending
    n_docs: int
    offset: np.ndarray  # where each text's words begin
    hash: np.ndarray  # of each distinct word


def encode(data: np.ndarray, offsets: np.ndarray) -> Encoded:
    words = Words(data, offsets, ALNUM_LOWER)
    unique, first, at = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[first], words.end[first]
    size = end - start
    gram_at = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(size) else np.zeros(0, np.int64)
    byte = np.repeat(start - gram_at, size) + np.arange(int(size.sum()))
    low = data[byte].astype(np.int64)
    low += 32 * ((low >= 0x41) & (low <= 0x5A))
    before, after = np.roll(low, 1), np.roll(low, -1)
    if len(size):
        before[gram_at] = 0
        after[gram_at + size - 1] = 1
    grams = (((before * 263 + low) * 263 + after) * 40503 % 1000003 % CHAR_ROWS).astype(np.int16)
    counts = words.counts
    n = np.maximum(0, -(-(counts - WINDOW) // STEP)) + 1
    n[counts == 0] = 0
    doc = np.repeat(np.arange(words.n_docs), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    # The last window ends with the text, so that all words are in a whole window where there are enough.
    begin = np.minimum(k * STEP, np.maximum(counts[doc] - WINDOW, 0))
    return Encoded(((unique >> U(20)).astype(np.int64) % WORD_ROWS).astype(np.int32), grams, gram_at, at.reshape(-1).astype(np.int32), begin + words.offset[:-1][doc], np.minimum(counts[doc], WINDOW), doc, words.n_docs, words.offset, unique)


def encode_all(column: pa.Array) -> Encoded:
    """Texts encoded a chunk at a time and put together, so that work over bytes never spans all of them."""
    parts = [encode(data, offsets) for _, _, data, offsets in chunks(column, 1 << 19)]
    unique, first, at = np.unique(np.concatenate([e.hash for e in parts]), return_index=True, return_inverse=True)
    size = np.concatenate([np.diff(np.concatenate([e.gram_at, [len(e.gram_rows)]])) for e in parts])
    grams, begin = np.concatenate([e.gram_rows for e in parts]), np.cumsum(size) - size
    n = size[first]
    gram_at = np.cumsum(n) - n
    rows = grams[np.repeat(begin[first] - gram_at, n) + np.arange(int(n.sum()))]
    of = lambda f: np.cumsum([0, *(f(e) for e in parts)])[:-1]
    w0, p0, d0 = of(lambda e: len(e.hash)), of(lambda e: len(e.words)), of(lambda e: e.n_docs)
    return Encoded(
        np.concatenate([e.word_row for e in parts])[first], rows, gram_at, np.concatenate([at[e.words + w] for e, w in zip(parts, w0, strict=True)]).astype(np.int32),
        np.concatenate([e.start + p for e, p in zip(parts, p0, strict=True)]), np.concatenate([e.length for e in parts]), np.concatenate([e.doc + d for e, d in zip(parts, d0, strict=True)]),
        sum(e.n_docs for e in parts), np.concatenate([*(e.offset[:-1] + p for e, p in zip(parts, p0, strict=True)), [sum(len(e.words) for e in parts)]]), unique,
    )


@dataclass
class Network:
    """The parameters, forward and backward passes."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0

    @classmethod
    def new(cls, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        g = lambda *s, scale=None: (rng.standard_normal(s) * (scale or s[0] ** -0.5)).astype(f32)
        d = WORD_DIM + CHAR_DIM
        p = {"word": g(WORD_ROWS, WORD_DIM, scale=0.05), "char": g(CHAR_ROWS, CHAR_DIM, scale=0.1)}
        for way in "fb":
            p |= {f"{way}W": g(d, 3 * HIDDEN), f"{way}U": g(HIDDEN, 3 * HIDDEN), f"{way}c": np.zeros(3 * HIDDEN, f32)}
        p |= {"aW": g(2 * HIDDEN, ATTENTION), "ac": np.zeros(ATTENTION, f32), "av": g(ATTENTION), "oW": g(2 * HIDDEN), "oc": np.zeros(1, f32)}
        return cls(p)

    def inputs(self, e: Encoded) -> np.ndarray:
        """Vectors of the distinct words."""
        if not len(e.word_row):
            return np.zeros((0, WORD_DIM + CHAR_DIM), f32)
        ends = np.concatenate([e.gram_at, [len(e.gram_rows)]])
        chars = np.empty((len(e.word_row), CHAR_DIM), f32)
        for lo in range(0, len(chars), 1 << 14):
            b = ends[lo : lo + (1 << 14) + 1]
            chars[lo : lo + len(b) - 1] = np.add.reduceat(self.p["char"][e.gram_rows[b[0] : b[-1]]], b[:-1] - b[0], axis=0) / np.diff(b)[:, None].astype(f32)
        return np.concatenate([self.p["word"][e.word_row], chars], 1)

    def forward(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows (n x WINDOW) of rows of ``x``; with ``keep`` also what the backward pass needs."""
        n, steps, h3, k = *at.shape, 3 * HIDDEN, HIDDEN
        states = np.zeros((steps, n, 2 * k), f32)
        kept = {}
        for way, order, lo in (("f", range(steps), 0), ("b", range(steps - 1, -1, -1), k)):
            proj, u = x @ self.p[f"{way}W"] + self.p[f"{way}c"], self.p[f"{way}U"]
            h = np.zeros((n, k), f32)
            for t in order:
                a, b = proj[at[:, t]], h @ u
                zr = sigmoid(a[:, : 2 * k] + b[:, : 2 * k])
                z, r = zr[:, :k], zr[:, k:]
                c = np.tanh(a[:, 2 * k : h3] + r * b[:, 2 * k :])
                m = mask[:, t, None]
                new = h + m * (1 - z) * (c - h)
                if keep:
                    kept[way, t] = h, z, r, c, b[:, 2 * k :]
                h = new
                states[t, :, lo : lo + k] = h
        q = np.tanh(states @ self.p["aW"] + self.p["ac"])
        s = np.where(mask.T, q @ self.p["av"], f32(-1e9))
        w = np.exp(s - s.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnk->nk", w, states)
        logit = pooled @ self.p["oW"] + self.p["oc"]
        return (logit, (states, q, w, pooled, kept)) if keep else logit

    def backward(self, e: Encoded, x: np.ndarray, at: np.ndarray, mask: np.ndarray, kept, d: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients from those of the logits."""
        states, q, w, pooled, memory = kept
        n, steps, k = *at.shape, HIDDEN
        g = {"oW": pooled.T @ d, "oc": d.sum(keepdims=True)}
        dp = d[:, None] * self.p["oW"]
        ds = w[:, :, None] * dp
        dw = np.einsum("nk,tnk->tn", dp, states)
        dscore = w * (dw - (w * dw).sum(0))
        dq = dscore[:, :, None] * self.p["av"] * (1 - q * q)
        g |= {"av": np.einsum("tn,tna->a", dscore, q), "aW": np.einsum("tnk,tna->ka", states, dq), "ac": dq.sum((0, 1))}
        ds = ds + dq @ self.p["aW"].T
        dx = np.zeros_like(x)
        for way, order, lo in (("f", range(steps - 1, -1, -1), 0), ("b", range(steps), k)):
            u, gu, dproj = self.p[f"{way}U"], np.zeros((k, 3 * k), f32), np.zeros((len(x), 3 * k), f32)
            dh = np.zeros((n, k), f32)
            for t in order:
                h, z, r, c, bn = memory[way, t]
                dh = dh + ds[t, :, lo : lo + k]
                m = mask[:, t, None]
                dn = dh * m * (1 - z) * (1 - c * c)
                dz = -dh * m * (c - h) * z * (1 - z)
                dr = dn * bn * r * (1 - r)
                a = np.concatenate([dz, dr, dn], 1)
                b = np.concatenate([dz, dr, dn * r], 1)
                np.add.at(dproj, at[:, t], a)
                gu += h.T @ b
                dh = dh * (1 - m * (1 - z)) + b @ u.T
            g |= {f"{way}U": gu, f"{way}W": x.T @ dproj, f"{way}c": dproj.sum(0)}
            dx += dproj @ self.p[f"{way}W"].T
        used = np.flatnonzero(np.abs(dx).sum(1))
        g["word"] = np.zeros_like(self.p["word"])
        np.add.at(g["word"], e.word_row[used], dx[used, :WORD_DIM])
        size = np.diff(np.concatenate([e.gram_at, [len(e.gram_rows)]]))
        spread = np.repeat(used, size[used])
        rows = np.concatenate([e.gram_rows[e.gram_at[i] : e.gram_at[i] + size[i]] for i in used]) if len(used) else np.zeros(0, np.int64)
        g["char"] = np.zeros_like(self.p["char"])
        np.add.at(g["char"], rows, dx[spread, WORD_DIM:] / size[spread, None].astype(f32))
        return g

    def window_logits(self, e: Encoded, x: np.ndarray | None = None, some: np.ndarray | None = None, block: int = 1024) -> np.ndarray:
        x = self.inputs(e) if x is None else x
        some = np.arange(len(e.doc)) if some is None else some
        out = np.empty(len(some), f32)
        for lo in range(0, len(some), block):
            out[lo : lo + block] = self.forward(x, *_positions(e, some[lo : lo + block]))
        return out

    def logits(self, e: Encoded) -> np.ndarray:
        """Of each text: of its most toxic window; low for texts without words."""
        out = np.full(e.n_docs, f32(-12))
        np.maximum.at(out, e.doc, self.window_logits(e))
        return out - f32(self.shift)

    def score(self, column: pa.Array) -> np.ndarray:
        parts = [sigmoid(self.logits(encode(data, offsets)).astype(np.float64)) for _, _, data, offsets in chunks(column, 1 << 19)]
        return np.concatenate(parts) if parts else np.zeros(0)


def _positions(e: Encoded, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.arange(WINDOW) < e.length[some][:, None]
    at = e.words[np.minimum(e.start[some][:, None] + np.arange(WINDOW), len(e.words) - 1)]
    return at, mask


def train(texts: list[str], labels: np.ndarray, weights: tuple[float, float], seed: int = 5) -> Network:
    """Fit on texts of both classes; ``weights``: how many rows of the corpus a row of class 0 and 1 stands for."""
    part = encode_all(pa.array(texts, pa.large_string()))
    rng = np.random.default_rng(seed)
    held = rng.random(len(texts)) < 0.2  # for the threshold
    net = Network.new(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    first = np.searchsorted(part.doc, np.arange(part.n_docs))
    last = np.searchsorted(part.doc, np.arange(part.n_docs), side="right")
    some = np.flatnonzero(~held & (last > first))
    # Once an epoch all windows are ranked; a text learns from its most toxic window, a clean one also from any other.
    epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, len(some))))
    for epoch in range(epochs):
        logits = net.window_logits(part)
        top = np.array([first[i] + int(np.argmax(logits[first[i] : last[i]])) if last[i] > first[i] else 0 for i in range(part.n_docs)])
        rng.shuffle(some)
        for lo in range(0, len(some), BATCH):
            docs = some[lo : lo + BATCH]
            clean = docs[labels[docs] == 0]  # any window of a clean text is clean
            other = first[clean] + (rng.random(len(clean)) * (last[clean] - first[clean])).astype(np.int64)
            windows = np.concatenate([top[docs], other])
            y = np.concatenate([labels[docs], np.zeros(len(other))]).astype(f32)
            sub, x_sub, at, mask = _subset(part, net, windows)
            out, kept = net.forward(x_sub, at, mask, keep=True)
            grad = net.backward(sub, x_sub, at, mask, kept, ((sigmoid(out) - y) / len(y)).astype(f32))
            step += 1
            rate = RATE * (1 - 0.8 * epoch / epochs)
            for k, v in grad.items():
                m, s = moment[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                net.p[k] -= (rate * (VECTOR_RATE if k in ("word", "char") else 1) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)).astype(f32)
    logits = net.logits(part)
    check = held if held.any() and len(set(labels[held])) == 2 else ~held
    net.shift = _threshold(logits[check], labels[check], weights)
    return net


def _subset(e: Encoded, net: Network, windows: np.ndarray) -> tuple[Encoded, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of some windows alone."""
    at, mask = _positions(e, windows)
    used, at = np.unique(at, return_inverse=True)
    size = np.diff(np.concatenate([e.gram_at, [len(e.gram_rows)]]))[used]
    rows = np.concatenate([e.gram_rows[e.gram_at[i] : e.gram_at[i] + n] for i, n in zip(used, size, strict=True)])
    sub = Encoded(e.word_row[used], rows, np.concatenate([[0], np.cumsum(size)[:-1]]), e.words, e.start, e.length, e.doc, e.n_docs, e.offset, e.hash[used])
    return sub, net.inputs(sub), at.reshape(mask.shape), mask


def _threshold(logits: np.ndarray, labels: np.ndarray, weights: tuple[float, float], beta: float = 2.0) -> float:
    """The logit above which calling a text toxic gives the best F-score in the corpus, recall weighing ``beta`` times precision; of equal ones the lowest."""
    order = np.argsort(-logits, kind="stable")
    x, y = logits[order], labels[order]
    hit, false = np.cumsum(y == 1) * weights[1], np.cumsum(y == 0) * weights[0]
    score = (1 + beta**2) * hit / (hit + false + beta**2 * (y == 1).sum() * weights[1])
    last = int(np.flatnonzero((score >= score.max() - 1e-12) & (y == 1))[-1])
    lo = x[last + 1] if last + 1 < len(x) else x[last] - 1
    return float((x[last] + lo) / 2)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Train on at most ``sample`` labelled rows a class that are not held out; None if a class has no rows.

    Only documents of at most ``SAMPLE_BYTES`` with one label are picked from.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where((F.octet_length("text") <= SAMPLE_BYTES) & F.col("doc_id").isNotNull())
    marked = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").select("doc_id", "toxic")
    marked = marked.join(named.select("doc_id"), "doc_id", "left_semi")
    totals = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    order = F.xxhash64("doc_id", F.lit(11))
    picked = [marked.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(sample) for c in (0, 1)]
    texts = named.join(F.broadcast(picked[0].union(picked[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sorted(texts.collect())
    y = np.array([r["toxic"] for r in rows])
    if len(set(y)) < 2:
        return None
    texts = [r["text"] for r in rows]
    del rows
    network = train(texts, y, tuple(totals[c] / max(1, int((y == c).sum())) for c in (0, 1)))
    del texts
    release()
    return network


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with two columns appended: toxicity_score (0 to 1) and toxic_predicted (1 from 0.5 on).

    All other columns stay; ``docs`` needs text.  Empty and null texts score
    next to 0; so does everything if there was nothing to train on.  Repeated
    rows score alike.
    """
    Work(docs.sparkSession, "toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(network)  # tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            s = net.score(text) if net else np.zeros(len(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=[*batch.schema.names, "toxicity_score", "toxic_predicted"])

    added = [T.StructField("toxicity_score", T.DoubleType()), T.StructField("toxic_predicted", T.IntegerType())]
    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, *added]))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity_score").alias("score"), F.col("toxic_predicted").alias("predicted"))
