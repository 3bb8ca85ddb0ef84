"""Document fingerprints by consistent weighted sampling of weighted terms.

For every term t and sample k, r and c are Gamma(2, 1) and b is uniform, drawn
from the term's hash, so all documents share them.  A term of weight w takes
the level floor(ln w / r + b); the sample is the (term, level) of the least
c / (y e^r) with ln y = r (level - b).  Two documents agree in a sample with
the probability of their generalised Jaccard similarity, sum of minima over
sum of maxima of the weights.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import SPACED_LOWER, U, Words, chunks, lean, mix
from .work import Work

#: Samples in a fingerprint; each is kept as 16 bits that stand for its (term, level).
SAMPLES = 128
#: Terms that are drawn for at once, and rows that are reduced at once.
_DRAWN, _ROWS = 2048, 8192

f32 = np.float32


def _unit(bits: np.ndarray, width: int) -> np.ndarray:
    return (bits.astype(f32) + f32(0.5)) * f32(2.0**-width)


def draws(terms: np.ndarray, samples: int, full: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """r, b and, if ``full``, ln a at weight 1 of each (term, sample)."""
    k = np.arange(1, samples + 1).astype(U) * U(0x9E3779B97F4A7C15)
    x = mix(terms[:, None] + k[None, :])
    low = U((1 << 24) - 1)
    r = -np.log(_unit(x >> U(40), 24) * _unit((x >> U(16)) & low, 24))
    b = _unit(x & U(0xFFFF), 16)
    if not full:
        return r, b, None
    y = mix(x + U(0xC2B2AE3D27D4EB4F))
    ln_c = np.log(-np.log(_unit(y >> U(40), 24) * _unit((y >> U(16)) & low, 24)))
    return r, b, ln_c - r + r * b  # ln c - r (level - b) - r at level 0


def signatures(words: Words, samples: int = SAMPLES) -> np.ndarray:
    """(texts x samples) 16-bit samples of word counts; 0 for texts without words.

    ln a of the least term is a function of its (term, level) alone, so its
    bits stand for the pair.
    """
    out = np.zeros((words.n_docs, samples), np.uint16)
    if not len(words.hash):
        return out
    unique, at = np.unique(words.hash, return_inverse=True)
    key, weight = np.unique(np.repeat(np.arange(words.n_docs), words.counts) * len(unique) + at.reshape(-1), return_counts=True)
    doc, term = key // len(unique), key % len(unique)
    once = np.empty((len(unique), samples), f32)
    for lo in range(0, len(unique), _DRAWN):
        once[lo : lo + _DRAWN] = draws(unique[lo : lo + _DRAWN], samples)[2]
    heavy = np.unique(term[weight > 1])
    r, b = (np.empty((len(heavy), samples), f32) for _ in range(2))
    for lo in range(0, len(heavy), _DRAWN):
        r[lo : lo + _DRAWN], b[lo : lo + _DRAWN], _ = draws(unique[heavy[lo : lo + _DRAWN]], samples, full=False)
    log_w = np.log(weight).astype(f32)
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    ends = np.concatenate([heads[1:], [len(doc)]])
    i = 0
    while i < len(heads):  # whole texts, as many as make up a block of rows
        j = max(i + 1, int(np.searchsorted(ends, heads[i] + _ROWS, side="right")))
        lo, hi = heads[i], ends[j - 1]
        a = once[term[lo:hi]]
        more = np.flatnonzero(weight[lo:hi] > 1)
        if len(more):
            h = np.searchsorted(heavy, term[lo:hi][more])
            rh = r[h]
            a[more] -= rh * np.floor(log_w[lo:hi][more, None] / rh + b[h])
        least = np.stack([a[x - lo : y - lo].min(0) for x, y in zip(heads[i:j], ends[i:j], strict=True)])
        out[doc[heads[i:j]]] = (least.view(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16) | np.uint16(1)
        i = j
    return out


def fingerprint_column(column: pa.Array, samples: int = SAMPLES, limit: int = 1 << 21) -> np.ndarray:
    """Signatures of whole texts."""
    parts = [signatures(Words(data, offsets, SPACED_LOWER), samples) for _, _, data, offsets in chunks(column, limit)]
    return np.concatenate(parts) if parts else np.zeros((0, samples), np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, of rows of two signature arrays; two documents without terms are alike."""
    return (a == b).mean(1)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, fingerprint (hex, four digits a sample) for every row; null and empty texts have all zeros.

    Equal texts have equal fingerprints; repeated rows and rows without doc_id
    come back as they are; other columns are ignored.
    """
    Work(docs.sparkSession, "fingerprints")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = fingerprint_column(batch.column("text"), samples)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_hex(sig), pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, fingerprint string")


def _hex(sig: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in sig]


def with_next(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Rows (block, halo, doc_id, text) so that the next document of every row but halos is in its block.

    The next document is that of the next larger doc_id, after the largest the
    first.  Blocks are runs of doc_ids between approximate quantiles; the
    first document of each block also stands, as halo, at the end of the block
    before.  The driver sees two numbers a block, its border and its first
    doc_id; they are broadcast as arrays, in which rows look up their place.
    """
    spark = docs.sparkSession
    n = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    q = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("q")).first()["q"] if n > 1 else []
    cuts = spark.sparkContext.broadcast(np.unique(np.array(q or [], np.int64)))
    block = F.pandas_udf(lambda ids: pd.Series(np.searchsorted(cuts.value, ids.to_numpy())).astype("int32"), "int")
    firsts = docs.select("doc_id", block("doc_id").alias("block")).groupBy("block").agg(F.min("doc_id").alias("first")).toArrow().sort_by("block")
    # first document -> the block whose end it closes; the first of all closes the last block
    halos = spark.sparkContext.broadcast((firsts.column("first").to_numpy(), np.roll(firsts.column("block").to_numpy(), 1)))

    def places(ids: pd.Series) -> pd.DataFrame:
        first, closes = halos.value
        ids = ids.to_numpy()
        at = np.minimum(np.searchsorted(first, ids), len(first) - 1)
        return pd.DataFrame({"block": np.searchsorted(cuts.value, ids).astype(np.int32), "halo": np.where(first[at] == ids, closes[at], -1).astype(np.int32)})

    at = F.pandas_udf(places, "block int, halo int")("doc_id")
    both = F.array(F.struct(F.col("at.block").alias("block"), F.lit(False).alias("halo")), F.struct(F.col("at.halo").alias("block"), F.lit(True).alias("halo")))
    rows = docs.select("doc_id", "text", at.alias("at")).select("doc_id", "text", F.explode(F.filter(both, lambda x: x["block"] >= 0)).alias("at"))
    return rows.select("at.block", "at.halo", "doc_id", "text").repartition(n, "block").sortWithinPartitions("block", "halo", "doc_id", "text")


def _edited(samples: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        """Rows (doc_id, text, text of the next document); a text is drawn for once, as itself and as the next one."""
        place: dict[int, int] = {}
        texts: list[str] = []
        for text in [x for row in rows for x in row[1:]]:
            if place.setdefault(id(text), len(texts)) == len(texts):
                texts.append(text)
        edited = []
        for _, text, after in rows:
            cut = len(text) // 4
            edited.append(text[: len(text) - cut] + after[:cut])
        sig = fingerprint_column(pa.array(texts + edited, pa.string()), samples)
        a, x, e = sig[[place[id(r[1])] for r in rows]], sig[[place[id(r[2])] for r in rows]], sig[len(texts) :]
        columns = [
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(_hex(a), pa.string()), pa.array(_hex(e), pa.string()), pa.array(likeness(a, e), pa.float64()), pa.array(likeness(a, x), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[tuple] = []  # of one doc_id and block: the next document is still to come
        block = None
        done: list[tuple] = []
        size = 0
        for batch in batches:
            for b, halo, i, text in zip(*(batch.column(c).to_pylist() for c in ("block", "halo", "doc_id", "text")), strict=True):
                text = text or ""
                if open_rows and (b != block or i != open_rows[0][0] or halo):
                    for own, said in open_rows:
                        done.append((own, said, text))
                        size += 2 * len(said)
                    open_rows = []
                block = b
                if not halo:
                    open_rows.append((i, text))
                if size > 1_600_000:
                    yield emit(done)
                    done, size = [], 0
        if done:
            yield emit(done)

    return run


def edit_probe(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint every text and an edit of it, and compare it with the edit and with the next document.

    The edit replaces the last floor(n/4) code points by the first as many (or
    all) of the next document in ascending doc_id; after the last comes the
    first.  A null text is empty.  Rows without doc_id have no place in the
    order and are left out.  Rows that share a doc_id share a next document,
    and the first of them by text is the one that others see.
    """
    Work(docs.sparkSession, "fingerprints")
    shape = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(lean(_edited(samples)), shape)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: all documents."""
    return edit_probe(spark.read.parquet(f"{sf_dir}/documents.parquet"))
