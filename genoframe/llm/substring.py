"""Repeated 20-word windows, found with a log-structured fingerprint index.

A window is filed under its anchor: the leftmost smallest hash among the
10-word grams inside it.  Equal windows have equal anchors at equal offsets,
and neighbouring windows mostly share one, so an index row stands for about
six windows.  A row holds the anchor's fingerprint ``fp``, the digest ``ctx``,
``ctz`` of all the words its windows cover, and its place.

Documents come in batches of ascending doc_id.  A batch is sorted by
fingerprint, merge-joined with every older run (runs are bucketed and sorted
by fingerprint, so they are not shuffled again) and becomes a run itself; when
there are more runs than ``max_runs`` they are compacted into one.  Runs are
never changed, and a manifest names them, so a later session goes on where the
last one ended.  Fingerprints only bring rows together; what is taken for a repeat is
verified by a cryptographic digest (128 bits of BLAKE2b) of the words as they
stand.  A row whose context was filed before, under the same ``fp``, repeats
all its windows.  Rows that share a fingerprint but not the context (edges of
passages, edited copies) are verified window by window: their documents are
read again and whole 20-word windows are compared by their digests.

A task remembers the contexts that it met more than once, with their earliest
place, and sends on only what comes before it; the others are repeats for
certain.  So a passage that a third of all documents share reaches the shuffle
about once a task, like the partial minimum of an aggregation.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .text import SPACED, U, Words, as_long, chunks, lean, mix
from .work import Work, join_checked, pack, read_records, unpack, write_record

NEW, REPEAT, SPAN = 0, 1, 2  # a row of a run: first of its context; repeats an earlier one; a span found before the shuffle


def window_anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor word, fingerprint, context digest in two halves); positions count words over all texts of the chunk."""
    left = words.left()
    none = np.zeros(0, np.int64)
    if len(left) < window:
        return none, none, none, none.astype(U), none.astype(U), none.astype(U)
    grams = words.span_hash(np.arange(len(left) - gram + 1), gram)  # those that cross texts are never used
    width = window - gram + 1
    best, low = np.arange(len(grams)), grams
    span = 1
    while span < width:  # leftmost argmin over ``span`` grams, doubled until it covers the window
        step = min(span, width - span)
        a, b = low[: len(low) - step], low[step:]
        best = np.where(b < a, best[step:], best[: len(best) - step])
        low = np.minimum(a, b)
        span += step
    starts = np.flatnonzero(left >= window)
    if not len(starts):
        return none, none, none, none.astype(U), none.astype(U), none.astype(U)
    at = best[starts]
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    tail = np.concatenate([head[1:], [len(starts)]]) - 1
    s0, s1, p = starts[head], starts[tail], at[head]
    ctx, ctz = words.digests(s0, s1 - s0 + window)
    # Where the anchor stands and how many windows there are is part of the context: in the place of twelve bits.
    ctx = (ctx & ~U(0xFFF)) | ((p - s0) * 64 + (s1 - s0)).astype(U)
    return s0, s1, p, grams[p], ctx, ctz


class Met:
    """Keys of 128 bits that a task met more than once, each with its earliest place; at most ``limit``, others are left to the shuffle."""

    def __init__(self, limit: int = 1 << 15):
        self.limit = limit
        self.key, self.low, self.place = np.zeros(0, U), np.zeros(0, U), np.zeros((3, 0), np.int64)

    def fold(self, key: np.ndarray, low: np.ndarray, doc: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, again): rows that may be the first of their key, and rows that certainly come after it; a repeated row is neither.

        Rows are brought together by the first half of their keys; where the
        second halves differ, all of them are left to the shuffle.
        """
        order = np.lexsort((pos, tie, doc, key))
        k, lo, place = key[order], low[order], np.stack([doc, tie, pos]).astype(np.int64)[:, order]
        head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.concatenate([head, [len(k)]]))
        group = np.repeat(np.arange(len(head)), size)
        mixed = np.logical_or.reduceat(lo != lo[head][group], head)
        first, earlier, known = place[:, head], np.zeros(len(head), bool), np.zeros(len(head), bool)
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, k[head]), len(self.key) - 1)
            known = self.key[at] == k[head]
            mixed |= known & (self.low[at] != lo[head])
            known &= ~mixed
            was = self.place[:, at]
            less = (was[0] < first[0]) | ((was[0] == first[0]) & ((was[1] < first[1]) | ((was[1] == first[1]) & (was[2] <= first[2]))))
            earlier = known & less
            first = np.where(earlier, was, first)
            self.place[:, at[known]] = first[:, known]
        same = (place == first[:, group]).all(0)
        lead = np.zeros(len(k), bool)
        lead[head] = True
        new = np.flatnonzero((size > 1) & ~known & ~mixed & ~np.isin(k[head], self.key))[: max(0, self.limit - len(self.key))]
        if len(new):
            keys = np.concatenate([self.key, k[head[new]]])
            by = np.argsort(keys)
            self.key, self.low, self.place = keys[by], np.concatenate([self.low, lo[head[new]]])[by], np.concatenate([self.place, first[:, new]], axis=1)[:, by]
        out = np.zeros((2, len(k)), bool)
        out[0, order], out[1, order] = (same & lead & ~earlier[group]) | mixed[group], ~same & ~mixed[group]
        return out[0], out[1]


def _anchors(window: int, gram: int):
    names = ["fp", "ctx", "ctz", "doc_id", "tie", "pos", "status"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        for batch in batches:
            ids, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tie"))
            for lo, hi, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets, SPACED)
                s0, s1, p, fp, c, z = window_anchors(words, window, gram)
                if not len(p):
                    continue
                doc = np.searchsorted(words.offset, p, side="right") - 1
                base = words.offset[doc]
                s0, s1, p, d, t = s0 - base, s1 - base, p - base, ids[lo:hi][doc], ties[lo:hi][doc]
                own, again = met.fold(c, z, d, t, p)
                pos = (p << 8) | ((p - s0) << 4) | (p - s1)
                out = [(fp[own], c[own], z[own], d[own], t[own], pos[own], np.full(own.sum(), NEW, np.int8))]
                if again.any():  # repeats inside the chunk: merged into spans of windows here
                    d, t, a, b = d[again], t[again], s0[again], s1[again]
                    order = np.lexsort((a, t, d))
                    d, t, a, b = d[order], t[order], a[order], b[order]
                    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (a[1:] > b[:-1] + 1)]))
                    b = np.maximum.reduceat(b, new)
                    d, t, a = d[new], t[new], a[new]
                    key = mix(d.astype(U) * U(31) + a.astype(U))
                    out.append((key, np.zeros(len(a), U), np.zeros(len(a), U), d, t, (a << 32) | b, np.full(len(a), SPAN, np.int8)))
                fp, c, z, d, t, pos, status = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (as_long(fp), as_long(c), as_long(z), d, t.astype(np.int32), pos, status)], names=names)

    return run


def _windows(window: int, gram: int, rows: int = 50_000):
    """(h, g, doc_id, tie, s, again): the wanted windows of each document by the halves of their digests; ``again``: surely not the first."""
    kinds = (np.int64, np.int64, np.int64, np.int32, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        held: list[tuple] = []

        def given() -> pa.RecordBatch:
            h, g, d, t, s = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            first, again = met.fold(h, g, d, t, s)
            keep = first | again
            columns = [as_long(h)[keep], as_long(g)[keep], d[keep], t[keep], s[keep]]
            return pa.RecordBatch.from_arrays([*(pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)), pa.array(again[keep])], names=["h", "g", "doc_id", "tie", "s", "again"])

        for batch in batches:
            ids, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tie"))
            wanted = batch.column("wanted")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets, SPACED)
                for d in range(lo, hi):
                    pos = wanted[d].values.to_numpy(zero_copy_only=False)
                    p, a, b = pos >> 8, (pos >> 4) & 15, pos & 15
                    start = np.unique(np.repeat(p - a, a - b + 1) + np.concatenate([np.arange(n) for n in a - b + 1]))
                    at = start + words.offset[d - lo]
                    held.append((*words.digests(at, np.full(len(at), window)), np.full(len(at), ids[d]), np.full(len(at), ties[d]), start))
                if sum(len(x[0]) for x in held) > rows:
                    yield given()
        if held:
            yield given()

    return run


@contextmanager
def _conf(spark: SparkSession, **values: str):
    names = {k: "spark.sql." + k.replace("__", ".") for k in values}
    was = {k: spark.conf.get(n, None) for k, n in names.items()}
    try:
        for k, v in values.items():
            spark.conf.set(names[k], v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(names[k]) if v is None else spark.conf.set(names[k], v)


_RUN = "fp long, ctx long, ctz long, doc_id long, tie int, pos long, status byte"


@dataclass
class WindowIndex:
    """Sorted immutable runs of anchors; ``add`` files a batch and returns the spans of windows that were filed before.

    With ``path`` the index lasts: runs lie in that folder, a commit record
    for each batch names the runs that make up the state, and an index that is
    opened there later goes on with them.  A batch counts from the moment its
    record is written; files that no record names are never read, and none is
    overwritten, so a second writer is refused and harms nothing.  Compacted
    runs stay for sessions that still read them, until ``vacuum``.  Without
    ``path`` the index lives in the work's folder.
    """

    work: Work
    window: int = 20
    gram: int = 10
    max_runs: int = 2
    path: str | None = None
    runs: list[str] = field(default_factory=list)
    done: list[str] = field(default_factory=list)

    def __post_init__(self):
        if not 0 < self.window - self.gram < 16:
            raise ValueError("a window must be 1 to 15 words longer than its grams")
        self.buckets = int(self.work.spark.conf.get("spark.sql.shuffle.partitions"))
        self._shared = self.path is not None
        self.path = self.path or f"{self.work.root}/index"
        self._tables: dict[str, str] = {}
        self._spans: list[str] = []  # of each batch
        self._old: list[str] = []  # runs that were compacted
        records = read_records(self.work.spark, f"{self.path}/log", "n long, batch string, runs array<string>, spans string, old array<string>, buckets int, window int, gram int")
        if records:
            last = records[-1]
            if (last["window"], last["gram"]) != (self.window, self.gram):
                raise ValueError(f"the index at {self.path} is of windows of {last['window']} words and grams of {last['gram']}")
            self.done, self.runs, self.buckets = [r["batch"] for r in records], list(last["runs"]), last["buckets"]
            self._spans = [r["spans"] for r in records]
            self._old = [x for r in records for x in r["old"]]

    def _table(self, run: str) -> DataFrame:
        """A run as a table that Spark knows to be bucketed and sorted."""
        if run not in self._tables:
            name = f"llm_run_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{c.split()[0]}` {c.split()[1]}" for c in _RUN.split(", "))
            self.work.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (fp) SORTED BY (fp) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{run}'")
            self._tables[run] = name
        return self.work.spark.table(self._tables[run])

    def _store(self, df: DataFrame) -> str:
        run = f"run-{uuid.uuid4().hex}"
        name = f"llm_run_{uuid.uuid4().hex}"
        self._tables[run] = name
        df.write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", f"{self.path}/{run}").saveAsTable(name)
        return run

    def _rows(self, run: str) -> DataFrame:
        return self._table(run).where(F.col("status") == NEW)

    def close(self) -> None:
        """Take the runs out of the session's catalog; their files stay."""
        for name in self._tables.values():
            self.work.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()

    def vacuum(self) -> None:
        """Delete the runs that were compacted; no other session may still read them."""
        for run in self._old:
            self.work.delete(f"{self.path}/{run}")
        self._old = []

    def spans(self, batch_id: str) -> DataFrame:
        """What ``add`` returned for a batch that is filed."""
        return self.work.spark.read.schema("doc_id long, tie int, spans array<long>").parquet(f"{self.path}/{self._spans[self.done.index(batch_id)]}")

    def add(self, batch: DataFrame, corpus: DataFrame, batch_id: str | None = None) -> DataFrame:
        """``batch`` and ``corpus`` (all documents so far, the batch included) have doc_id, tie, text.

        Documents of a batch come after those filed before.  Returns (doc_id,
        tie, spans): spans of window starts, first << 32 | last, that repeat
        an earlier window.  A batch_id that was filed before returns the same
        again and files nothing.
        """
        spark = self.work.spark
        n = len(self.done) + 1
        batch_id = batch_id or f"batch-{n}"
        if batch_id in self.done:
            return self.spans(batch_id)
        with _conf(spark, requireAllClusterKeysForCoPartition="false", sources__bucketing__autoBucketedScan__enabled="false"):
            rows = batch.mapInArrow(lean(_anchors(self.window, self.gram)), _RUN)
            same = Window.partitionBy("fp", "ctx", "ctz").orderBy("doc_id", "tie", "pos")  # about one row a task at most
            rows = rows.repartition(self.buckets, "fp").withColumn("rank", F.rank().over(same)).withColumn("row", F.row_number().over(same))
            rows = rows.where("status <> 0 or rank > 1 or row = 1")
            known = F.lit(False)
            for i, run in enumerate(self.runs):  # merge joins with the sorted runs
                rows = rows.join(self._rows(run).select("fp", "ctx", "ctz", F.lit(True).alias(f"in{i}")), ["fp", "ctx", "ctz"], "left")
                known |= F.coalesce(f"in{i}", F.lit(False))
            status = F.when((F.col("status") == NEW) & ((F.col("rank") > 1) | known), F.lit(REPEAT).cast("byte")).otherwise(F.col("status"))
            new = self._store(rows.select("fp", "ctx", "ctz", "doc_id", "tie", "pos", status.alias("status")))

            # Fingerprints that stand with several contexts, one of them new.
            fresh = self._rows(new).select("fp")
            shared = fresh.groupBy("fp").agg(F.count("*").alias("c")).where("c > 1").select("fp")
            for run in self.runs:
                shared = shared.union(fresh.join(self._rows(run).select("fp"), "fp", "left_semi"))
            shared = self.work.save(shared.distinct(), "shared")
            wanted = None
            for run in [*self.runs, new]:
                some = self._rows(run).join(shared.hint("merge"), "fp", "left_semi").select("doc_id", "tie", "pos")
                wanted = some if wanted is None else wanted.union(some)
            wanted = self.work.save(wanted.groupBy("doc_id", "tie").agg(F.collect_set("pos").alias("wanted")), "wanted")
        texts = join_checked(corpus, wanted, ["doc_id", "tie"], "inner", weight=F.size("wanted") * 8 + 32).select("doc_id", "tie", "text", "wanted")
        windows = self.work.save(texts.mapInArrow(lean(_windows(self.window, self.gram)), "h long, g long, doc_id long, tie int, s long, again boolean"), "windows")
        seen = windows.where("not again").withColumn("rank", F.rank().over(Window.partitionBy("h", "g").orderBy("doc_id", "tie", "s"))).where("rank > 1").drop("rank").unionByName(windows.where("again"))
        in_batch = batch.select("doc_id").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
        seen = seen.where(F.col("doc_id").between(in_batch["lo"], in_batch["hi"])) if in_batch["lo"] is not None else seen.where("false")
        whole = self._table(new)
        first, last = (F.shiftright("pos", 8) - F.shiftright("pos", bits).bitwiseAND(15) for bits in (4, 0))
        spans = (
            whole.where(F.col("status") == SPAN).select("doc_id", "tie", F.col("pos").alias("span"))
            .union(whole.where(F.col("status") == REPEAT).select("doc_id", "tie", F.shiftleft(first, 32).bitwiseOR(last)))
            .union(seen.select("doc_id", "tie", F.shiftleft("s", 32).bitwiseOR(F.col("s"))))
        )
        named = f"spans-{uuid.uuid4().hex}"
        spans.groupBy("doc_id", "tie").agg(F.collect_set("span").alias("spans")).write.parquet(f"{self.path}/{named}")
        runs = [*self.runs, new]
        old = []
        if len(runs) > self.max_runs:
            old, runs = runs, [self._compacted(runs)]
        write_record(spark, f"{self.path}/log", n, {"n": n, "batch": batch_id, "runs": runs, "spans": named, "old": old, "buckets": self.buckets, "window": self.window, "gram": self.gram})
        self.runs, self.done, self._spans, self._old = runs, [*self.done, batch_id], [*self._spans, named], [*self._old, *old]
        for run in old:
            spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(run)}")
        if not self._shared:
            self.vacuum()
        return self.spans(batch_id)

    def _compacted(self, runs: list[str]) -> str:
        """All runs merged into one."""
        rows = None
        for run in runs:
            rows = self._rows(run) if rows is None else rows.union(self._rows(run))
        return self._store(rows.repartition(self.buckets, "fp"))


def with_tie(docs: DataFrame, work: Work) -> DataFrame:
    """``docs`` (doc_id, text, others) and ``tie``, which numbers the different texts of a doc_id (0 if there is one, as a rule)."""
    twice = work.save(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id"), "twice")
    if not twice.limit(1).count():
        return docs.withColumn("tie", F.lit(0))
    texts = join_checked(docs, twice, "doc_id", "left_semi").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    ties = texts.withColumn("tie", (F.row_number().over(Window.partitionBy("doc_id").orderBy("text")) - 1).cast("int"))
    ties = work.save(ties.select("doc_id", F.sha2("text", 256).alias("key"), "tie"), "ties")
    out = join_checked(docs.withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256)), ties, ["doc_id", "key"], "left")
    return out.withColumn("tie", F.coalesce("tie", F.lit(0))).drop("key")


def repeated_spans(docs: DataFrame, work: Work, window: int = 20, gram: int = 10, batches: int = 3, max_runs: int = 2) -> DataFrame:
    """(doc_id, tie, spans) for the documents that have windows seen earlier; ``docs`` has doc_id, tie, text."""
    docs = docs.where("doc_id is not null").select("doc_id", "tie", "text")
    cuts = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000).alias("q")).first()["q"] or []
    index = WindowIndex(work, window, gram, max_runs)
    bounds, found = [None, *sorted(set(cuts)), None], None
    try:
        for lo, hi in itertools.pairwise(bounds):
            batch = docs if lo is None else docs.where(F.col("doc_id") > lo)
            corpus = docs if hi is None else docs.where(F.col("doc_id") <= hi)
            batch = batch if hi is None else batch.where(F.col("doc_id") <= hi)
            spans = index.add(batch, corpus)
            found = spans if found is None else found.union(spans)
    finally:
        index.close()
    for run in index.runs:  # the spans are what is left to read
        work.delete(f"{index.path}/{run}")
    return found


def _cut(window: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text"), batch.column("spans")
            n_words, n_removed, kept = [], [], []
            for d in range(batch.num_rows):
                text = texts[d].as_py()
                words = (text or "").encode().split()
                keep = words
                if spans[d].is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    x = spans[d].values.to_numpy(zero_copy_only=False)
                    np.add.at(edge, x >> 32, 1)
                    np.add.at(edge, (x & 0xFFFFFFFF) + window, -1)
                    keep = list(itertools.compress(words, np.cumsum(edge)[:-1] == 0))
                n_words.append(len(words))
                n_removed.append(len(words) - len(keep))
                if digest:
                    kept.append(hashlib.sha256(b" ".join(keep)).hexdigest())
                else:
                    kept.append(text if len(keep) == len(words) else b" ".join(keep).decode())
            passed = [c for c in batch.schema.names if c not in ("text", "spans")]
            made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in passed] + made, names=[*passed, "n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = 20, gram: int = 10, batches: int = 3, max_runs: int = 2, digest: bool = False) -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that also starts earlier.

    Earlier: a smaller doc_id, or the same document at an earlier start;
    windows are judged on the input.  ``docs`` needs doc_id and text.  Returns
    doc_id, n_words, n_removed and kept: the text, unchanged if nothing goes,
    else the kept words joined by one space; with ``digest`` the SHA-256 of
    the kept words joined by one space.  A null text has no words.  Rows
    without doc_id are kept whole.  Repeated rows are one document; other
    texts under the same doc_id are ordered by their text.  An empty table
    gives an empty result; other columns are ignored.
    """
    work = Work(docs.sparkSession, "substring")
    tied = with_tie(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work)
    spans = repeated_spans(tied, work, window, gram, batches, max_runs)
    out = join_checked(tied, spans, ["doc_id", "tie"], "left", weight=F.size("spans") * 8 + 32).select("doc_id", "text", "spans")
    return out.mapInArrow(lean(_cut(window, digest)), "doc_id long, n_words long, n_removed long, kept string")


def rewrite(docs: DataFrame, window: int = 20, gram: int = 10, batches: int = 3, max_runs: int = 2) -> DataFrame:
    """``docs`` with all its columns and the texts that ``remove_repeats`` keeps (a null text stays null)."""
    work = Work(docs.sparkSession, "substring")
    tied = with_tie(pack(docs), work)
    spans = repeated_spans(tied, work, window, gram, batches, max_runs)
    out = join_checked(tied, spans, ["doc_id", "tie"], "left", weight=F.size("spans") * 8 + 32).select("row", "text", "spans")
    shape = T.StructType([out.schema["row"], *(T.StructField(n, T.LongType()) for n in ("n_words", "n_removed")), T.StructField("kept", T.StringType())])
    return unpack(out.mapInArrow(lean(_cut(window, False)), shape).withColumnRenamed("kept", "text"), docs, F.col("n_removed") > 0)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 19], chr(32)) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM x) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM (SELECT doc_id, i, unnest(range(0, 20)) AS j FROM r)),
k AS (SELECT a.doc_id, string_agg(a.t, chr(32) ORDER BY a.i) AS kept, count(*) AS n
      FROM (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM d) a ANTI JOIN c ON a.doc_id = c.doc_id AND a.i = c.i GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op6: 20-word windows, all documents."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
    return out.withColumnRenamed("kept", "kept_sha256")
