"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton (over word numbers) of a block of items is broadcast; items are
put into blocks of bounded size, and the documents are streamed against one
block at a time, each in a stage of its own, so the memory of a task follows
the size of a block, not of the benchmark.  The driver reads the benchmark one
partition at a time and holds one block.  A cheap filter by word hashes goes
first: an occurrence can only lie in a run of words whose neighbouring pairs
all occur in items.  Such runs walk the automaton, word by word as spelled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .text import ALNUM_LOWER, U, Words, chunks, lean
from .work import Work, pack, unpack

#: Words of items in a block; an automaton has at most twice as many states.
BLOCK_WORDS = 200_000

#: Columns that a scan appends.
MADE = ["n_words", "starts", "ends", "items"]


class SuffixAutomaton:
    """All runs of words of the items, with the items that hold each and the longest match at every word of a stream."""

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        self.names = [name for name, _ in items]
        whole: list[tuple[int, int]] = []
        for i, (_, word_ids) in enumerate(items):
            last = 0
            for w in word_ids:
                last = self._extend(last, w, ends)
                ends[last].add(i)
            whole.append((i, len(word_ids)))
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for s in order:  # an item that holds a run holds its suffixes
            ends[self.link[s]] |= ends[s]
        # Items shorter than a window are one window: filed at the state that ends with them.
        self.short: dict[int, list[tuple[int, int]]] = {}
        for i, n in whole:
            if 0 < n < window:
                s = 0
                for w in items[i][1]:
                    s = self.next[s][w]
                self.short.setdefault(s, []).append((n, i))
        self.items: dict[int, frozenset[int]] = {s: frozenset(ends[s]) for s in range(len(ends)) if s and self.length[self.link[s]] < window <= self.length[s]}
        self.least = min([n for _, n in whole if n] + [window])

    def _extend(self, last: int, w: int, ends: list[set[int]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:  # generalised: the run may be there from another item
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q, ends)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        ends.append(set())
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q, ends)
        return cur

    def _clone(self, p: int, w: int, q: int, ends: list[set[int]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        ends.append(set())
        link[q] = new
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def matches(self, word_ids: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans [start, end) of occurring windows, and the items that they are windows of."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for i, w in enumerate(word_ids):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            s = state
            if matched >= window:
                spans.append((i + 1 - matched, i + 1))
            while s:
                if s in self.short:
                    for n, item in self.short[s]:
                        if n <= matched:
                            spans.append((i + 1 - n, i + 1))
                            found.add(item)
                if matched >= window and s in self.items:
                    found |= self.items[s]
                s = link[s]
        return spans, found


class Block:
    """A block of items as it is sent to the tasks: the automaton, word numbers, and pairs of neighbours."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        ids: dict[bytes, int] = {}  # by spelling
        numbered, pairs, hashes = [], [], [np.zeros(0, U)]
        for _, _, data, offsets in chunks(texts):
            words = Words(data, offsets, ALNUM_LOWER)
            for d in range(words.n_docs):
                h = words.hash[words.offset[d] : words.offset[d + 1]]
                numbered.append([ids.setdefault(words.word(i).lower(), len(ids)) for i in range(words.offset[d], words.offset[d + 1])])
                pairs.append(self.pair(h))
                hashes.append(np.unique(h))
        self.automaton = SuffixAutomaton([(name, n) for (name, _), n in zip(items, numbered, strict=True)], window)
        self.ids = ids
        self.words = np.unique(np.concatenate(hashes))
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, U)

    @staticmethod
    def pair(h: np.ndarray) -> np.ndarray:
        return h[:-1] * U(0x9E3779B97F4A7C15) ^ h[1:]

    @staticmethod
    def known(table: np.ndarray, x: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.zeros(len(x), bool)
        return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x

    def scan(self, words: Words) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
        """(text, spans, items) for the texts of a chunk with occurring windows; spans count words of the text."""
        least = self.automaton.least
        if not len(words.hash) or not len(self.words):
            return
        inside = self.known(self.words, words.hash)
        joined = np.zeros(len(inside), bool)  # the word goes on from the word before
        at = np.flatnonzero(inside[1:] & inside[:-1]) + 1
        at = at[np.isin(at, words.offset, invert=True)]
        joined[at] = self.known(self.pairs, words.hash[at - 1] * U(0x9E3779B97F4A7C15) ^ words.hash[at])
        start = np.flatnonzero(inside & ~joined)
        end = np.concatenate([np.flatnonzero(inside & ~joined)[1:], [len(inside)]])
        closes = np.flatnonzero(~inside)
        if len(closes):
            k = np.searchsorted(closes, start)
            end = np.minimum(end, np.where(k < len(closes), closes[np.minimum(k, len(closes) - 1)], len(inside)))
        long = end - start >= least
        now, spans, items = -1, [], set()
        for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True):
            s, f = self.automaton.matches([self.ids.get(words.word(i).lower(), -1) for i in range(a, b)])  # -1: in no item
            if not s:
                continue
            d = int(np.searchsorted(words.offset, a, side="right")) - 1
            if d != now:
                if now >= 0:
                    yield now, spans, items
                now, spans, items = d, [], set()
            base = int(words.offset[d])
            spans += [(a - base + x, a - base + y) for x, y in s]
            items |= f
        if now >= 0:
            yield now, spans, items


def blocks(items: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items in blocks of at most ``block_words`` words (one item may have more).

    The items are read to the driver one partition at a time; a block is what tasks hold at once.
    """
    held, size = [], 0
    for row in items.select(F.col("item_id"), F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        n = len(row["text"]) // 2 + 1  # at least the words
        if held and size + n > block_words:
            yield Block(held, window)
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += n
    if held:
        yield Block(held, window)


def _hits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        names = [None if x is None else str(x) for x in block.automaton.names]
        for batch in batches:
            n_words, starts, ends, items = [], [], [], []
            for lo, hi, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets, ALNUM_LOWER)
                n_words.append(words.counts)
                s, e, f = ([[] for _ in range(hi - lo)] for _ in range(3))
                for d, spans, found in block.scan(words):
                    spans.sort()
                    for a, b in spans:
                        if s[d] and a <= e[d][-1]:
                            e[d][-1] = max(e[d][-1], b)
                        else:
                            s[d].append(a)
                            e[d].append(b)
                    f[d] = sorted({names[i] for i in found} - {None})
                starts += s
                ends += e
                items += f
            made = [pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            passed = [c for c in batch.schema.names if c not in MADE]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in passed] + made, names=passed + MADE)

    return run


def scan(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, and columns of other names than MADE) with n_words, hit word spans and items.

    The spans are arrays starts and ends, sorted and apart; items are item_ids as strings, sorted.
    """
    work = Work(docs.sparkSession, "decontam")
    context = docs.sparkSession.sparkContext
    longs = T.ArrayType(T.LongType())
    kinds = zip(MADE, (T.LongType(), longs, longs, T.ArrayType(T.StringType())), strict=True)
    shape = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in kinds)])
    out = sent = None
    for block in blocks(items, window, block_words):  # each adds its spans to those found so far
        if out is None:
            sent = context.broadcast(block)
            out = docs.mapInArrow(lean(_hits(sent)), shape)
            continue
        before, out = out, work.save(out, "hits")
        work.drop(before)
        sent.unpersist()  # the block before is done with
        sent = context.broadcast(block)
        kept, out = out, out.mapInArrow(lean(_more(sent)), shape)
        out._work_path = kept._work_path
    return docs.mapInArrow(_hits(context.broadcast(Block([], window))), shape) if out is None else out


def _more(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (now,) = _hits(shared)(iter([batch]))
            old, new = batch.to_pydict(), now.to_pydict()
            starts, ends, items = [], [], []
            for s, e, s2, e2, f, f2 in zip(old["starts"], old["ends"], new["starts"], new["ends"], old["items"], new["items"], strict=True):
                a, b = [], []
                for x, y in sorted([*zip(s, e, strict=True), *zip(s2, e2, strict=True)]):
                    if a and x <= b[-1]:
                        b[-1] = max(b[-1], y)
                    else:
                        a.append(x)
                        b.append(y)
                starts.append(a)
                ends.append(b)
                items.append(sorted({*f, *f2}))
            lists = {"starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([lists.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    return run


def hit_count() -> F.Column:
    return F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Remove hit spans from texts; reject documents of which more than ``max_coverage`` of the words is hit.

    Words are runs of digits, ASCII letters (A-Z lower-cased) and characters
    beyond ASCII.  A window is ``window`` consecutive words of an item; an
    item of fewer, but not none, is one window.  Returns doc_id, text (without
    the hit spans, from the first byte of a span's first word to the last of
    its last; unchanged if none), n_words, n_hit, items (sorted) and rejected.
    Null texts have no words and stay null; an empty benchmark hits nothing;
    repeated rows and rows without doc_id are each judged alone; an item without
    item_id hits words but is not named.
    """
    hits = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), items, window, block_words)
    cut = hits.mapInArrow(_cut, hits.schema)
    return cut.select("doc_id", "text", "n_words", hit_count().alias("n_hit"), F.array_sort("items").alias("items")).withColumn("rejected", F.col("n_hit") > max_coverage * F.col("n_words"))


def rewrite(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with all its columns and the texts that ``decontaminate`` leaves; rejected documents are gone."""
    hits = scan(pack(docs), items, window, block_words)
    kept = hits.mapInArrow(_cut, hits.schema).where(~(hit_count() > max_coverage * F.col("n_words")))
    return unpack(kept, docs, F.size("starts") > 0)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends = batch.column("starts").to_pylist(), batch.column("ends").to_pylist()
        texts = batch.column("text").to_pylist()
        for d, s in enumerate(starts):
            if s:
                data = np.frombuffer(texts[d].encode(), np.uint8)
                words = Words(data, np.array([0, len(data)]), ALNUM_LOWER, hashes=False)
                parts, at = [], 0
                for a, b in zip(s, ends[d], strict=True):
                    parts.append(data[at : words.start[a]].tobytes())
                    at = int(words.end[b - 1])
                parts.append(data[at:].tobytes())
                texts[d] = b"".join(parts).decode()
        columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], chr(32)) AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
z AS (SELECT DISTINCT n FROM g),
o AS (SELECT doc_id, i, x.n, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], chr(32)) AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, z WHERE len(w) >= n)) x JOIN g ON g.n = x.n AND g.g = x.g),
h AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, unnest(range(0, n)) AS j FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op5: windows of ten words, all documents against all items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_join(F.array_sort("items"), ",")
    return hits.select("doc_id", "n_words", hit_count().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256")).withColumn("contaminated", F.col("n_hit") > 0)
