r"""Phrase collocations by suffix-sigma: truncated suffixes, one sort, one stack.

Texts (null: empty), A-Z lower-cased, are split into pieces at
``[.,;:!?\x0A-\x0D]`` and pieces into words ``[^\x20\x09]+``.  Each place of a
piece gives its suffix of at most ``longest`` words.  A task goes through
several splits and counts equal suffixes before they are shuffled.  They are dealt out by ranges of
(language, suffix): by language and first word, but a first word, or a phrase,
that is too common for one task goes on in the next.  Inside a range they are
sorted in reverse, and one stack of ``longest`` entries counts every prefix.
Only the prefixes that stand at the edges of a range may go on elsewhere;
their parts are added up afterwards.

What cannot be frequent is cut before the shuffle: two passes count words and
pairs of words, then longer runs of frequent pairs, in the slots of sketches
of fixed size.  A slot's count is never below that of a run in it, so a slot
below ``least`` proves its runs rare, and a suffix ends before it would become
rare.  The sketches cannot change a result; where they fill up (beyond about
ten thousand million rare runs), suffixes only stay longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .text import _STEP, U, Words, _fold, _set, chunks, lean, mix
from .work import Work, join_checked

# Bytes that end a piece, and bytes between words.
_BREAKS = ((0x0A, 0x0D), (0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
_WORDS = _fold(_set((0x20, 0x20), (0x09, 0x09), *_BREAKS, inverse=True), lower=True)
_BREAK = _set(*_BREAKS, inverse=False)

#: Slots in a row of the sketch.
_ROW = 4096
#: Suffixes that a task gathers before it counts them, and different ones that it holds before it gives them out.
_GATHERED, _HELD = 1_000_000, 400_000
#: Tasks a core that a pass over the documents is dealt to, however many splits they come in.
_TASKS = 2


def _escaped(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes 0 and 1 as pairs that start with 1, so that 0 can stand between words and sorts before all of them."""
    low = data <= 1
    if not low.any():
        return data, offsets
    out = np.repeat(data, 1 + low)
    at = np.flatnonzero(low) + np.arange(low.sum())
    out[at], out[at + 1] = 1, data[low] + 1
    return out, offsets + np.concatenate([[0], np.cumsum(low)])[offsets]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(words, language of each word, languages, hashes of the words, whether a word and the next one lie in one piece)."""
    for batch in batches:
        langs = batch.column("lang").fill_null("und").dictionary_encode()
        names = langs.dictionary.to_pylist()
        seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in names], U)
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in chunks(batch.column("text")):
            data, offsets = _escaped(data, offsets)
            words = Words(data, offsets, _WORDS)
            lang = np.repeat(codes[lo:hi], words.counts)
            if not len(lang):
                continue
            pair = np.zeros(len(lang), bool)
            breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])[words.start]
            pair[:-1] = breaks[1:] == breaks[:-1]
            pair[words.offset[1:][words.counts > 0] - 1] = False
            yield words, lang, names, mix(words.hash + seeds[lang]), pair


def _grams(one: np.ndarray, pair: np.ndarray, longest: int, bits: int, often: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, slots, places) for runs of n words: all their parts may be frequent by the bitmaps in ``often`` (words and pairs, longer runs)."""
    shift, count = U(64 - bits), len(one)
    now, goes = one, np.ones(count, bool)
    for n in range(1, longest + 1):
        if n > 1:  # the run of n - 1 words at a place and at the next one, and the word that this one adds
            goes[: count - 1] &= goes[1:] & pair[: count - 1]
            goes[count - 1] = False
            longer = now.copy()
            longer[: max(0, count - n + 1)] = mix(now[: max(0, count - n + 1)] * _STEP + one[n - 1 :])
            now = longer
        slots = (now >> shift).astype(np.int64)
        known = often[0] if n < 3 and often else often[1] if n > 2 and len(often) > 1 else None
        if known is not None:
            goes &= known[slots]
        yield n, slots, goes.copy()


def _add(total: np.ndarray, slots: list[np.ndarray], most: int) -> None:
    slot, c = np.unique(np.concatenate(slots), return_counts=True)
    total[slot] = np.minimum(total[slot] + c, most)


def _sketch(longest: int, bits: int, least: int, shared: list):
    """(row, at, counts): a task's counts by slot, up to ``least``, of what no bitmap tells about yet; ``at``: slots of the row, none if all are given."""
    kind = np.uint8 if least < 256 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = [np.unpackbits(x.value).astype(bool) for x in shared]
        total, held = np.zeros(1 << bits, kind), []
        for *_, one, pair in _pieces(batches):
            held += [slots[goes] for n, slots, goes in _grams(one, pair, longest if often else 2, bits, often) if not often or n > 2]
            if sum(len(x) for x in held) > _GATHERED:
                _add(total, held, least)
                held.clear()
        if held:
            _add(total, held, least)
        rows = total.reshape(-1, _ROW)
        for first in range(0, len(rows), 256):
            out = []
            for i in range(first, min(first + 256, len(rows))):
                at = np.flatnonzero(rows[i])
                if len(at):
                    few = len(at) < _ROW // 4
                    out.append((i, at.astype(np.uint16).tobytes() if few else None, (rows[i][at] if few else rows[i]).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["row", "at", "counts"])

    return run


def _often(least: int):
    """(row, bits): which slots reach ``least`` in all; tasks' rows come sorted by row and are read as a stream."""
    kind = np.uint8 if least < 256 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], names=["row", "bits"])

        for batch in batches:
            for row, at, counts in zip(*(batch.column(c).to_pylist() for c in ("row", "at", "counts")), strict=True):
                if row != now:
                    if now is not None:
                        yield made()
                    now, total = row, np.zeros(_ROW, np.int64)
                if at is None:
                    total += np.frombuffer(counts, kind)
                else:
                    total[np.frombuffer(at, np.uint16)] += np.frombuffer(counts, kind)
        if now is not None:
            yield made()

    return run


def _counted(tables: list[pa.Table]) -> pa.Table:
    """Equal suffixes as one row; by the strings themselves."""
    return pa.concat_tables(tables).group_by(["lang", "suffix"], use_threads=False).aggregate([("c", "sum")]).rename_columns(["lang", "suffix", "c"])


def _suffixes(longest: int, bits: int, shared: list):
    """(lang, suffix, c): suffixes of places whose first word may be frequent, words with byte 0 between them; the empty one counts all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = [np.unpackbits(x.value).astype(bool) for x in shared]
        total: dict[str, int] = {}
        held: list[pa.Table] = []
        gathered, counted = 0, None

        def given(table: pa.Table) -> Iterator[pa.RecordBatch]:
            return iter(table.cast(pa.schema([("lang", pa.string()), ("suffix", pa.string()), ("c", pa.int64())])).to_batches(max_chunksize=50_000))

        for words, lang, names, one, pair in _pieces(batches):
            for code, n in enumerate(np.bincount(lang, minlength=len(names)).tolist()):
                total[names[code]] = total.get(names[code], 0) + n
            length = np.zeros(len(one), np.int64)
            for n, _, goes in _grams(one, pair, longest, bits, often):
                length[goes] = n
            # All words, byte 0 after each; a suffix is a slice of that.
            size = words.end - words.start + 1
            at = np.concatenate([[0], np.cumsum(size)])
            source = np.repeat(words.start - at[:-1], size) + np.arange(at[-1])
            joined = _WORDS[1][words.data[np.minimum(source, len(words.data) - 1)]]
            joined[at[1:] - 1] = 0
            kept = np.flatnonzero(length)
            begin, end = at[kept], at[kept + length[kept]] - 1
            to = np.concatenate([[0], np.cumsum(end - begin)])
            body = joined[np.repeat(begin - to[:-1], end - begin) + np.arange(to[-1])]
            suffix = pa.Array.from_buffers(pa.large_string(), len(kept), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(body)])
            held.append(pa.table({"lang": pa.array(names, pa.string()).take(pa.array(lang[kept])), "suffix": suffix, "c": pa.array(np.ones(len(kept), np.int64))}))
            gathered += len(kept)
            if gathered > _GATHERED:
                counted = _counted([*held, counted] if counted is not None else held)
                held, gathered = [], 0
                if counted.num_rows > _HELD:
                    yield from given(counted)
                    counted = None
        if held:
            counted = _counted([*held, counted] if counted is not None else held)
        if counted is not None:
            yield from given(counted)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([""] * len(total)), pa.array(list(total.values()), pa.int64())], names=["lang", "suffix", "c"])

    return run


def _prefixes(least: int):
    """(lang, phrase, f) of rows sorted by language and, in reverse, by suffix: prefixes of ``least`` or more, and all at the edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # [word, count, whether it is a prefix of the first row]
        out: list[tuple] = []
        lang, first = None, True

        def pop(edge: bool) -> None:
            phrase = "\0".join(x[0] for x in stack)
            _, count, opened = stack.pop()
            if count >= least or opened or edge:
                out.append((lang, phrase, count))
            if stack:
                stack[-1][1] += count

        def given() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "phrase", "f"])
            out.clear()
            return made

        for batch in batches:
            for now, suffix, c in zip(*(batch.column(n).to_pylist() for n in ("lang", "suffix", "c")), strict=True):
                words = suffix.split("\0")
                same = 0
                if now == lang:
                    for x, w in zip(stack, words, strict=False):
                        if x[0] != w:
                            break
                        same += 1
                while len(stack) > same:
                    pop(False)
                lang = now
                stack += [[w, 0, first] for w in words[same:]]
                stack[-1][1] += c
                first = False
            if len(out) > 10_000:
                yield given()
        while stack:
            pop(True)
        yield given()

    return run


#: floor(1000 * a * n / (l * r)); the products have up to 38 digits.
SCORE = "(cast(1000 as decimal(4, 0)) * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"


def frequent_phrases(docs: DataFrame, work: Work, longest: int = 5, least: int = 100, sketch_bits: int = 24) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``longest`` words that stand ``least`` times or more, words joined by byte 0, and (lang, n) of all words."""
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    # A common suffix, or a full row of a sketch, leaves every task once: with tasks by splits that is once for each bit of the input.
    docs = docs.coalesce(_TASKS * docs.sparkSession.sparkContext.defaultParallelism)
    shared = []
    for _ in range(2 if longest > 2 else 1):  # words and pairs, then longer runs of them
        parts = docs.mapInArrow(lean(_sketch(longest, sketch_bits, least, shared)), "row int, at binary, counts binary")
        rows = parts.repartition("row").sortWithinPartitions("row").mapInArrow(lean(_often(least)), "row int, bits binary")
        often = np.zeros((max(1, (1 << sketch_bits) // _ROW), _ROW // 8), np.uint8)
        for row, bits in rows.collect():  # 2 ** sketch_bits bits in all
            often[row] = np.frombuffer(bits, np.uint8)
        shared.append(docs.sparkSession.sparkContext.broadcast(often.reshape(-1)))
    suffixes = work.save(docs.mapInArrow(lean(_suffixes(longest, sketch_bits, shared)), "lang string, suffix string, c long"), "suffixes")
    order = ["lang", F.desc("suffix")]
    dealt = suffixes.where("suffix <> ''").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = dealt.mapInArrow(lean(_prefixes(least)), "lang string, phrase string, f long")
    phrases = parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return work.save(phrases, "phrases"), work.save(suffixes.where("suffix = ''").groupBy("lang").agg(F.sum("c").alias("n")), "words")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, cover: int = 100, top: int | None = 2000, sketch_bits: int = 24) -> DataFrame:
    """Phrases of 2 to ``longest`` words that stand together more often than their parts would, by language.

    ``docs`` needs text and lang (null: ``und``); other columns, whatever
    their names, are ignored.  A phrase that stands ``least`` times or more (a)
    is cut after each word into two parts that stand l and r times; its score
    is the lowest of floor(1000 * a * n / (l * r)), n being all words of the
    language, in exact arithmetic; ties go to the earliest cut.  A phrase is
    dropped that lies inside a longer one with 100 * f >= ``cover`` * a.
    Returns lang, rank, phrase, a, l, r, n, score: the first ``top`` of each
    language (None: all) by score, a (both falling) and phrase.  Repeated rows
    count as often as they stand there; null and empty texts and an empty
    table give nothing.
    """
    work = Work(docs.sparkSession, "collocations")
    phrases, words = frequent_phrases(docs, work, longest, least, sketch_bits)
    weight = F.octet_length("phrase") + F.octet_length("lang") + 24
    split = phrases.withColumn("words", F.split("phrase", "\0")).withColumn("size", F.size("words"))
    found = work.save(split.where("size > 1"), "candidates")

    def part(lo, n):
        return F.array_join(F.slice("words", lo, n), "\0")

    cuts = found.select("lang", "phrase", F.col("f").alias("a"), "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    for side, count in (("first", "l"), ("rest", "r")):
        cuts = join_checked(cuts, phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side], "inner", weight=F.octet_length(side) + 32)
    cuts = join_checked(cuts, words, "lang", "inner", weight=F.octet_length("lang") + 8)
    best = cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))

    inner = found.where("size > 2").select("lang", "words", "f", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n"))
    inner = inner.select("lang", "words", "f", "n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("at"))
    longer = work.save(inner.select("lang", part(F.col("at"), F.col("n")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer")), "inner")
    kept = join_checked(best, longer, ["lang", "phrase"], "left", weight=weight).where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("best.a")))

    text = F.replace(F.replace(F.replace("phrase", F.lit("\0"), F.lit(" ")), F.lit("\1\1"), F.lit("\0")), F.lit("\1\2"), F.lit("\1"))
    rows = kept.select("lang", text.alias("phrase"), "best.a", "best.l", "best.r", "best.n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # what a part of a language does not rank, the language does not
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    rows = rows if top is None else rows.where(F.col("rank") <= top)
    out = work.save(rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "ranked")
    for table in (phrases, words, found, longer):
        work.drop(table)
    return out


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
s AS (SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i + 4])) AS w FROM p WHERE len(w) > 0),
g AS (SELECT lang, len(x) AS size, array_to_string(x, chr(32)) AS phrase, count(*) AS f
      FROM (SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[1:i])) AS x FROM s) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, chr(32)) AS w FROM g WHERE size > 1),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
x AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, n.n, CAST((1000::HUGEINT * k.a * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM k JOIN n ON n.lang = k.lang JOIN g l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], chr(32)) JOIN g r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], chr(32))),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM x) WHERE o = 1),
kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.a >= b.a AND len(c.phrase) > len(b.phrase) AND contains(chr(32) || c.phrase || chr(32), chr(32) || b.phrase || chr(32)))),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score FROM o WHERE rank <= 2000
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op11: phrases of 2 to 5 words that stand 100 times or more, all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
