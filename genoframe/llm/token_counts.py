"""Token totals by source, language and tokenizer version, maintained by deltas.

State is a ledger, the current count of every (doc_id, tokenizer version), and
``totals``, additive sums.  A batch of events (insert, revise, delete) becomes
signed deltas against the ledger; totals only ever add deltas.  The ledger is
log-structured: a batch appends the rows that it changed, in buckets by
doc_id, and reads only the buckets and documents that it names; now and then
the appended parts are merged into one.  A state is published by its commit
record, so a batch that is sent twice, or again after a failure half-way,
counts once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .work import Work, join_checked, read_records, write_record

#: A row of the ledger: what commit ``n`` made of a document under a tokenizer; ``live`` false: deleted.
LEDGER = "doc_id long, tokenizer string, n long, live boolean, source string, lang string, tokens long, bucket int"
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"
KEYS = ["source", "lang", "tokenizer"]

#: Buckets of a ledger by doc_id at least, and rows that a bucket is meant to hold; their number grows when parts are merged.
BUCKETS, BUCKET_ROWS = 64, 500_000

#: Tokenizer versions that count inside Spark: words between spaces, and runs of letters and digits.
COUNTERS: dict[str, Callable[[Column], Column]] = {
    "words-1": lambda text: F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))),
    "words-2": lambda text: F.size(F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))),
}


def count_tokens(docs: DataFrame, tokenizer: str, counter: Callable[[Column], Column] | None = None) -> DataFrame:
    """Insert events for documents: doc_id, source, lang, tokenizer, tokens; a null text has no tokens."""
    counter = counter or COUNTERS[tokenizer]
    tokens = F.coalesce(counter(F.coalesce("text", F.lit(""))), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), tokens.alias("tokens"))


class TokenRollup:
    """The maintained totals; ``commit`` applies a batch once, however often it is sent.

    The state lives in ``path`` (a folder of the work's own if none is given):
    a folder of its own for each attempt at a commit, and a log of small
    commit records, the last of which names the folders of the current state.
    A batch counts from the moment its record is written; what an interrupted
    or refused commit left behind is never read, and nothing is overwritten:
    of two writers that start from one state the second is refused, and must
    open the state again.  ``max_parts`` appended parts of the ledger are
    merged into one, in as many buckets as its rows ask for.
    """

    def __init__(self, work: Work, path: str | None = None, max_parts: int = 8, bucket_rows: int = BUCKET_ROWS):
        self.work, self.path, self.max_parts, self.bucket_rows = work, path or f"{work.root}/store", max_parts, bucket_rows
        self.spark: SparkSession = work.spark
        self._load()

    def _load(self) -> None:
        records = read_records(self.spark, f"{self.path}/log", "n long, batch string, totals string, parts array<string>, buckets int")
        self.done: list[str] = [r["batch"] for r in records]
        self.parts: list[str] = list(records[-1]["parts"]) if records else []
        self.buckets: int | None = records[-1]["buckets"] if records else None
        self.totals = self.spark.read.schema(TOTALS).parquet(f"{self.path}/{records[-1]['totals']}") if records else self.spark.createDataFrame([], TOTALS)

    def _ledger(self, parts: list[str]) -> DataFrame:
        rows = [self.spark.read.schema(LEDGER).parquet(f"{self.path}/{p}") for p in parts]
        return reduce(DataFrame.unionByName, rows) if rows else self.spark.createDataFrame([], LEDGER)

    def _buckets_for(self, rows: int) -> int:
        """A power of two, so that buckets are split, never dealt anew."""
        n = BUCKETS
        while n * self.bucket_rows < rows:
            n *= 2
        return n

    @staticmethod
    def _current(rows: DataFrame) -> DataFrame:
        """The last row of every key."""
        last = F.max_by(F.struct("n", "live", "source", "lang", "tokens", "bucket"), "n")
        return rows.groupBy("doc_id", "tokenizer").agg(last.alias("x")).select("doc_id", "tokenizer", "x.*")

    @property
    def ledger(self) -> DataFrame:
        """doc_id, tokenizer, source, lang, tokens of all that is live."""
        return self._current(self._ledger(self.parts)).where("live").select("doc_id", "tokenizer", "source", "lang", "tokens")

    def commit(self, batch_id: str, events: DataFrame) -> bool:
        """Apply events: action ('insert', 'revise', 'delete'), doc_id, tokenizer and, but for deletes, source, lang, tokens.

        Within a batch the last action of a document and tokenizer counts
        (deletes after inserts and revisions; then the larger count).  An
        insert of a live key is a revision, a revision of a key that is not
        live an insert; a delete of such a key does nothing.  A delete without
        tokenizer deletes the document under all of them.  Events without
        doc_id are ignored.  Returns False if the batch was committed before.
        """
        if batch_id in self.done:
            return False
        n = len(self.done) + 1
        at = f"{n}-{uuid.uuid4().hex}"
        events = events.where("doc_id is not null")
        whole = events.where("action = 'delete' and tokenizer is null").select("doc_id").distinct().withColumn("gone", F.lit(True))
        order = F.struct(F.when(F.col("action") == "delete", 1).otherwise(0), F.coalesce("tokens", F.lit(-1)), F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
        last = events.where("tokenizer is not null").groupBy("doc_id", "tokenizer").agg(F.max_by(F.struct("action", F.col("source").alias("s"), F.col("lang").alias("l"), F.col("tokens").alias("t")), order).alias("e")).select("doc_id", "tokenizer", "e.*")
        named = self.work.save(events.select("doc_id").distinct(), "named")
        buckets_now = self.buckets or self._buckets_for(named.count())
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets_now)).cast("int")
        if self.parts:
            buckets = [r[0] for r in named.select(bucket.alias("b")).distinct().collect()]  # a number for each bucket
            before = join_checked(self._ledger(self.parts).where(F.col("bucket").isin(buckets)), named, "doc_id", "left_semi")
        else:
            before = self._ledger([])
        old = self._current(before).where("live").drop("n", "live", "bucket")
        joined = old.join(last, ["doc_id", "tokenizer"], "full").join(whole, "doc_id", "left")
        dead = F.coalesce("gone", F.lit(False)) | (F.coalesce("action", F.lit("keep")) == "delete")
        change = joined.select(
            "doc_id", "tokenizer", F.struct("source", "lang", "tokens").alias("old"), F.struct(F.col("s").alias("source"), F.col("l").alias("lang"), F.coalesce("t", F.lit(0)).alias("tokens")).alias("new"),
            F.col("tokens").isNotNull().alias("was"), (F.col("action").isNotNull() & ~dead).alias("told"), dead.alias("dead"),
        )
        change = self.work.save(change.where("told or (was and dead)"), "change")
        minus = change.where("was").select("old.source", "old.lang", "tokenizer", F.lit(-1).alias("docs"), (-F.col("old.tokens")).alias("tokens"))
        plus = change.where("told").select("new.source", "new.lang", "tokenizer", F.lit(1).alias("docs"), F.col("new.tokens").alias("tokens"))
        deltas = minus.union(plus).groupBy(*KEYS).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
        totals = self.totals.union(deltas).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
        totals.write.parquet(f"{self.path}/{at}/totals")
        state = F.when(F.col("told"), F.col("new"))
        rows = change.select("doc_id", "tokenizer", F.lit(n).cast("long").alias("n"), F.col("told").alias("live"), *[state[c].alias(c) for c in ("source", "lang", "tokens")], bucket.alias("bucket"))
        self._append(rows, f"{at}/ledger")
        parts = [*self.parts, f"{at}/ledger"]
        if len(parts) > self.max_parts:
            merged = self._current(self._ledger(parts)).where("live")
            buckets_now = max(buckets_now, self._buckets_for(merged.count()))
            self._append(merged.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets_now)).cast("int")), f"{at}/merged")
            parts = [f"{at}/merged"]
        self.work.drop(change)
        self.work.drop(named)
        write_record(self.spark, f"{self.path}/log", n, {"n": n, "batch": batch_id, "totals": f"{at}/totals", "parts": parts, "buckets": buckets_now})
        self._load()
        return True

    def _append(self, rows: DataFrame, part: str) -> None:
        rows.repartition("bucket").sortWithinPartitions("bucket", "doc_id").write.partitionBy("bucket").parquet(f"{self.path}/{part}")


def maintained_totals(docs: DataFrame) -> DataFrame:
    """Totals of all documents after a run of batches: inserts, a replay, a new tokenizer version, revisions, deletes, and their undoing.

    Documents of an even doc_id come in the first batch, the others in the
    second, with their counts by words-1; the first is sent twice.  All are
    then counted by words-2.  Documents in other languages than English get
    their words-1 counts revised to those of words-2, and documents that have
    fewer than 20 words by words-2 are deleted.  A last batch takes both back,
    so the totals are those of every document by each version's own counts.
    Returns source, lang, tokenizer, docs, tokens.  A null text has no words;
    a very long one is counted whole.  Rows without doc_id are ignored; rows
    that repeat a doc_id are one document, the one with the larger count.  An
    empty table gives no totals.  Other columns are ignored.
    """
    work = Work(docs.sparkSession, "token-counts")
    rollup = TokenRollup(work)
    text = F.coalesce("text", F.lit(""))
    counts = work.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", *[F.coalesce(f(text), F.lit(0)).cast("long").alias(n) for n, f in COUNTERS.items()]), "counts")

    def events(rows: DataFrame, tokenizer: str, by: str, action: str) -> DataFrame:
        return rows.select(F.lit(action).alias("action"), "doc_id", F.lit(tokenizer).alias("tokenizer"), "source", "lang", F.col(f"`{by}`").alias("tokens"))

    even, odd = counts.where("doc_id % 2 = 0"), counts.where("doc_id % 2 <> 0")
    rollup.commit("even", events(even, "words-1", "words-1", "insert"))
    rollup.commit("odd", events(odd, "words-1", "words-1", "insert"))
    rollup.commit("even", events(even, "words-1", "words-1", "insert"))
    rollup.commit("words-2", events(counts, "words-2", "words-2", "insert"))
    few = counts.where("`words-2` < 20").select(F.lit("delete").alias("action"), "doc_id", F.lit(None).cast("string").alias("tokenizer"), "source", "lang", F.lit(None).cast("long").alias("tokens"))
    foreign = counts.where("lang <> 'en'")
    rollup.commit("revised", events(foreign, "words-1", "words-2", "revise").unionByName(few))
    touched = work.save(counts.where("lang <> 'en' or `words-2` < 20").select("doc_id").distinct(), "touched")
    again = work.save(join_checked(counts, touched, "doc_id", "left_semi"), "again")
    rollup.commit("restored", events(again, "words-1", "words-1", "insert").unionByName(events(again, "words-2", "words-2", "insert")))
    return rollup.totals


SQL = r"""
WITH d AS (SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS a,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS b FROM documents),
t AS (SELECT source, lang, 'words-1' AS tokenizer, a AS n FROM d UNION ALL SELECT source, lang, 'words-2', b FROM d)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM t GROUP BY ALL
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op7: all documents."""
    return maintained_totals(spark.read.parquet(f"{sf_dir}/documents.parquet"))
