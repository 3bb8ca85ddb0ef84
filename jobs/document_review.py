"""Review of delivered texts: a manifest that grows with them, and one decision for each.

    python -m jobs.document_review --documents DOCUMENTS --decisions DECISIONS --out OUT [--config FILE]

Texts are registered the way samples are: with a checksum, with the size that
was declared against the size that came, with the warnings that their contents
give, and with the earliest text that they repeat.  A reviewer's decisions are
merged in: exactly one that is allowed for each text, else the row says what
is wrong with it.

A run takes only the texts whose id is beyond the high-water mark, the id up
to which OUT/marks says that texts were taken.  They are written to the
partition intake=N of the manifest, N being the number of marks so far, and
the mark follows when that is done: a run that stopped in between writes the
same partition again.  Decisions come at any time, so the review itself is
written anew by each run from the whole manifest (which holds no texts).

OUT/manifest   intake=N: id, source, context, text_sha256, declared_chars, n_chars, n_words, warnings
OUT/marks      intake, mark, rows
OUT/review     source=S: the manifest with duplicate_of, decision and problem
OUT/summary    context=C: by source and decision, texts, duplicates, warnings, median n_words

Texts without id are reported, not registered; so are texts that come later
with an id at or below the mark.  A null text has no checksum.  Rows that
repeat an id and text are one; other texts under one id are rows of their own,
with the warning "repeated id".
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from genoframe.operators.tables import decisions as decided, medians

from .common import existing, main, mapped

log = logging.getLogger("document_review")

NAME = "document_review"
_MARKS = "intake long, mark long, rows long"
_MANIFEST = "id long, source string, context string, text_sha256 string, declared_chars long, n_chars long, n_words long, warnings string, intake long"


def _registered(texts: DataFrame, settings: Mapping) -> DataFrame:
    """Manifest rows of texts (id, text, source, context, declared_chars)."""
    words = F.size(F.regexp_extract_all("text", F.lit(settings["words"]), F.lit(0)))
    sized = texts.select(
        F.col("id").cast("long").alias("id"), "source", "context", F.sha2("text", 256).alias("text_sha256"), F.col("declared_chars").cast("long").alias("declared_chars"),
        F.length("text").cast("long").alias("n_chars"), words.cast("long").alias("n_words"),
    ).distinct()
    again = sized.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").select("id", F.lit(True).alias("again"))
    checks = [
        ("no text", F.col("n_chars").isNull()), ("empty", F.col("n_words") == 0), ("short", (F.col("n_words") > 0) & (F.col("n_words") < settings["shortest"])),
        ("size differs", ~F.col("declared_chars").eqNullSafe(F.col("n_chars"))), ("repeated id", F.col("again").isNotNull()),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks]), lambda x: x.isNotNull())
    return sized.join(again, "id", "left").withColumn("warnings", F.array_join(found, ";")).drop("again")


def _take_new_texts(spark: SparkSession, documents: str, out: str, settings: Mapping) -> None:
    """Register the texts beyond the mark, then move the mark."""
    texts = mapped(spark.read.parquet(documents), settings["documents"])
    marks = existing(spark, f"{out}/marks", _MARKS)
    done = marks.agg(F.max("mark").alias("mark"), F.count("*").alias("n"), F.sum("rows").alias("rows")).first() if marks is not None else None
    intake, mark = (done["n"], done["mark"]) if done else (0, None)
    new = texts.where("id is not null") if mark is None else texts.where(F.col("id") > mark)
    seen = texts.agg(F.count("*").alias("n"), F.max("id").alias("mark"), F.count_if(F.col("id").isNull()).alias("nameless")).first()
    log.info("%s holds %d rows, %d of them without id; the mark is %s", documents, seen["n"], seen["nameless"], mark)
    if seen["mark"] is None or (mark is not None and seen["mark"] <= mark):
        log.info("nothing new")
        return
    new = new.where(F.col("id") <= seen["mark"])
    rows = _registered(new, settings).withColumn("intake", F.lit(intake).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("intake").parquet(f"{out}/manifest")
    n = spark.read.schema(_MANIFEST).parquet(f"{out}/manifest").where(F.col("intake") == intake).count()
    spark.createDataFrame([(intake, seen["mark"], n)], _MARKS).coalesce(1).write.mode("append").parquet(f"{out}/marks")
    log.info("wrote %d rows to %s/manifest/intake=%d; the mark is now %d", n, out, intake, seen["mark"])


def run(spark: SparkSession, documents: str, decisions: str, out: str, settings: Mapping) -> DataFrame:
    """Register new texts and merge the decisions on all of them; returns the review table."""
    _take_new_texts(spark, documents, out, settings)
    marks = existing(spark, f"{out}/marks", _MARKS)
    if marks is None:
        return spark.createDataFrame([], _MANIFEST).drop("intake").selectExpr("*", "cast(null as long) duplicate_of", "'' decision", "'' problem")
    manifest = spark.read.schema(_MANIFEST).parquet(f"{out}/manifest").join(F.broadcast(marks.select("intake")), "intake", "left_semi")
    first = manifest.where("text_sha256 is not null").groupBy("text_sha256").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("text_sha256", "first")
    votes = mapped(spark.read.parquet(decisions), settings["decisions"])
    verdicts = decided(manifest.select("id").distinct(), votes, "id", tuple(settings["allowed"]))
    unknown = verdicts.where("problem = 'unknown_key'").count()
    log.info("read %d decisions from %s, %d of them on texts that are not registered", votes.count(), decisions, unknown)
    rows = manifest.drop("intake").join(first, "text_sha256", "left").join(verdicts.where("problem is null or problem <> 'unknown_key'"), "id")
    review = rows.select("id", "context", "text_sha256", "declared_chars", "n_chars", "n_words", "warnings", F.when(F.col("first") < F.col("id"), F.col("first")).alias("duplicate_of"), "decision", "problem", "source")
    review.repartition("source", F.pmod(F.xxhash64("id"), F.lit(16))).write.mode("overwrite").partitionBy("source").parquet(f"{out}/review")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in review.schema)
    result = spark.read.schema(shape).parquet(f"{out}/review")
    by = ("context", "source", "decision")
    counts = result.groupBy(*by).agg(F.count_if(F.col("duplicate_of").isNotNull()).alias("duplicates"), F.count_if(F.col("warnings") != "").alias("with_warnings"), F.count_if(F.col("problem").isNotNull()).alias("problems"))
    summary = medians(result, by, ("n_words",))
    on = [summary[c].eqNullSafe(counts[c]) for c in by]
    summary = summary.join(counts, on).select(summary["*"], "duplicates", "with_warnings", "problems")
    summary.coalesce(1).write.mode("overwrite").partitionBy("context").parquet(f"{out}/summary")
    log.info("wrote %d rows to %s/review and the summary to %s/summary", result.count(), out, out)
    return result


if __name__ == "__main__":
    main(NAME, {"documents": "Parquet table of texts", "decisions": "Parquet table of decisions", "out": "output folder"}, run)
