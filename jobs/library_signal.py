"""Library signal as unit files arrive: counts of every element in every library, kept up to date.

    python -m jobs.library_signal --units UNITS --elements ELEMENTS --out OUT --checkpoint CHECKPOINT [--config FILE]

Sequencing units come as Parquet files that are added to UNITS.  A run takes
the files that the stream's checkpoint does not know, counts them over the
elements, and rewrites the signal of the assays and contexts that gained
units; other partitions are not touched.  A batch is written under its number,
so one that is replayed replaces itself, and a run that stopped between counts
and signal is made good by the next: partitions are chosen by comparing the
totals in both.

OUT/elements   the elements of the first run; a later run with others is refused
OUT/counts     batch=N/assay=A: units by element and library; rows without id are library totals
OUT/signal     assay=A/context=C: id, library, raw_count, total_units, cpm_per_kb

A unit without library, assay or context, or without a place, counts for
nothing and is reported.  Units must be added in new files.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from genoframe.operators.intervals import count_overlaps
from genoframe.operators.quantify import LIBRARY, signal_of_counts

from .common import existing, main, mapped

log = logging.getLogger("library_signal")

NAME = "library_signal"
_ELEMENTS = "id long, chrom string, start long, end long"
_COUNTS = "id long, library string, context string, n long, batch long, assay string"
_SIGNAL = "id long, library string, raw_count long, total_units long, cpm_per_kb double, assay string, context string"


def _fixed_elements(spark: SparkSession, elements: DataFrame, path: str) -> DataFrame:
    """The elements that counts are over: those of the first run."""
    if existing(spark, path, _ELEMENTS) is None:
        elements.write.mode("overwrite").parquet(path)
    kept = spark.read.schema(_ELEMENTS).parquet(path)
    if kept.exceptAll(elements).limit(1).count() or elements.exceptAll(kept).limit(1).count():
        raise ValueError(f"the elements are not those that {path} was made with; choose another output folder")
    return kept


def _take_new_units(spark: SparkSession, units: str, elements: DataFrame, out: str, checkpoint: str, settings: Mapping) -> None:
    """Count the units of files that the checkpoint does not know; returns when all of them are taken."""
    parent, _, name = units.rstrip("/").rpartition("/")
    pattern = f"{parent}/{{{name}}}" if parent else f"{{{name}}}"  # a stream over a plain path wants a folder; a pattern may also name one file
    files = spark.readStream.schema(spark.read.parquet(units).schema).option("maxFilesPerTrigger", settings["files_per_batch"]).parquet(pattern)

    def write(batch: DataFrame, n: int) -> None:
        found = mapped(batch, settings["units"]).persist()
        good = found.dropna(subset=["chrom", "start", "end", *LIBRARY])
        totals = good.groupBy(*LIBRARY).agg(F.count("*").alias("n")).select(F.lit(None).cast("long").alias("id"), *LIBRARY, "n")
        counts = count_overlaps(elements, good, settings["bin_width"], by=LIBRARY).select("id", *LIBRARY, F.col("raw_count").alias("n"))
        counts.unionByName(totals).write.mode("overwrite").partitionBy("assay").parquet(f"{out}/counts/batch={n}")
        taken = found.count()
        log.info("batch %d: %d units read from %s, %d of them without library or place", n, taken, units, taken - good.count())
        found.unpersist()

    query = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run(spark: SparkSession, units: str, elements: str, out: str, checkpoint: str, settings: Mapping) -> DataFrame:
    """Count new unit files over elements and bring the signal table up to date; returns that table."""
    table = spark.read.parquet(elements)
    kept = _fixed_elements(spark, mapped(table, settings["elements"]).select(*[F.col(c).cast(t).alias(c) for c, t in (("id", "long"), ("chrom", "string"), ("start", "long"), ("end", "long"))]), f"{out}/elements")
    log.info("read %d elements from %s", kept.count(), elements)
    _take_new_units(spark, units, kept, out, checkpoint, settings)

    none = spark.createDataFrame([], _SIGNAL)
    counts = existing(spark, f"{out}/counts", _COUNTS)
    if counts is None:
        log.info("no units yet; nothing written")
        return none
    totals = counts.where("id is null").groupBy(*LIBRARY).agg(F.sum("n").alias("total_units"))
    made = existing(spark, f"{out}/signal", _SIGNAL)
    known = None if made is None else made.groupBy(*LIBRARY).agg(F.max("total_units").alias("known"))
    stale = totals if known is None else totals.join(known, list(LIBRARY), "left").where(~F.col("total_units").eqNullSafe(F.col("known")))
    parts = stale.select("assay", "context").distinct().collect()  # a handful: assays x contexts
    if parts:
        in_parts = F.struct("assay", "context").isin([F.struct(F.lit(p.assay), F.lit(p.context)) for p in parts])
        fresh = signal_of_counts(kept, counts.where(F.col("id").isNotNull() & in_parts).groupBy("id", *LIBRARY).agg(F.sum("n").alias("raw_count")), totals.where(in_parts))
        rows = fresh.select("id", "library", "raw_count", "total_units", "cpm_per_kb", "assay", "context").repartition("assay", "context", F.pmod(F.xxhash64("id"), F.lit(16)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("assay", "context").parquet(f"{out}/signal")
    result = existing(spark, f"{out}/signal", _SIGNAL)
    result = none if result is None else result
    log.info("wrote %s to %s/signal, %d rows in all", ", ".join(f"assay={p.assay}/context={p.context}" for p in parts) or "no partition", out, result.count())
    return result


if __name__ == "__main__":
    main(NAME, {"units": "folder of Parquet unit files", "elements": "Parquet table of elements", "out": "output folder", "checkpoint": "the stream's checkpoint folder"}, run)
