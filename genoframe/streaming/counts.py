"""Counting units as their files arrive: the batch operators over a file stream, with exact totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.intervals import count_overlaps

UNITS = "unit_id long, chrom string, start long, end long, library string, assay string, context string, strand string"


def unit_stream(spark: SparkSession, path: str, schema: str = UNITS, files_per_batch: int = 64) -> DataFrame:
    """Unit files (Parquet) as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def maintain_counts(units: DataFrame, elements: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ("library", "assay", "context"), width: int = 1024) -> StreamingQuery:
    """Keep per-batch counts of units over elements under ``path``; a batch that is replayed replaces itself, so it counts once."""

    def write(batch: DataFrame, n: int) -> None:
        count_overlaps(elements, batch, width, by=by).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return units.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_counts(spark: SparkSession, path: str, by: tuple[str, ...] = ("library", "assay", "context"), key: str = "id") -> DataFrame:
    """Totals over all batches so far."""
    return spark.read.parquet(path).groupBy(key, *by).agg(F.sum("raw_count").alias("raw_count"))
