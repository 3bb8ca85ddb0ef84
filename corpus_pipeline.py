"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genoframe.llm import pipeline as _stages

#: (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = _stages.STAGES

#: Learned scores, minhashes and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    return _stages.run(spark, sf_dir)
