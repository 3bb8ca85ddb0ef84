"""The jobs as queries: each runs twice into one new folder and returns what that holds then."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from genoframe.plans.activity_queries import SIGNAL

from . import document_review, library_signal
from .common import config


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; a temporary one where that is unset on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="genoframe-jobs-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, library_signal.NAME)
    given = {"units": f"{sf_dir}/lineitem.parquet", "elements": f"{sf_dir}/part.parquet", "out": f"{folder}/out", "checkpoint": f"{folder}/checkpoint"}
    library_signal.run(spark, **given, settings=config(library_signal.NAME))
    return library_signal.run(spark, **given, settings=config(library_signal.NAME)).withColumn("cpm_per_kb", F.round("cpm_per_kb", 6))


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {"documents": f"{sf_dir}/documents.parquet", "decisions": f"{sf_dir}/labels.parquet", "out": _folder(spark, document_review.NAME)}
    document_review.run(spark, **given, settings=config(document_review.NAME))
    return document_review.run(spark, **given, settings=config(document_review.NAME))


QUERIES = {"job1_library_signal": signal, "job2_document_review": review}

ORACLE_SQL = {
    "job1_library_signal": f"WITH {SIGNAL} SELECT id, library, assay, context, raw_count, total_units, round(cpm_per_kb, 6) AS cpm_per_kb FROM signal",
    "job2_document_review": r"""
WITH m AS (SELECT DISTINCT doc_id AS id, source, lang AS context, sha256(text) AS text_sha256, CAST(n_chars AS BIGINT) AS declared_chars, CAST(length(text) AS BIGINT) AS n_chars,
    CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_words FROM documents WHERE doc_id IS NOT NULL),
w AS (SELECT *, count(*) OVER (PARTITION BY id) AS c, min(id) OVER (PARTITION BY text_sha256) AS first FROM m),
v AS (SELECT doc_id AS id, count(*) AS n, max(CASE WHEN quality IS NULL OR toxic IS NULL THEN NULL WHEN quality = 1 AND toxic = 0 THEN 'accept' ELSE 'reject' END) AS decision FROM labels GROUP BY 1)
SELECT w.id, source, context, text_sha256, declared_chars, n_chars, n_words,
    concat_ws(';', CASE WHEN n_chars IS NULL THEN 'no text' END, CASE WHEN n_words = 0 THEN 'empty' END, CASE WHEN n_words > 0 AND n_words < 20 THEN 'short' END,
        CASE WHEN declared_chars IS DISTINCT FROM n_chars THEN 'size differs' END, CASE WHEN c > 1 THEN 'repeated id' END) AS warnings,
    CASE WHEN text_sha256 IS NOT NULL AND first < w.id THEN first END AS duplicate_of, decision,
    CASE WHEN n IS NULL THEN 'missing_decision' WHEN n > 1 THEN 'repeated_decision' WHEN decision NOT IN ('accept', 'reject') THEN 'unknown_decision' END AS problem
FROM w LEFT JOIN v USING (id)""",
}
