"""Stages of the corpus pipeline: toxic documents go, one of each near-duplicate group stays, repeats and leaks are cut, texts are encoded.

Each stage takes (spark, docs, sf_dir) and works on every row that its
predecessor kept.  All but the last return the columns of ``docs``, whatever
else they hold and are called; n_chars, where there is one, follows the text.
Null and empty texts and rows without doc_id pass every stage; repeated rows
share their fate; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, decontam, near_dup, substring, toxicity
from .work import Work, join_checked, pack, tracked, unpack

#: Documents more than this share of whose words is benchmark text are rejected; the others lose the words.
MAX_COVERAGE = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the network does not call toxic; it learns from the labels of ``documents`` that are not held out."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = toxicity.fit(source, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return unpack(toxicity.score(pack(docs), network).where("toxic_predicted = 0"), docs, F.lit(False))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the smallest doc_id.  Five-word shingles, 0.8."""
    work = Work(spark, "pipeline")
    gone = work.save(near_dup.near_duplicates(docs, k=5, percent=80).where("not kept").select("doc_id").distinct(), "gone")
    return join_checked(docs, gone, "doc_id", "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word passages that stand earlier too; a text that loses all its words stays as an empty one."""
    return substring.rewrite(docs)


def cut_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark passages; documents that are mostly such words go."""
    return decontam.rewrite(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), max_coverage=MAX_COVERAGE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of every text."""
    return bpe.encode(docs, bpe.word_bpe())


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("substring_dedup", cut_repeats), ("decontamination", cut_leaks), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with tracked() as used:
            before, docs = docs, work.save(stage(spark, docs, sf_dir), name)
        for w in used:
            w.close()
        work.drop(before)
    return docs
