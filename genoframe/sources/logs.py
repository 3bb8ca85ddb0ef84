"""What quality reports need from logs and artifacts: parsers of whole texts, and the files of a result folder by kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The kinds of artifacts that a report reads, and where a result folder holds them.
REPORT_SOURCES = {
    "manifest": "provenance/manifests/*.tsv",
    "resolved_config": "provenance/resolved_config.json",
    "qc_metrics": "qc/metrics.json",
    "master_metrics": "atac/master/master_dhs.json",
    "tss_profile": "qc/tss/*.profile.png",
    "fragment_histogram": "qc/fragments/*.histogram.tsv",
    "cross_correlation": "qc/chip/*.cross_correlation.txt",
    "multiqc_report": "qc/multiqc/multiqc_report.html",
}


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """path and text of every file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def _number(text: Column, pattern: str, kind: str = "long") -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast(kind)


def flagstat_log(logs: DataFrame) -> DataFrame:
    """``logs`` with total_alignments, mapped_alignments and properly_paired of a flagstat text; null where a line is missing."""
    lines = {"total_alignments": "in total", "mapped_alignments": r"mapped \(", "properly_paired": r"properly paired \("}
    return logs.select(*[c for c in logs.columns if c != "text"], *[_number(F.col("text"), rf"(?m)^(\d+) \+ \d+ {said}").alias(n) for n, said in lines.items()])


def aligner_log(logs: DataFrame, paired: bool) -> DataFrame:
    """``logs`` with reads, aligned_0, aligned_1, aligned_more and alignment_rate of an aligner's summary; fails where the counts do not add up."""
    how = "concordantly " if paired else ""
    cases = {"aligned_0": "0 times", "aligned_1": "exactly 1 time", "aligned_more": ">1 times"}
    found = logs.select(*[c for c in logs.columns if c != "text"], _number(F.col("text"), r"(?m)^(\d+) reads; of these:").alias("reads"), *[_number(F.col("text"), rf"(?m)^\s*(\d+) \([^\n]+\) aligned {how}{said}$").alias(n) for n, said in cases.items()])
    sound = F.col("aligned_0") + F.col("aligned_1") + F.col("aligned_more") == F.col("reads")
    checked = F.when(sound, F.col("reads")).otherwise(F.raise_error(F.lit("an aligner's counts do not add up")).cast("long"))
    return found.withColumn("reads", checked).withColumn("alignment_rate", F.when(F.col("reads") > 0, 100.0 * (F.col("aligned_1") + F.col("aligned_more")) / F.col("reads")).otherwise(0.0))


def chunk_totals(found: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Summaries of the chunks of a library as one, with the number of chunks."""
    sums = [F.sum(c).alias(c) for c in ("reads", "aligned_0", "aligned_1", "aligned_more")]
    out = found.groupBy(*by).agg(*sums, F.count("*").alias("chunks"))
    return out.withColumn("alignment_rate", F.when(F.col("reads") > 0, 100.0 * (F.col("aligned_1") + F.col("aligned_more")) / F.col("reads")).otherwise(0.0))


def cross_correlation(logs: DataFrame) -> DataFrame:
    """``logs`` with read_count, estimated shifts, NSC, RSC, quality tag and the first shift of one-line tab-separated reports."""
    f = F.split(F.regexp_replace("text", r"\s+$", ""), "\t")
    last = lambda n: F.trim(F.element_at(f, F.lit(-n)))
    checked = F.when((F.size(f) >= 11) & (F.instr("text", "\t") > 0), F.trim(f[2])).otherwise(F.raise_error(F.lit("not a cross-correlation report")).cast("string"))
    rows = logs.withColumn("shifts", checked)
    return rows.select(*[c for c in logs.columns if c != "text"], F.trim(f[1]).cast("long").alias("read_count"), "shifts", last(3).try_cast("double").alias("nsc"), last(2).try_cast("double").alias("rsc"), last(1).try_cast("int").alias("quality_tag"), F.split_part("shifts", F.lit(","), F.lit(1)).try_cast("long").alias("fragment_length"))


def profile_enrichment(logs: DataFrame, reach: float = 2000.0, center: float = 50.0, flank: float = 100.0) -> DataFrame:
    """``logs`` with tss_enrichment of a profile text: the first line whose fields from the third on are all numbers.

    The bins span ``reach`` on both sides; the largest of the central ones over
    the mean of the outermost; null without a profile or a background.
    """
    fields = F.transform(F.split("text", r"\r?\n"), lambda line: F.filter(F.slice(F.split(line, "\t"), 3, 1 << 30), lambda v: F.trim(v) != ""))
    numbers = F.transform(fields, lambda line: F.transform(line, lambda v: v.try_cast("double")))
    whole = F.filter(numbers, lambda line: (F.size(line) > 0) & F.forall(line, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    rows = logs.withColumn("__p", F.try_element_at(whole, F.lit(1)))
    width = 2 * reach / F.size("__p")
    at = lambda i: -reach + (i + 0.5) * width
    outer = F.filter("__p", lambda v, i: (at(i) < -reach + flank) | (at(i) >= reach - flank))
    inner = F.filter("__p", lambda v, i: (at(i) >= -center) & (at(i) < center))
    background = F.aggregate(outer, F.lit(0.0), lambda a, v: a + v) / F.nullif(F.size(outer), F.lit(0))
    return rows.withColumn("tss_enrichment", F.when(background > 0, F.array_max(inner) / background)).drop("__p", "text")


def report_sources(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(path, kind, source_root, sha256) of the artifacts under result folders, each file once.

    Only files with a name that some kind has are opened: others, such as alignments, are listed and left.
    """
    names = "{" + ",".join(sorted({p.rsplit("/", 1)[-1] for p in REPORT_SOURCES.values()})) + "}"
    out = None
    for root in sorted({r.rstrip("/") for r in roots}):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(root)
        inner = F.regexp_replace("path", "^file:/+", "/").substr(F.lit(len(root.removeprefix("file://")) + 2), F.length("path"))
        kind = F.lit(None).cast("string")
        for name, pattern in REPORT_SOURCES.items():
            regex = "^" + pattern.replace(".", r"\.").replace("*", "[^/]*") + "$"
            kind = F.when(inner.rlike(regex), name).otherwise(kind)
        found = files.withColumn("kind", kind).where("kind is not null").select("path", "kind", F.lit(root).alias("source_root"), F.sha2("content", 256).alias("sha256"))
        out = found if out is None else out.unionByName(found)
    return out.dropDuplicates(["path"])
