"""Readers of the text formats; every one gives typed columns and keeps the order of lines where it has a meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def delimited(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """A headed CSV or TSV as trimmed text columns; blank rows are dropped, repeated headers fail.

    The separator follows the suffix, else the first line that has a tab, semicolon or comma.
    """
    if separator is None:
        name = path.lower().removesuffix(".gz")
        separator = "\t" if name.endswith((".tsv", ".tab")) else "," if name.endswith(".csv") else None
    if separator is None:
        head = spark.read.text(path).limit(1).first()
        separator = next((s for s in "\t;" if head and s in head[0]), ",")
    first = spark.read.text(path).limit(1).first()
    names = [n.strip().strip('"') for n in (first[0] if first else "").removeprefix("﻿").split(separator)]
    if len(set(names)) != len(names):
        raise ValueError(f"{path}: repeated column names")
    df = spark.read.csv(path, sep=separator, header=True, inferSchema=False, encoding="UTF-8", enforceSchema=True, schema=", ".join(f"`{n}` string" for n in names))
    return df.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in df.columns]).dropna("all")


def exact_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A gzipped TSV whose header must be the schema's columns, in order."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=False, mode="FAILFAST")


# The columns of the published tables.
PUBLISHED = {
    "signal": "library_id string, cohort string, assay string, context string, master_dhs_id string, chrom string, start long, end long, summit long, width_bp long, raw_count long, total_units long, cpm_per_kb double",
    "windows": "master_dhs_id string, window_id string, chrom string, summit long, window string, start long, end long, width_bp long",
    "factors": "library_id string, assay string, context string, total_units long, tmm_normalization_factor double, effective_library_size double, feature_count long",
    "members": "master_dhs_id string, context string, name string",
    "mixtures": "context string, positive_member_n long, mixture_supported int, support_reason string, bic_one_component double, bic_two_component double, delta_bic double, low_mean_log10 double, high_mean_log10 double, low_sd_log10 double, high_sd_log10 double, low_weight double, high_weight double, ashman_d double, posterior_crossing_log10 double, posterior_crossing_signal double",
    "summary": "context string, regulatory_class string, mixture_component string, mixture_supported int, guardrail_failures string, element_n long",
}
_KINDS = {"start": "long", "end": "long", "summit": "long", "anchor": "long", "width_bp": "long", "element_start": "long", "element_end": "long", "element_summit": "long"}


def _kind(field: str) -> str:
    if field in _KINDS or field.endswith(("_bp", "_count", "_n", "_count_sum")):
        return "long"
    if field.endswith(("_rank", "_active", "accessible", "_overlap", "same_contact_bin", "membership", "_supported", "_warning", "_high_posterior")) or field == "active":
        return "int"
    numbers = ("signal", "posterior", "activity", "contact", "weight", "expected", "score", "per_kb", "_fraction", "log10_z", "probability", "max_500")
    return "double" if field.endswith(numbers) else "string"


def published(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A published table by name: those of ``PUBLISHED``, and catalog, nodes, edges and genes; its header must be that table's."""
    from ..operators.catalog import CATALOG_FIELDS
    from ..operators.links import EDGE_FIELDS, GENE_FIELDS, NODE_FIELDS

    wide = {"catalog": CATALOG_FIELDS, "nodes": NODE_FIELDS, "edges": EDGE_FIELDS, "genes": GENE_FIELDS}
    schema = PUBLISHED.get(name) or ", ".join(f"`{f}` {_kind(f)}" for f in wide[name])
    return exact_table(spark, path, schema)


def chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom, size and rank: the order of the lines (a handful, read on the driver)."""
    rows = [r[0].split("\t") for r in spark.read.text(path).collect() if r[0].strip()]
    return spark.createDataFrame([(r[0], int(r[1]), i) for i, r in enumerate(rows, 1)], "chrom string, size long, rank int")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Fields of tab-separated lines without comments and track lines, and ``line``, which grows through a file."""
    text = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    return text.where("value <> '' and not (value like '#%' or value like 'track%' or value like 'browser%')").select("line", F.split("value", "\t").alias("f"))


def bed(spark: SparkSession, path: str) -> DataFrame:
    """BED3 and wider: chrom, start, end, name (given or made from the place), score in 0..1000, strand, line."""
    at = lambda i: F.try_element_at("f", F.lit(i))
    made = F.concat_ws("_", at(1), at(2), at(3))
    return _lines(spark, path).select(
        at(1).alias("chrom"), at(2).cast("long").alias("start"), at(3).cast("long").alias("end"), F.coalesce(F.nullif(at(4), F.lit(".")), made).alias("name"),
        F.greatest(F.lit(0), F.least(F.lit(1000), F.coalesce(at(5).try_cast("double").cast("int"), F.lit(0)))).alias("score"), F.coalesce(at(6), F.lit(".")).alias("strand"), "line",
    )


def bedgraph(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, value."""
    return _lines(spark, path).select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"), F.col("f")[3].cast("double").alias("value"))


def gtf_attribute(text: Column, name: str) -> Column:
    return F.regexp_extract(text, f'{name} "([^"]+)"', 1)


def canonical_chromosome(c: Column) -> Column:
    """With the prefix chr."""
    return F.when(F.startswith(c, F.lit("chr")), c).otherwise(F.concat(F.lit("chr"), c))


def gtf_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Transcripts, zero-based: chrom, start, end, strand, gene_id, gene_name (the id if none), transcript_id, line."""
    f, text = F.col("f"), F.col("f")[8]
    x = _lines(spark, path).where(f[2] == "transcript")
    gene = gtf_attribute(text, "gene_id")
    return x.select(
        canonical_chromosome(f[0]).alias("chrom"), (f[3].cast("long") - 1).alias("start"), f[4].cast("long").alias("end"), f[6].alias("strand"), gene.alias("gene_id"),
        F.coalesce(F.nullif(gtf_attribute(text, "gene_name"), F.lit("")), gene).alias("gene_name"), gtf_attribute(text, "transcript_id").alias("transcript_id"), "line",
    )


def fastq_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, text) of one file, numbered from 0 across its partitions by their line counts."""
    text = spark.read.text(path).select(F.col("value").alias("text"), F.monotonically_increasing_id().alias("at"))
    part = F.shiftright("at", 33)
    from pyspark.sql import Window

    before = text.groupBy(part.alias("part")).agg(F.count("*").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return text.withColumn("part", part).join(F.broadcast(before), "part").select((F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("line"), "text")


def assay_units(spark: SparkSession, path: str, sizes: DataFrame, total: int) -> DataFrame:
    """chrom, start, end and line of a unit file; fails on empty units, unknown chromosomes, lines out of order and another number of lines than ``total``.

    Order is by chromosome rank, start and end.  A unit is compared with the
    last of the unit's partition before it; borders between partitions meet in
    a table of one row each.
    """
    from pyspark.sql import Window

    x = bed(spark, path).select("chrom", "start", "end", "line").join(F.broadcast(sizes.select("chrom", "size", "rank")), "chrom", "left")
    x = x.withColumn("place", F.struct("rank", "start", "end")).withColumn("part", F.shiftright("line", 33))
    within, parts = Window.partitionBy("part").orderBy("line"), Window.orderBy("part")
    ends = x.groupBy("part").agg(F.max_by("place", "line").alias("last"), F.count("*").alias("c"))
    carried = ends.select("part", F.lag("last").over(parts).alias("before"), F.sum("c").over(Window.partitionBy()).alias("n"))
    seen = x.join(F.broadcast(carried), "part").withColumn("p", F.coalesce(F.lag("place").over(within), "before"))
    problem = (
        F.when(F.col("rank").isNull() | (F.col("start") < 0) | (F.col("end") <= F.col("start")) | (F.col("end") > F.col("size")), "an invalid assay unit")
        .when(F.col("place") < F.col("p"), "units are not sorted").when(F.col("n") != total, "another number of units than expected")
    )
    good = F.when(problem.isNull(), True).otherwise(F.raise_error(problem).cast("boolean"))
    return seen.where(good).select("chrom", "start", "end", "line")


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Records of SAM text: library (the file), read, flag, chrom, pos (from 1), mapq, cigar, tlen, bases on the reference, end, strand; header lines are left out."""
    text = spark.read.text(path).where("value <> '' and not value like '@%'").select(F.input_file_name().alias("file"), F.split("value", "\t").alias("f"))
    f = F.col("f")
    spans = F.transform(F.regexp_extract_all(f[5], F.lit(r"(\d+)[MDN=X]"), F.lit(1)), lambda n: n.cast("long"))
    bases = F.aggregate(spans, F.lit(0).cast("long"), lambda a, n: a + n)
    rows = text.select(
        F.regexp_extract("file", r"([^/]+?)(?:\.sam)?(?:\.gz)?$", 1).alias("library"), f[0].alias("read"), f[1].cast("int").alias("flag"), f[2].alias("chrom"), f[3].cast("long").alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[8].cast("int").alias("tlen"), bases.alias("bases")
    )
    return rows.withColumn("end", F.col("pos") - 1 + F.col("bases")).withColumn("strand", F.when(F.col("flag").bitwiseAND(16) == 16, "-").otherwise("+"))


def pixels(spark: SparkSession, path: str, resolution: int) -> DataFrame:
    """A matrix dumped as text (chrom1, start1, end1, chrom2, start2, end2, count): chrom, bin1 <= bin2, count within chromosomes."""
    f = F.col("f")
    x = _lines(spark, path).where(f[0] == f[3]).select(f[0].alias("chrom"), F.expr(f"cast(f[1] as long) div {resolution}").alias("a"), F.expr(f"cast(f[4] as long) div {resolution}").alias("b"), f[6].cast("double").alias("count"))
    return x.select(canonical_chromosome(F.col("chrom")).alias("chrom"), F.least("a", "b").alias("bin1"), F.greatest("a", "b").alias("bin2"), "count")
