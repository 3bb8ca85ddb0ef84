"""Genomic views of the driver's tables, in Spark and, word for word the same rules, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CONTEXTS = ["F", "O"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-overlapping elements from part: id, chrom, start, end, summit."""
    x = table(spark, sf_dir, "part").selectExpr("p_partkey as id", "concat('chr', p_partkey % 3) as chrom", "(p_partkey div 3) * 120 + 10 as start", "(p_partkey div 3) * 120 + 30 + p_size as `end`")
    return x.withColumn("summit", F.expr("start + (`end` - start) div 2"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assay units from lineitem: unit_id, chrom, start, end, library, assay, context, strand."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as unit_id", "concat('chr', l_partkey % 3) as chrom", "(l_partkey div 3) * 120 + ((l_orderkey * 37 + l_linenumber * 11) % 180) as start",
        "(l_partkey div 3) * 120 + ((l_orderkey * 37 + l_linenumber * 11) % 180) + cast(l_quantity as bigint) as `end`", "concat('lib', l_suppkey % 4, '_', l_linestatus) as library",
        "case when l_suppkey % 2 = 0 then 'atac' else 'h3k27ac' end as assay", "l_linestatus as context", "case l_returnflag when 'A' then '-' else '+' end as strand",
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start sites from supplier: name, chrom, pos, strand."""
    return table(spark, sf_dir, "supplier").selectExpr("s_name as name", "concat('chr', s_suppkey % 3) as chrom", "s_suppkey * 800 + s_nationkey as pos", "case when s_nationkey % 2 = 0 then '+' else '-' end as strand")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping scored segments from events: event_id, chrom, start, end, value, replicate."""
    at = "timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts)"
    return table(spark, sf_dir, "events").selectExpr("event_id", "concat('u', user_id) as chrom", f"cast({at} as bigint) as start", f"cast({at} as bigint) + 600 * (1 + event_id % 60) as `end`", "value", "event_id % 3 as replicate")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contact matrix of 40 bins from lineitem: bin1, bin2, count."""
    return table(spark, sf_dir, "lineitem").selectExpr("least(l_partkey % 40, l_suppkey % 40) as bin1", "greatest(l_partkey % 40, l_suppkey % 40) as bin2").groupBy("bin1", "bin2").agg(F.count("*").alias("count"))


def sizes(spark: SparkSession) -> DataFrame:
    """Chromosome sizes; the order is chr2, chr0, chr1, not that of the names."""
    return spark.createDataFrame([("chr2", 3_000_000, 1), ("chr0", 2_500_000, 2), ("chr1", 4_000_000, 3)], "chrom string, size long, rank int")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment records from lineitem: flag bits, quality, template length, position."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as read_id", "case when l_partkey % 50 = 0 then 'chrM' else concat('chr', l_partkey % 3) end as chrom",
        "cast(3 + 4 * (case when l_orderkey % 11 = 0 then 1 else 0 end) + 16 * (l_linenumber % 2) + 256 * (case when l_partkey % 13 = 0 then 1 else 0 end) + 1024 * (case when l_suppkey % 7 = 0 then 1 else 0 end) as int) as flag",
        "cast(l_quantity as int) as mapq", "cast((l_orderkey * 31 + l_linenumber * 17) % 601 - 300 as int) as tlen", "(l_partkey div 3) * 120 + 1 as pos", "concat('lib', l_suppkey % 4) as library", "l_extendedprice as quality",
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5' ends from lineitem, crowded around the sites of suppliers and, one line of an order, spread out: assay, chrom, pos, strand."""
    at = "case when l_linenumber = 1 then (l_orderkey * 7919) % 2400000 else (l_suppkey * 5003) % 2400000 + ((l_orderkey * 37 + l_linenumber * 11) % 90 + (l_partkey * 13) % 91) + case l_returnflag when 'A' then 120 else 0 end end"
    return table(spark, sf_dir, "lineitem").selectExpr("case when l_suppkey % 2 = 0 then 'atac' else 'h3k27ac' end as assay", "concat('chr', l_suppkey % 3) as chrom", f"{at} as pos", "case l_returnflag when 'A' then '-' else '+' end as strand")


#: The same views as common table expressions; s and e are start and end.
ELEMENTS = "elements AS (SELECT p_partkey AS id, 'chr' || (p_partkey % 3) AS chrom, (p_partkey // 3) * 120 + 10 AS s, (p_partkey // 3) * 120 + 30 + p_size AS e, (p_partkey // 3) * 120 + 10 + (20 + p_size) // 2 AS summit FROM part)"
UNITS = (
    "units AS (SELECT l_orderkey * 8 + l_linenumber AS unit_id, 'chr' || (l_partkey % 3) AS chrom, (l_partkey // 3) * 120 + ((l_orderkey * 37 + l_linenumber * 11) % 180) AS s, "
    "(l_partkey // 3) * 120 + ((l_orderkey * 37 + l_linenumber * 11) % 180) + CAST(l_quantity AS BIGINT) AS e, 'lib' || (l_suppkey % 4) || '_' || l_linestatus AS library, "
    "CASE WHEN l_suppkey % 2 = 0 THEN 'atac' ELSE 'h3k27ac' END AS assay, l_linestatus AS context, CASE l_returnflag WHEN 'A' THEN '-' ELSE '+' END AS strand FROM lineitem)"
)
TAGS = (
    "tags AS (SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'atac' ELSE 'h3k27ac' END AS assay, 'chr' || (l_suppkey % 3) AS chrom, CASE WHEN l_linenumber = 1 THEN (l_orderkey * 7919) % 2400000 "
    "ELSE (l_suppkey * 5003) % 2400000 + ((l_orderkey * 37 + l_linenumber * 11) % 90 + (l_partkey * 13) % 91) + CASE l_returnflag WHEN 'A' THEN 120 ELSE 0 END END AS pos, CASE l_returnflag WHEN 'A' THEN '-' ELSE '+' END AS strand FROM lineitem)"
)
SITES = "sites AS (SELECT s_name AS name, 'chr' || (s_suppkey % 3) AS chrom, s_suppkey * 800 + s_nationkey AS pos, CASE WHEN s_nationkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM supplier)"
SEGMENTS = "segments AS (SELECT event_id, 'u' || user_id AS chrom, date_diff('second', TIMESTAMP '2024-01-01', ts) AS s, date_diff('second', TIMESTAMP '2024-01-01', ts) + 600 * (1 + event_id % 60) AS e, value, event_id % 3 AS replicate FROM events)"
PIXELS = "pixels AS (SELECT least(l_partkey % 40, l_suppkey % 40) AS b1, greatest(l_partkey % 40, l_suppkey % 40) AS b2, count(*) AS n FROM lineitem GROUP BY 1, 2)"
SIZES = "sizes(chrom, size, rank) AS (VALUES ('chr2', 3000000, 1), ('chr0', 2500000, 2), ('chr1', 4000000, 3))"
ALIGNMENTS = (
    "alignments AS (SELECT l_orderkey * 8 + l_linenumber AS read_id, CASE WHEN l_partkey % 50 = 0 THEN 'chrM' ELSE 'chr' || (l_partkey % 3) END AS chrom, "
    "CAST(3 + 4 * (CASE WHEN l_orderkey % 11 = 0 THEN 1 ELSE 0 END) + 16 * (l_linenumber % 2) + 256 * (CASE WHEN l_partkey % 13 = 0 THEN 1 ELSE 0 END) + 1024 * (CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS flag, "
    "CAST(l_quantity AS INTEGER) AS mapq, CAST((l_orderkey * 31 + l_linenumber * 17) % 601 - 300 AS INTEGER) AS tlen, (l_partkey // 3) * 120 + 1 AS pos, 'lib' || (l_suppkey % 4) AS library, l_extendedprice AS quality FROM lineitem)"
)
