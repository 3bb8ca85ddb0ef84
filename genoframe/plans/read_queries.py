"""Queries on alignment records, units and read-level summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reads as rd, tables as tb
from . import adapters as a
from .book import query
from .interval_queries import spans


@query("bitmask_filter", f"""WITH {a.ALIGNMENTS} SELECT read_id, chrom, flag, mapq, tlen FROM alignments WHERE (flag & 2) = 2 AND (flag & 1804) = 0 AND (flag & 2048) = 0 AND mapq >= 20 AND chrom <> 'chrM' AND tlen <> 0 AND abs(tlen) < 150""")
def bitmask(spark, d):
    return rd.short_fragments(rd.filter_alignments(a.alignments(spark, d), 20)).select("read_id", "chrom", "flag", "mapq", "tlen")


@query("dedup_keep_best", f"""WITH {a.ALIGNMENTS} SELECT read_id, row_number() OVER (PARTITION BY library, chrom, pos, flag & 16 ORDER BY quality DESC, read_id) > 1 AS duplicate FROM alignments""")
def dedup(spark, d):
    x = a.alignments(spark, d).withColumn("reverse", F.col("flag").bitwiseAND(rd.REVERSE))
    return rd.mark_duplicates(x, ("library", "chrom", "pos", "reverse"), (F.col("quality").desc(), "read_id")).select("read_id", "duplicate")


_RECORDS = {
    "library": "concat('lib', l_orderkey % 3)", "read": "concat('r', l_orderkey, '_', (l_linenumber - 1) div 2)",
    "flag": "cast(1 + case when l_linenumber % 2 = 0 then 16 else 0 end + case when l_tax = 0.08 then 256 else 0 end + case when l_discount = 0.1 then 4 else 0 end as int)",
    "chrom": "concat('chr', l_orderkey % 2)",
    "pos": "(l_orderkey * 31) % 40 * 100 + 100 + case when l_linenumber % 2 = 0 then 150 + (l_orderkey * 17) % 3 * 10 else case l_suppkey % 4 when 1 then 5 when 3 then 6 else 0 end end",
    "cigar": "case l_suppkey % 4 when 0 then '50M' when 1 then '5S45M' when 2 then '40M2D8M5S2H' else '4H2S20M1I3N20M' end", "quality": "cast(l_quantity as bigint)",
}


def template_records(spark, d):
    """Records of paired reads from lineitem, with clipped ends, secondary and unmapped ones: library, read, line, flag, chrom, pos, cigar, quality."""
    return a.table(spark, d, "lineitem").selectExpr("l_linenumber as line", *[f"{e} as {c}" for c, e in _RECORDS.items()])


@query("template_duplicates", f"""WITH rec AS (SELECT l_linenumber AS line, {', '.join(f"{e.replace(' div ', ' // ').replace('concat(', 'concat(')} AS {c}" for c, e in _RECORDS.items())} FROM lineitem),
cl AS (SELECT *, (flag & 16) <> 0 AS rev, coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), lambda x: CAST(x AS BIGINT))), 0) AS ref, coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '^((?:[0-9]+[SH])+)', 1), '([0-9]+)', 1), lambda x: CAST(x AS BIGINT))), 0) AS lead,
coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '((?:[0-9]+[SH])+)$', 1), '([0-9]+)', 1), lambda x: CAST(x AS BIGINT))), 0) AS trail FROM rec),
en AS (SELECT *, chrom || ':' || lpad(CAST(CASE WHEN rev THEN pos - 1 + ref + trail ELSE pos - lead END AS VARCHAR), 12, '0') || CASE WHEN rev THEN 'r' ELSE 'f' END AS x FROM cl WHERE (flag & 2820) = 0),
te AS (SELECT library, read, min(x) AS lo, max(x) AS hi, count(*) AS n, sum(quality) AS q FROM en GROUP BY 1, 2),
ma AS (SELECT library, read, row_number() OVER (PARTITION BY library, lo, hi ORDER BY q DESC, read) > 1 AS dup FROM te WHERE n > 1
UNION ALL SELECT library, read, row_number() OVER (PARTITION BY library, lo ORDER BY q DESC, read) > 1 OR EXISTS (SELECT 1 FROM te p WHERE p.n > 1 AND p.library = s.library AND s.lo IN (p.lo, p.hi)) FROM te s WHERE n = 1)
SELECT rec.library, rec.read, line, flag, coalesce(dup AND (flag & 4) = 0, false) AS duplicate FROM rec LEFT JOIN ma USING (library, read)""")
def template_duplicates(spark, d):
    return rd.mark_template_duplicates(template_records(spark, d)).select("library", "read", "line", "flag", "duplicate")


@query("strand_point_projection", f"""WITH {a.UNITS} SELECT unit_id, chrom, CASE strand WHEN '+' THEN s + 4 ELSE e - 6 END AS s, CASE strand WHEN '+' THEN s + 5 ELSE e - 5 END AS e FROM units""")
def points(spark, d):
    return spans(rd.insertions(a.units(spark, d), 4, -5)).select("unit_id", "chrom", "s", "e")


@query("fragment_projection", f"""WITH {a.ALIGNMENTS} SELECT read_id, chrom, pos - 1 AS s, pos - 1 + tlen AS e FROM alignments WHERE tlen > 0""")
def fragments(spark, d):
    return spans(rd.fragments(a.alignments(spark, d))).select("read_id", "chrom", "s", "e")


@query("strand_extend_clip", f"""WITH {a.UNITS}, z(chrom, size) AS (VALUES ('chr0', 60000), ('chr1', 70000), ('chr2', 81000))
SELECT unit_id, CASE strand WHEN '+' THEN s ELSE greatest(e - 150, 0) END AS s, CASE strand WHEN '+' THEN least(s + 150, size) ELSE e END AS e FROM units JOIN z USING (chrom)""")
def extend(spark, d):
    sizes = spark.createDataFrame([("chr0", 60000), ("chr1", 70000), ("chr2", 81000)], "chrom string, size long")
    return spans(rd.extend_reads(a.units(spark, d), 150, sizes)).select("unit_id", "s", "e")


@query("histogram_count", f"""WITH {a.ALIGNMENTS} SELECT library, tlen, count(*) AS n FROM alignments WHERE tlen > 0 GROUP BY 1, 2""")
def histogram(spark, d):
    return rd.histogram(a.alignments(spark, d).where("tlen > 0"), "tlen", ("library",))


@query("histogram_median_fracs", f"""WITH {a.ALIGNMENTS}, h AS (SELECT library, tlen, count(*) AS n FROM alignments WHERE tlen > 0 GROUP BY 1, 2), c AS (SELECT *, sum(n) OVER (PARTITION BY library ORDER BY tlen) AS u, sum(n) OVER (PARTITION BY library) AS t FROM h)
SELECT library, CAST(sum(n) AS BIGINT) AS fragments, CAST(min(CASE WHEN u >= (t + 1) // 2 THEN tlen END) AS BIGINT) AS median_length, round(sum(CASE WHEN tlen < 150 THEN n ELSE 0 END) / sum(n), 9) AS fraction_below_150,
round(sum(CASE WHEN tlen BETWEEN 180 AND 250 THEN n ELSE 0 END) / sum(n), 9) AS fraction_180_250 FROM c GROUP BY library""")
def medians(spark, d):
    h = rd.histogram(a.alignments(spark, d).where("tlen > 0"), "tlen", ("library",))
    out = rd.fragment_summary(h, "tlen", ("library",))
    return out.select("library", "fragments", F.col("median_length").cast("long").alias("median_length"), *[F.round(c, 9).alias(c) for c in ("fraction_below_150", "fraction_180_250")])


@query("frip_semijoin", f"""WITH {a.UNITS}, {a.ELEMENTS}, p AS (SELECT chrom, s, e FROM elements), h AS (SELECT u.library, u.unit_id, EXISTS (SELECT 1 FROM p WHERE p.chrom = u.chrom AND u.s < p.e AND p.s < u.e) AS hit FROM units u)
SELECT library, count(*) AS frip_denominator, count(*) FILTER (WHERE hit) AS frip_numerator, round(count(*) FILTER (WHERE hit) / count(*), 9) AS frip FROM h GROUP BY library""")
def frip(spark, d):
    out = rd.frip(a.units(spark, d), a.elements(spark, d), width=256)
    return out.withColumn("frip", F.round("frip", 9))


@query("flagstat_counts", f"""WITH {a.ALIGNMENTS} SELECT library, count(*) AS total, count(*) FILTER (WHERE flag & 4 = 0) AS mapped, count(*) FILTER (WHERE flag & 1024 > 0) AS duplicates, count(*) FILTER (WHERE flag & 1 > 0) AS paired,
count(*) FILTER (WHERE flag & 3 = 3 AND flag & 4 = 0) AS properly_paired, count(*) FILTER (WHERE flag & 256 > 0) AS secondary, count(*) FILTER (WHERE flag & 2048 > 0) AS supplementary FROM alignments GROUP BY library""")
def flagstat(spark, d):
    return rd.flagstat(a.alignments(spark, d), ("library",))


@query("idxstats", f"""WITH {a.ALIGNMENTS}, {a.SIZES}, l AS (SELECT DISTINCT library FROM alignments), g AS (SELECT library, chrom, size FROM l CROSS JOIN sizes), c AS (SELECT library, chrom, count(*) FILTER (WHERE flag & 4 = 0) AS mapped, count(*) FILTER (WHERE flag & 4 > 0) AS unmapped FROM alignments GROUP BY 1, 2)
SELECT library, chrom, size, coalesce(mapped, 0) AS mapped, coalesce(unmapped, 0) AS unmapped FROM g FULL JOIN c USING (library, chrom)""")
def index_stats(spark, d):
    return rd.idxstats(a.alignments(spark, d), a.sizes(spark), ("library",))


@query("tss_profile_ratio", f"""WITH {a.UNITS}, {a.SITES}, o AS (SELECT u.library, CAST(floor((u.s - p.pos) / 10.0) AS BIGINT) * 10 AS "offset", count(*) AS value FROM units u JOIN sites p ON p.chrom = u.chrom AND abs(u.s - p.pos) <= 2000 GROUP BY 1, 2)
SELECT library, CAST(max(CASE WHEN abs("offset") <= 50 THEN value END) AS DOUBLE) AS peak, round(avg(CASE WHEN abs("offset") >= 1900 THEN value END), 9) AS background,
round(max(CASE WHEN abs("offset") <= 50 THEN value END) / avg(CASE WHEN abs("offset") >= 1900 THEN value END), 9) AS tss_enrichment FROM o GROUP BY library""")
def tss(spark, d):
    from ..operators.intervals import band_join

    near = band_join(a.units(spark, d).select("library", "chrom", F.col("start").alias("pos")), a.sites(spark, d), 2000)
    bins = near.groupBy("library", (F.floor((F.col("pos") - F.col("b_pos")) / 10) * 10).alias("offset")).agg(F.count("*").alias("value"))
    out = rd.tss_enrichment(bins, ("library",))
    return out.select("library", F.col("peak").cast("double").alias("peak"), F.round("background", 9).alias("background"), F.round("tss_enrichment", 9).alias("tss_enrichment"))


@query("chunk_assign", f"""WITH {a.UNITS} SELECT unit_id // 8 // 500 AS chunk, count(*) AS records, min(unit_id) AS first_unit, max(unit_id) AS last_unit FROM units GROUP BY 1""")
def chunks(spark, d):
    x = rd.assign_chunks(a.units(spark, d).withColumn("record", F.expr("unit_id div 8")), 500)
    return x.groupBy("chunk").agg(F.count("*").alias("records"), F.min("unit_id").alias("first_unit"), F.max("unit_id").alias("last_unit"))


@query("union_all_sum", f"""WITH {a.UNITS}, p AS (SELECT context, chrom, s, s + 1 AS e, 1 AS n FROM units WHERE strand = '+' UNION ALL SELECT context, chrom, e - 1, e, 1 FROM units WHERE strand = '-') SELECT context, chrom, s, e, count(*) AS units FROM p GROUP BY 1, 2, 3, 4""")
def pool(spark, d):
    return spans(rd.pool_units(rd.insertions(a.units(spark, d)), ("context",)))


@query("record_validate", """WITH x AS (SELECT event_id AS record, CASE WHEN event_id % 97 = 0 THEN 'x' ELSE '@' END || event_id AS t0, repeat('ACGT', CAST(1 + event_id % 5 AS INTEGER)) || CASE WHEN event_id % 89 = 0 THEN '?' ELSE '' END AS t1, CASE WHEN event_id % 83 = 0 THEN '-' ELSE '+' END AS t2,
repeat('IIII', CAST(1 + event_id % 5 AS INTEGER)) || CASE WHEN event_id % 79 = 0 THEN 'I' ELSE '' END AS t3 FROM events)
SELECT record, 'bad_header' AS violation FROM x WHERE NOT starts_with(t0, '@') UNION ALL SELECT record, 'bad_separator' FROM x WHERE NOT starts_with(t2, '+') UNION ALL SELECT record, 'bad_sequence' FROM x WHERE NOT regexp_full_match(t1, '[ACGTNacgtn.]+') UNION ALL SELECT record, 'length_mismatch' FROM x WHERE length(t1) <> length(t3)""")
def fastq(spark, d):
    e = a.table(spark, d, "events")
    n = F.expr("cast(1 + event_id % 5 as int)")
    bad = lambda m, yes, no: F.when(F.col("event_id") % m == 0, yes).otherwise(no)
    parts = [F.concat(bad(97, "x", "@"), F.col("event_id").cast("string")), F.concat(F.repeat(F.lit("ACGT"), n), bad(89, "?", "")), bad(83, "-", "+"), F.concat(F.repeat(F.lit("IIII"), n), bad(79, "I", ""))]
    lines = e.select("event_id", F.posexplode(F.array(*parts)).alias("k", "text")).select((F.col("event_id") * 4 + F.col("k")).alias("line"), "text")
    return rd.validate_fastq(lines)


@query("log_regex_agg", """SELECT event_id, TRY_CAST(nullif(regexp_extract(l, 'aligned ([0-9.]+)%', 1), '') AS DOUBLE) AS rate, TRY_CAST(nullif(regexp_extract(l, 'reads: (\\d+)', 1), '') AS DOUBLE) AS reads FROM (SELECT event_id, 'aligned ' || (event_id % 100) || '.5% of reads: ' || (event_id * 3) || ';' || event_type AS l FROM events)""")
def logs(spark, d):
    text = F.concat(F.lit("aligned "), (F.col("event_id") % 100).cast("string"), F.lit(".5% of reads: "), (F.col("event_id") * 3).cast("string"), F.lit(";"), F.col("event_type"))
    return tb.parse_log(a.table(spark, d, "events").select("event_id", text.alias("text")), {"rate": r"aligned ([0-9.]+)%", "reads": r"reads: (\d+)"})
