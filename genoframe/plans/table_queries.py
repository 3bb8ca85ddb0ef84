"""Queries on table rules: defaults, manifests, decisions, checks, digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import CLASS_COLORS, bed9_color, bed9_score, distance_class, sig10
from ..operators import quantify as qt, registry as rg, tables as tb
from . import adapters as a
from .book import query


@query("typed_defaults", """WITH x AS (SELECT o_orderkey AS id, o_orderstatus AS assay, CASE WHEN o_orderkey % 5 = 0 THEN ' ' WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 40 AS VARCHAR) END AS quality, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'true' END AS keep FROM orders)
SELECT id, assay, coalesce(TRY_CAST(nullif(trim(quality), '') AS INTEGER), CASE assay WHEN 'F' THEN 30 WHEN 'O' THEN 10 END, 20) AS quality, coalesce(TRY_CAST(nullif(trim(keep), '') AS BOOLEAN), false) AS keep FROM x""")
def defaults(spark, d):
    x = a.table(spark, d, "orders").selectExpr("o_orderkey as id", "o_orderstatus as assay", "case when o_orderkey % 5 = 0 then ' ' when o_orderkey % 7 = 0 then 'n/a' else cast(o_orderkey % 40 as string) end as quality", "case when o_orderkey % 3 = 0 then '' else 'true' end as keep")
    return tb.typed_defaults(x, {"quality": "int", "keep": "boolean"}, {"quality": 20, "keep": False}, "assay", {"F": {"quality": 30}, "O": {"quality": 10}})


@query("distinct_first_seen", "SELECT o_custkey AS value, min(o_orderkey) AS first_seen FROM orders GROUP BY 1")
def first_seen(spark, d):
    return tb.distinct_first_seen(a.table(spark, d, "orders").withColumnRenamed("o_custkey", "value"), "value", "o_orderkey")


@query("dedupe_names", f"""WITH {a.UNITS}, z(chrom, size) AS (VALUES ('chr0', 60000), ('chr1', 70000), ('chr2', 90000)), x AS (SELECT unit_id, context, 'peak' || (unit_id % 1000) AS name, s, e, size FROM units JOIN z USING (chrom)),
k AS (SELECT *, row_number() OVER (PARTITION BY context, name ORDER BY unit_id, s, e) AS k FROM x) SELECT unit_id, context, name || CASE WHEN k > 1 THEN '__duplicate_' || k ELSE '' END AS name, e AS input_end, least(e, size) AS e, e > size AS clipped FROM k""")
def names(spark, d):
    sizes = spark.createDataFrame([("chr0", 60000), ("chr1", 70000), ("chr2", 90000)], "chrom string, size long")
    x = a.units(spark, d).withColumn("name", F.concat(F.lit("peak"), (F.col("unit_id") % 1000).cast("string")))
    return rg.dedupe_names(x, sizes, ("unit_id", "start", "end")).select("unit_id", "context", "name", "input_end", F.col("end").alias("e"), "clipped")


@query("collect_sorted_set", f"WITH {a.SITES} SELECT chrom, pos // 5000 AS place, string_agg(DISTINCT name, ';' ORDER BY name) AS names FROM sites GROUP BY 1, 2")
def sorted_set(spark, d):
    x = a.sites(spark, d).groupBy("chrom", F.expr("pos div 5000").alias("place"))
    return x.agg(F.array_join(F.array_sort(F.collect_set("name")), ";").alias("names"))


@query("regex_extract", """SELECT event_id, regexp_extract(l, 'gene_id "([^"]+)"', 1) AS gene_id, regexp_extract(l, 'transcript_id "([^"]+)"', 1) AS transcript_id, CASE WHEN starts_with(c, 'chr') THEN c ELSE 'chr' || c END AS chrom
FROM (SELECT event_id, 'gene_id "g' || user_id || '"; transcript_id "t' || event_id || '";' AS l, CASE WHEN event_id % 2 = 0 THEN 'chr' ELSE '' END || (event_id % 5) AS c FROM events)""")
def attributes(spark, d):
    from ..sources.readers import canonical_chromosome, gtf_attribute

    e = a.table(spark, d, "events")
    text = F.concat(F.lit('gene_id "g'), F.col("user_id").cast("string"), F.lit('"; transcript_id "t'), F.col("event_id").cast("string"), F.lit('";'))
    chrom = F.concat(F.when(F.col("event_id") % 2 == 0, "chr").otherwise(""), (F.col("event_id") % 5).cast("string"))
    return e.select("event_id", gtf_attribute(text, "gene_id").alias("gene_id"), gtf_attribute(text, "transcript_id").alias("transcript_id"), canonical_chromosome(chrom).alias("chrom"))


@query("select_divisor", "SELECT p_brand AS source, max(CASE WHEN r <= 5000 AND 5000 % r = 0 THEN r END) AS selected FROM (SELECT p_brand, 100 * p_size AS r FROM part) GROUP BY 1")
def divisor(spark, d):
    from ..operators.contacts import select_resolution

    x = a.table(spark, d, "part").selectExpr("p_brand as source", "100 * p_size as resolution")
    return select_resolution(x, 5000).select("source", F.col("selected").cast("int").alias("selected"))


@query("group_consistency", "SELECT o_custkey AS k, count(DISTINCT o_orderstatus) AS status_n, count(DISTINCT o_orderpriority) AS priority_n FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1 OR count(DISTINCT o_orderpriority) > 1")
def consistency(spark, d):
    x = a.table(spark, d, "orders").selectExpr("o_custkey as k", "o_orderstatus as status", "o_orderpriority as priority")
    return tb.inconsistent_groups(x, "k", ("status", "priority"))


@query("static_consistency", """WITH x AS (SELECT l_orderkey AS k, l_returnflag AS f, l_linestatus AS s FROM lineitem) SELECT k, 'f' AS "column" FROM x GROUP BY k HAVING min(f) <> max(f) UNION ALL SELECT k, 's' FROM x GROUP BY k HAVING min(s) <> max(s)""")
def static(spark, d):
    return tb.static_violations(a.table(spark, d, "lineitem").selectExpr("l_orderkey as k", "l_returnflag as f", "l_linestatus as s"), "k", ("f", "s"))


@query("zip_explode", "SELECT o_orderkey AS id, i - 1 AS position, string_split(u, ';')[i] AS url, string_split(m, ';')[i] AS md5 FROM (SELECT o_orderkey, 'a' || o_orderkey || ';b' || o_custkey AS u, md5(CAST(o_orderkey AS VARCHAR)) || ';' || md5(CAST(o_custkey AS VARCHAR)) AS m, unnest([1, 2]) AS i FROM orders)")
def zipped(spark, d):
    x = a.table(spark, d, "orders").selectExpr("o_orderkey as id", "concat('a', o_orderkey, ';b', o_custkey) as url", "concat(md5(cast(o_orderkey as string)), ';', md5(cast(o_custkey as string))) as md5")
    return tb.zip_explode(x, ("url", "md5"))


_RANK = "CASE {c} WHEN 'F' THEN 3 WHEN 'P' THEN 2 ELSE 1 END"


@query("upsert_merge", f"""WITH o AS (SELECT o_custkey AS k, o_orderstatus AS state, 0 AS n FROM orders WHERE o_orderpriority < '3'), w AS (SELECT o_custkey AS k, o_orderstatus AS state, 1 AS n FROM orders WHERE o_orderpriority >= '3'),
x AS (SELECT *, {_RANK.format(c='state')} AS priority FROM (SELECT * FROM o UNION ALL SELECT * FROM w)), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY priority DESC, n DESC, state) AS j FROM x) SELECT k, state, priority FROM r WHERE j = 1""")
def upsert(spark, d):
    x = a.table(spark, d, "orders").selectExpr("o_custkey as k", "o_orderstatus as state", "o_orderpriority")
    rank = F.when(F.col("state") == "F", 3).when(F.col("state") == "P", 2).otherwise(1)
    return tb.upsert(x.where("o_orderpriority < '3'").select("k", "state"), x.where("o_orderpriority >= '3'").select("k", "state"), ["k"], "state", rank)


@query("decision_merge", """WITH m AS (SELECT c_custkey AS k FROM customer), v AS (SELECT DISTINCT o_custkey + CASE WHEN o_custkey % 31 = 0 THEN 10000000 ELSE 0 END AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'approve' WHEN '2-HIGH' THEN 'reject' ELSE 'maybe' END AS decision FROM orders),
g AS (SELECT k, count(*) AS n, max(decision) AS decision FROM v GROUP BY k) SELECT coalesce(m.k, g.k) AS k, decision, CASE WHEN m.k IS NULL THEN 'unknown_key' WHEN n IS NULL THEN 'missing_decision' WHEN n > 1 THEN 'repeated_decision' WHEN decision NOT IN ('approve', 'reject') THEN 'unknown_decision' END AS problem FROM m FULL JOIN g ON m.k = g.k""")
def decide(spark, d):
    v = a.table(spark, d, "orders").selectExpr("o_custkey + case when o_custkey % 31 = 0 then 10000000 else 0 end as k", "case o_orderpriority when '1-URGENT' then 'approve' when '2-HIGH' then 'reject' else 'maybe' end as decision").distinct()
    return tb.decisions(a.table(spark, d, "customer").selectExpr("c_custkey as k"), v, "k", ("approve", "reject"))


@query("anti_validate", "SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def missing(spark, d):
    known = a.table(spark, d, "customer").where("c_nationkey < 12").selectExpr("c_custkey as k")
    return tb.missing_keys(a.table(spark, d, "orders").selectExpr("o_custkey as k"), known, "k")


@query("union_disjoint", "SELECT o_orderkey AS k, o_totalprice AS v FROM orders")
def disjoint(spark, d):
    x = a.table(spark, d, "orders").selectExpr("o_orderkey as k", "o_totalprice as v", "o_orderstatus as s")
    return tb.union_disjoint(x.where("s = 'F'").drop("s"), x.where("s <> 'F'").drop("s"), "k")


@query("strict_equijoin", "SELECT p_partkey AS k, p_size AS x, p_retailprice AS y FROM part")
def strict(spark, d):
    p = a.table(spark, d, "part")
    return qt.strict_join(p.selectExpr("p_partkey as k", "p_size as x"), p.selectExpr("p_partkey as k", "p_retailprice as y"), ["k"])


@query("dense_grid", "SELECT p_partkey AS id, c.context FROM part, (VALUES ('F'), ('O'), ('P')) c(context)")
def grid(spark, d):
    contexts = spark.createDataFrame([("F",), ("O",), ("P",)], "context string")
    return a.table(spark, d, "part").selectExpr("p_partkey as id").crossJoin(F.broadcast(contexts))


@query("matrix_pivot", f"""WITH {a.UNITS}, {a.ELEMENTS}, c AS (SELECT x.id, u.library FROM units u JOIN elements x ON u.chrom = x.chrom AND u.s < x.e AND x.s < u.e WHERE u.assay = 'atac')
SELECT id AS feature, {', '.join(f"count(*) FILTER (WHERE library = '{x}') AS {x}" for x in ('lib0_F', 'lib0_O', 'lib2_F', 'lib2_O'))} FROM c GROUP BY id""")
def pivot(spark, d):
    from ..operators.intervals import count_overlaps

    counts = count_overlaps(a.elements(spark, d), a.units(spark, d).where("assay = 'atac'"), 256, by=("library",))
    return qt.matrix(counts.select(F.col("id").alias("feature"), "library", F.col("raw_count").alias("count")), ["lib0_F", "lib0_O", "lib2_F", "lib2_O"])


@query("eligibility_groups", f"""WITH {a.UNITS} SELECT assay, context, count(DISTINCT library) AS libraries, string_agg(DISTINCT library, ',' ORDER BY library) AS library_ids, count(DISTINCT library) >= 2 AS eligible FROM units WHERE strand = '+' GROUP BY 1, 2""")
def eligible(spark, d):
    x = a.units(spark, d).withColumn("role", F.when(F.col("strand") == "+", "treatment").otherwise("control"))
    return tb.eligibility(x, 2)


@query("digest_rows", "SELECT o_orderstatus AS state, sha256(string_agg(r, chr(10) ORDER BY r)) AS digest, count(*) AS rows FROM (SELECT o_orderstatus, sha256(CAST(o_orderkey AS VARCHAR) || chr(9) || CAST(o_custkey AS VARCHAR) || chr(9) || o_orderpriority) AS r FROM orders) GROUP BY 1")
def digests(spark, d):
    x = a.table(spark, d, "orders").withColumnRenamed("o_orderstatus", "state")
    return tb.digest_rows(x, ("state",), ("o_orderkey", "o_custkey", "o_orderpriority"))


@query("sig_round", "SELECT event_id, CAST(printf('%.9e', value / 7) AS DOUBLE) AS rounded FROM events")
def significant(spark, d):
    return a.table(spark, d, "events").select("event_id", sig10(F.col("value") / 7).alias("rounded"))


@query("threshold_filter", "SELECT l_orderkey, l_linenumber, l_tax AS posterior FROM lineitem WHERE l_tax >= 0.05 AND l_returnflag IN ('A', 'R') AND l_linestatus = 'F'")
def threshold(spark, d):
    return a.table(spark, d, "lineitem").where((F.col("l_tax") >= 0.05) & F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F")).select("l_orderkey", "l_linenumber", F.col("l_tax").alias("posterior"))


_DISTANCE = "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE (p_partkey * 7) % 2000 END"
_CLASS = "CASE WHEN {d} IS NULL THEN 'unclassified_no_tss_on_contig' WHEN {d} <= 500 THEN 'promoter_associated' WHEN {d} <= 1000 THEN 'proximal_enhancer_like' ELSE 'distal_enhancer_like' END"


@query("distance_class", f"SELECT p_partkey AS id, {_CLASS.format(d='d')} AS regulatory_class FROM (SELECT p_partkey, {_DISTANCE} AS d FROM part)")
def classes(spark, d):
    return a.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr(_DISTANCE).alias("d")).select("id", distance_class("d").alias("regulatory_class"))


@query("bed9_projection", f"""SELECT id, c AS regulatory_class, CAST(coalesce(round_even(1000 * p, 0), 0) AS INTEGER) AS score, CASE c {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASS_COLORS.items())} END AS rgb FROM (SELECT p_partkey AS id, {_CLASS.format(d='(' + _DISTANCE + ')')} AS c, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size / 64.0 END AS p FROM part)""")
def bed9(spark, d):
    x = a.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr(_DISTANCE).alias("d"), F.expr("case when p_size % 7 = 0 then null else p_size / 64D end").alias("p"))
    return x.withColumn("regulatory_class", distance_class("d")).select("id", "regulatory_class", bed9_score("p").alias("score"), bed9_color("regulatory_class").alias("rgb"))


@query("quantile_linear", "SELECT event_type, round(quantile_cont(value, 0.2), 9) AS q20, round(quantile_cont(value, 0.75), 9) AS q75, round(quantile_cont(value, 0.9975), 9) AS q9975 FROM events GROUP BY 1")
def quantiles(spark, d):
    return a.table(spark, d, "events").groupBy("event_type").agg(*[F.round(F.percentile("value", q), 9).alias(n) for n, q in (("q20", 0.2), ("q75", 0.75), ("q9975", 0.9975))])


@query("report_class_pivot", f"""SELECT l_linestatus AS context, {', '.join(f"count(*) FILTER (WHERE c = '{k}') AS {k}" for k in CLASS_COLORS)}, count(*) AS total FROM (SELECT l_linestatus, {_CLASS.format(d='((l_partkey * 7) % 2000)')} AS c FROM lineitem) GROUP BY 1""")
def class_pivot(spark, d):
    x = a.table(spark, d, "lineitem").select(F.col("l_linestatus").alias("context"), distance_class(F.expr("(l_partkey * 7) % 2000")).alias("regulatory_class"))
    return tb.class_pivot(x, list(CLASS_COLORS))


@query("compare_keys", "SELECT k, CASE WHEN x AND y THEN 'both' WHEN x THEN 'left' ELSE 'right' END AS \"where\" FROM (SELECT k, bool_or(t = 0) AS x, bool_or(t = 1) AS y FROM (SELECT o_custkey AS k, 0 AS t FROM orders UNION ALL SELECT c_custkey, 1 FROM customer WHERE c_nationkey < 20) GROUP BY 1)")
def compare(spark, d):
    return tb.compare_keys(a.table(spark, d, "orders").selectExpr("o_custkey as k"), a.table(spark, d, "customer").where("c_nationkey < 20").selectExpr("c_custkey as k"), "k")


@query("top_rows", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25")
def top(spark, d):
    return tb.top_rows(a.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"], 25)


@query("report_medians", "SELECT l_linestatus AS context, l_returnflag AS assay, count(*) AS n, quantile_cont(l_quantity, 0.5) AS median_l_quantity, round(quantile_cont(l_extendedprice, 0.5), 6) AS median_l_extendedprice FROM lineitem GROUP BY 1, 2")
def report_medians(spark, d):
    x = a.table(spark, d, "lineitem").withColumnsRenamed({"l_linestatus": "context", "l_returnflag": "assay"})
    return tb.medians(x, ("context", "assay"), ("l_quantity", "l_extendedprice")).withColumn("median_l_extendedprice", F.round("median_l_extendedprice", 6))


@query("report_active_classes", f"""WITH g AS (SELECT * FROM (VALUES ('F'), ('O'), ('P')) c(context), (VALUES {', '.join(f"('{k}')" for k in CLASS_COLORS)}) k(regulatory_class)), s AS (SELECT l_linestatus AS context, {_CLASS.format(d='((l_partkey * 7) % 2000)')} AS regulatory_class, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2)
SELECT context, regulatory_class, coalesce(n, 0) AS element_n FROM g LEFT JOIN s USING (context, regulatory_class)""")
def active_classes(spark, d):
    x = a.table(spark, d, "lineitem").select(F.col("l_linestatus").alias("context"), distance_class(F.expr("(l_partkey * 7) % 2000")).alias("regulatory_class"), F.when(F.col("l_returnflag") == "A", "high").otherwise("low").alias("mixture_component"))
    return tb.active_class_counts(x.groupBy("context", "regulatory_class", "mixture_component").agg(F.count("*").alias("element_n")), ["F", "O", "P"], list(CLASS_COLORS))


@query("report_warnings", """SELECT 'mixture' AS kind, n_name || ': reason ' || n_regionkey AS warning FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'rejected', s_name || ' rejected: ' || CASE WHEN s_nationkey % 2 = 0 THEN 'nation ' || s_nationkey ELSE 'no reason recorded' END FROM supplier WHERE s_acctbal < 0
UNION ALL SELECT 'metrics', 'no metrics for ' || c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def warnings(spark, d):
    return tb.report_warnings(
        a.table(spark, d, "nation").selectExpr("n_name as context", "n_nationkey % 3 <> 0 as mixture_supported", "concat('reason ', n_regionkey) as support_reason"),
        a.table(spark, d, "supplier").where("s_acctbal < 0").selectExpr("s_name as library", "case when s_nationkey % 2 = 0 then concat('nation ', s_nationkey) end as reason"),
        a.table(spark, d, "customer").selectExpr("cast(c_custkey as string) as library"), a.table(spark, d, "orders").selectExpr("cast(o_custkey as string) as library"),
    )


@query("qc_metrics", """WITH f AS (SELECT o_orderkey AS sample, 100 + o_orderkey AS total, 50 + o_orderkey AS mapped FROM orders WHERE o_orderkey % 5 <> 0), p AS (SELECT l_orderkey AS sample, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT o_orderkey AS sample, o_orderstatus AS assay, f.total AS total_alignments, f.mapped AS mapped_alignments, CASE WHEN o_orderkey % 3 = 0 THEN f.mapped END AS properly_paired, p.n AS peak_count FROM orders LEFT JOIN f ON f.sample = o_orderkey LEFT JOIN p ON p.sample = o_orderkey""")
def metrics(spark, d):
    from ..sources.logs import flagstat_log

    o = a.table(spark, d, "orders")
    paired = F.expr("case when o_orderkey % 3 = 0 then concat(50 + o_orderkey, ' + 0 properly paired (90% : N/A)\n') else '' end")
    text = F.concat(F.expr("concat(100 + o_orderkey, ' + 0 in total (QC-passed reads + QC-failed reads)\n', 50 + o_orderkey, ' + 0 mapped (99% : N/A)\n')"), paired)
    logs = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("sample"), text.alias("text"))
    none = o.where("false").selectExpr("o_orderkey as sample", "1L as frip_numerator", "1L as frip_denominator", "1D as frip")
    peaks = a.table(spark, d, "lineitem").where("l_returnflag = 'A'").selectExpr("l_orderkey as sample")
    out = tb.qc_metrics(o.selectExpr("o_orderkey as sample", "o_orderstatus as assay"), flagstat_log(logs), none, peaks)
    return out.drop("frip_numerator", "frip_denominator", "frip")


@query("qc_review_join", """WITH m AS (SELECT s_suppkey AS library, s_name AS name FROM supplier), x AS (SELECT l_suppkey AS library, count(*) AS reads FROM lineitem GROUP BY 1), h AS (SELECT l_suppkey AS library, CAST(sum(l_quantity) AS DOUBLE) AS fragments FROM lineitem GROUP BY 1 HAVING count(*) > 600), p AS (SELECT l_suppkey AS library, max(l_tax) AS tss FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 15300)
SELECT library, name, reads, fragments, tss FROM m JOIN x USING (library) LEFT JOIN h USING (library) LEFT JOIN p USING (library)""")
def review(spark, d):
    x = a.table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "library")
    return tb.qc_review(
        a.table(spark, d, "supplier").selectExpr("s_suppkey as library", "s_name as name"), x.groupBy("library").agg(F.count("*").alias("reads")),
        x.groupBy("library").agg(F.sum("l_quantity").alias("fragments"), F.count("*").alias("n")).where("n > 600").drop("n"), x.groupBy("library").agg(F.max("l_tax").alias("tss"), F.sum("l_quantity").alias("q")).where("q > 15300").drop("q"),
    )
