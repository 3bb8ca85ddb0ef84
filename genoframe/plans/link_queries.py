"""Queries from promoters and contacts to ranked genes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contacts as cn, links as lk
from . import adapters as a
from .book import query

_TRANSCRIPTS = "transcripts AS (SELECT l_orderkey * 8 + l_linenumber AS line, 'chr' || (l_suppkey % 3) AS chrom, l_suppkey * 800 + (l_partkey % 3) * 50 AS s, l_suppkey * 800 + (l_partkey % 3) * 50 + 400 AS e, CASE WHEN l_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 'gene' || (l_suppkey % 60) AS gene_id, 'n' || (l_suppkey % 60) AS gene_name, 't' || (l_partkey % 30) AS transcript_id FROM lineitem)"
_PROMS = f"""{_TRANSCRIPTS}, {a.SIZES}, st AS (SELECT t.chrom, z.rank, z.size, CASE strand WHEN '+' THEN s ELSE e - 1 END AS tss, gene_id, strand, string_agg(DISTINCT transcript_id, ';' ORDER BY transcript_id) AS transcript_ids, min(gene_name) AS gene_name FROM transcripts t JOIN sizes z USING (chrom) GROUP BY 1, 2, 3, 4, 5, 6),
proms AS (SELECT 'PROM' || lpad(CAST(row_number() OVER (ORDER BY rank, tss, gene_id, strand) AS VARCHAR), 8, '0') AS promoter_id, gene_id, gene_name, chrom, tss, strand, greatest(tss - 500, 0) AS s, least(tss + 500, size) AS e, transcript_ids FROM st WHERE tss < size)"""


def promoters(spark, d):
    t = a.table(spark, d, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as line", "concat('chr', l_suppkey % 3) as chrom", "l_suppkey * 800 + (l_partkey % 3) * 50 as start", "l_suppkey * 800 + (l_partkey % 3) * 50 + 400 as `end`",
        "case when l_suppkey % 2 = 0 then '+' else '-' end as strand", "concat('gene', l_suppkey % 60) as gene_id", "concat('n', l_suppkey % 60) as gene_name", "concat('t', l_partkey % 30) as transcript_id",
    )
    return lk.promoters(t, a.sizes(spark))


@query("promoter_collapse", f"WITH {_PROMS} SELECT * FROM proms")
def collapse(spark, d):
    return promoters(spark, d).withColumnsRenamed({"start": "s", "end": "e"})


_SCORED = f"""{a.ELEMENTS}, sc AS (SELECT id, chrom, summit, (id * 37 % 1000) / 10.0 AS atac, CASE WHEN id % 9 = 0 THEN NULL ELSE (id * 53 % 1000) / 1000.0 END AS posterior, (id * 71 % 500) / 4.0 AS combined FROM elements),
pa AS (SELECT p.promoter_id, max(x.atac) AS atac, max(x.posterior) AS posterior, max(x.combined) AS combined, max(x.combined * coalesce(x.posterior, 0)) AS score, string_agg(CAST(x.id AS VARCHAR), ';' ORDER BY x.summit, x.id) AS support_ids FROM sc x JOIN proms p ON x.chrom = p.chrom AND abs(x.summit - p.tss) <= 500 GROUP BY 1),
pact AS (SELECT p.*, pa.atac, pa.posterior, pa.combined, coalesce(pa.score, 0) AS score, coalesce(pa.posterior >= 0.5, false) AS active, coalesce(pa.support_ids, '') AS support_ids FROM proms p LEFT JOIN pa USING (promoter_id))"""


def scored(spark, d):
    e = a.elements(spark, d)
    return e.select("id", "chrom", "summit", F.expr("(id * 37 % 1000) / 10D as atac"), F.expr("case when id % 9 = 0 then null else (id * 53 % 1000) / 1000D end as posterior"), F.expr("(id * 71 % 500) / 4D as combined"))


def active_promoters(spark, d):
    return lk.promoter_activity(promoters(spark, d), scored(spark, d), 0.5)


@query("promoter_activity", f"WITH {_PROMS}, {_SCORED} SELECT promoter_id, atac, posterior, combined, round(score, 9) AS score, active, support_ids FROM pact")
def activity(spark, d):
    return active_promoters(spark, d).select("promoter_id", "atac", "posterior", "combined", F.round("score", 9).alias("score"), "active", "support_ids")


_EDGES = f"""{_PROMS}, {_SCORED}, edges AS (SELECT x.id, p.promoter_id, p.gene_id, abs(x.summit - p.tss) AS distance, 1000 * pow(CAST(greatest(abs(x.summit - p.tss), 100) AS DOUBLE), -0.9) AS weight, p.active, p.score AS ps FROM sc x JOIN pact p ON x.chrom = p.chrom AND abs(x.summit - p.tss) <= 20000),
es AS (SELECT id, promoter_id, gene_id, distance, active, CAST(printf('%.9e', weight) AS DOUBLE) AS w, CAST(printf('%.9e', weight * ps) AS DOUBLE) AS s FROM edges),
gb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, gene_id ORDER BY s DESC, w DESC, distance, promoter_id DESC) AS k FROM es) WHERE k = 1), ga AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, gene_id ORDER BY s DESC, w DESC, distance, promoter_id DESC) AS k FROM es WHERE active) WHERE k = 1),
gc AS (SELECT id, gene_id, count(*) AS promoter_count, count(*) FILTER (WHERE active) AS active_promoter_count, min(distance) AS minimum_distance, max(w) AS contact_value FROM es GROUP BY 1, 2),
genes AS (SELECT gc.*, gb.promoter_id AS best_promoter_id, gb.s AS score, ga.promoter_id AS best_active_promoter_id, ga.s AS active_score FROM gc JOIN gb USING (id, gene_id) LEFT JOIN ga USING (id, gene_id))"""


def edges(spark, d):
    return lk.distance_edges(scored(spark, d), active_promoters(spark, d), 20000, -0.9, 1000.0, 100)


@query("gene_collapse", f"WITH {_EDGES} SELECT id, gene_id, promoter_count, active_promoter_count, minimum_distance, round(contact_value, 6) AS contact_value, best_promoter_id, round(score, 3) AS score, best_active_promoter_id, round(active_score, 3) AS active_score FROM genes")
def genes(spark, d):
    out = lk.collapse_genes(edges(spark, d))
    return out.select("id", "gene_id", "promoter_count", "active_promoter_count", "minimum_distance", F.round("contact_value", 6).alias("contact_value"), "best_promoter_id", F.round("score", 3).alias("score"), "best_active_promoter_id", F.round("active_score", 3).alias("active_score"))


_RANKS = f"""{_EDGES}, ranked AS (SELECT id, gene_id, row_number() OVER (PARTITION BY id ORDER BY score DESC, minimum_distance, gene_id) AS candidate_rank, row_number() OVER (PARTITION BY id ORDER BY contact_value DESC, minimum_distance, gene_id) AS contact_rank, row_number() OVER (PARTITION BY id ORDER BY minimum_distance, gene_id) AS nearest_rank,
CASE WHEN active_score IS NOT NULL THEN row_number() OVER (PARTITION BY id, active_score IS NULL ORDER BY active_score DESC, minimum_distance, gene_id) END AS active_rank FROM genes)"""


@query("gene_ranks", f"WITH {_RANKS} SELECT *, candidate_rank = 1 AS is_primary FROM ranked")
def ranks(spark, d):
    out = lk.rank_genes(lk.collapse_genes(edges(spark, d)))
    return out.select("id", "gene_id", *[F.col(c).cast("long").alias(c) for c in ("candidate_rank", "contact_rank", "nearest_rank", "active_rank")], "is_primary")


@query("link_rollup", f"""WITH {_RANKS}, x AS (SELECT CASE WHEN id % 8 = 0 THEN 'c1' ELSE 'c2' END AS context, * FROM ranked)
SELECT context, count(*) AS links, count(DISTINCT id) AS elements, count(DISTINCT gene_id) AS genes, count(*) FILTER (WHERE candidate_rank = 1) AS primary_links FROM x GROUP BY 1 UNION ALL SELECT 'all', count(*), count(DISTINCT id), count(DISTINCT gene_id), count(*) FILTER (WHERE candidate_rank = 1) FROM x""")
def rollup(spark, d):
    out = lk.rank_genes(lk.collapse_genes(edges(spark, d))).withColumn("context", F.when(F.col("id") % 8 == 0, "c1").otherwise("c2"))
    return lk.link_rollup(out)


@query("nearest_summary", f"""WITH {_PROMS}, {_SCORED}, m AS (SELECT x.id, min(abs(x.summit - p.tss)) AS distance FROM sc x JOIN pact p ON x.chrom = p.chrom AND p.active GROUP BY 1)
SELECT DISTINCT m.id, m.distance, p.gene_id FROM m JOIN sc x USING (id) JOIN pact p ON p.chrom = x.chrom AND p.active AND abs(x.summit - p.tss) = m.distance""")
def nearest_active(spark, d):
    return lk.nearest_active(scored(spark, d), active_promoters(spark, d))


#: Members of two contexts, one with a contact matrix and one with a distance model.
_REACH, _RESOLUTION, _THRESHOLD, _RATIO, _PSEUDO = 20000, 5000, 0.5, 1.0, 0.5
_GRAPH = f"""{_PROMS}, {a.ELEMENTS}, cat AS (SELECT c.context, id, chrom, s, e, summit, CASE id % 5 WHEN 0 THEN 'promoter_associated' WHEN 1 THEN 'proximal_enhancer_like' ELSE 'distal_enhancer_like' END AS cls, (id + c.k) % 4 <> 0 AS member, (id * 37 % 1000) / 10.0 + c.k AS atac,
CASE WHEN id % 9 = c.k THEN NULL ELSE ((id + c.k) * 53 % 1000) / 1000.0 END AS posterior, (id * 71 % 500) / 4.0 + c.k AS combined, CASE WHEN id % 31 = 0 THEN 1 ELSE 0 END AS bl FROM elements, (VALUES ('c1', 0), ('c2', 1)) c(context, k)),
el AS (SELECT * FROM cat WHERE member), mo(context, strategy, gamma, scale) AS (VALUES ('c1', 'observed', -0.9, 1000.0), ('c2', 'powerlaw', -0.75, 500.0)),
mx AS (SELECT 'c1' AS context, 'chr' || c AS chrom, b AS b1, b + d AS b2, CASE WHEN b % 13 = 5 OR (b + d) % 13 = 5 THEN 'NaN'::DOUBLE ELSE ((b * 7 + d * 3 + c) % 11) / 40.0 END AS v FROM (SELECT unnest(range(0, 180)) AS b), (SELECT unnest(range(0, 4)) AS d), (VALUES (0), (1)) t(c)),
sup AS (SELECT e.context, p.promoter_id, string_agg(CAST(e.id AS VARCHAR), ';' ORDER BY e.summit, e.id) AS ids, max(e.atac) AS atac, max(e.posterior) AS posterior, max(e.combined) AS combined, max(e.combined * coalesce(e.posterior, 0)) AS score FROM el e JOIN proms p ON p.chrom = e.chrom AND abs(e.summit - p.tss) <= 500 GROUP BY 1, 2),
st8 AS (SELECT mo.context, p.*, coalesce(sup.ids, '') AS ids, sup.atac, sup.posterior, sup.combined, coalesce(sup.score, 0) AS score, coalesce(sup.posterior >= {_THRESHOLD}, false) AS active FROM proms p CROSS JOIN mo LEFT JOIN sup ON sup.context = mo.context AND sup.promoter_id = p.promoter_id)"""
_GEDGES = f"""{_GRAPH}, pr AS (SELECT e.context, e.id, e.chrom, e.summit, p.promoter_id, p.gene_id, p.gene_name, p.active, p.score, p.ids, p.atac, p.posterior, abs(e.summit - p.tss) AS distance, mo.strategy, mo.scale * pow(CAST(greatest(abs(e.summit - p.tss), {_RESOLUTION}) AS DOUBLE), mo.gamma) AS expected,
least(e.summit, p.tss) // {_RESOLUTION} AS b1, greatest(e.summit, p.tss) // {_RESOLUTION} AS b2 FROM el e JOIN st8 p ON p.context = e.context AND p.chrom = e.chrom AND abs(e.summit - p.tss) <= {_REACH} JOIN mo ON mo.context = e.context),
ev AS (SELECT pr.*, CASE WHEN pr.chrom = 'chr2' THEN NULL ELSE 180 END AS bins, coalesce(d.v, 0) AS direct, CASE WHEN pr.b1 = pr.b2 AND pr.b1 > 0 THEN coalesce(l.v, 0) END AS vl, CASE WHEN pr.b1 = pr.b2 AND pr.b1 + 1 < 180 THEN coalesce(r.v, 0) END AS vr FROM pr LEFT JOIN mx d ON d.context = pr.context AND d.chrom = pr.chrom AND d.b1 = pr.b1 AND d.b2 = pr.b2
LEFT JOIN mx l ON l.context = pr.context AND l.chrom = pr.chrom AND pr.b1 = pr.b2 AND l.b1 = pr.b1 - 1 AND l.b2 = pr.b1 LEFT JOIN mx r ON r.context = pr.context AND r.chrom = pr.chrom AND pr.b1 = pr.b2 AND r.b1 = pr.b1 AND r.b2 = pr.b1 + 1),
es AS (SELECT *, greatest(CASE WHEN isnan(vl) THEN NULL ELSE vl END, CASE WHEN isnan(vr) THEN NULL ELSE vr END) AS near FROM ev),
eu AS (SELECT *, CASE WHEN strategy = 'powerlaw' THEN 'distance_model' WHEN bins IS NULL THEN 'chromosome_absent_from_matrix' WHEN b2 >= bins THEN 'position_outside_matrix' WHEN b1 = b2 AND near IS NULL THEN 'unbalanced_or_masked_adjacent_bins' WHEN b1 = b2 THEN 'adjacent_bin_proxy' WHEN isnan(direct) THEN 'unbalanced_or_masked_bin' ELSE 'observed_matrix_pixel' END AS status FROM es),
eo AS (SELECT *, CASE status WHEN 'adjacent_bin_proxy' THEN near WHEN 'observed_matrix_pixel' THEN direct END AS observed FROM eu),
ew AS (SELECT *, CASE WHEN strategy = 'powerlaw' THEN expected ELSE coalesce(observed, 0) + {_PSEUDO} * expected END AS weight FROM eo),
ge AS (SELECT context, id, promoter_id, gene_id, gene_name, distance, active, strategy, status, (b1 = b2) AS same_bin, ids <> '' AS accessible, coalesce(atac, 0) AS atac, posterior, {{n}}(score) AS pscore, {{n}}(observed) AS observed, {{n}}(expected) AS expected, {{n}}(weight) AS w, {{n}}(observed / expected) AS oe, {{n}}(weight * score) AS s FROM ew)""".replace(
    "{n}(score)", "CAST(printf('%.9e', CAST(score AS DOUBLE)) AS DOUBLE)"
).replace("{n}(observed)", "CASE WHEN observed IS NOT NULL THEN CAST(printf('%.9e', CAST(observed AS DOUBLE)) AS DOUBLE) END").replace("{n}(expected)", "CAST(printf('%.9e', expected) AS DOUBLE)").replace("{n}(weight)", "CAST(printf('%.9e', CAST(weight AS DOUBLE)) AS DOUBLE)").replace(
    "{n}(observed / expected)", "CASE WHEN observed IS NOT NULL THEN CAST(printf('%.9e', CAST(observed / expected AS DOUBLE)) AS DOUBLE) END"
).replace("{n}(weight * score)", "CAST(printf('%.9e', CAST(weight * score AS DOUBLE)) AS DOUBLE)")


def _gene_sql(name: str, edges: str) -> str:
    """Ranked genes of an edge relation, as common table expressions that end in ``name``."""
    return f"""{name}_b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY context, id, gene_id ORDER BY s DESC, w DESC, distance, promoter_id DESC) AS k FROM {edges}) WHERE k = 1),
{name}_l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY context, id, gene_id ORDER BY s DESC, w DESC, distance, promoter_id DESC) AS k FROM {edges} WHERE active) WHERE k = 1),
{name}_c AS (SELECT context, id, gene_id, count(*) AS promoter_count, count(*) FILTER (WHERE active) AS active_promoter_count, min(distance) AS minimum_distance_bp, max(w) AS top FROM {edges} GROUP BY 1, 2, 3),
{name} AS (SELECT c.context, CAST(c.id AS VARCHAR) AS master_dhs_id, c.gene_id, b.gene_name, c.promoter_count, c.active_promoter_count, b.promoter_id AS best_promoter_id, l.promoter_id AS best_active_promoter_id, c.minimum_distance_bp, CAST(b.active AS INTEGER) AS best_promoter_active, b.strategy AS contact_strategy, b.status AS best_contact_status,
round(b.observed, 6) AS best_observed_balanced_contact, round(b.w, 6) AS best_contact_weight, round(b.oe, 6) AS best_observed_over_expected, round(b.s + 1e-9, 4) AS candidate_link_score, CAST(row_number() OVER (PARTITION BY c.context, c.id ORDER BY b.s DESC, c.minimum_distance_bp, c.gene_id) AS INTEGER) AS candidate_gene_rank,
CAST(CASE WHEN l.s IS NOT NULL THEN row_number() OVER (PARTITION BY c.context, c.id ORDER BY l.s DESC NULLS LAST, c.minimum_distance_bp, c.gene_id) END AS INTEGER) AS active_candidate_gene_rank, CAST(row_number() OVER (PARTITION BY c.context, c.id ORDER BY c.top DESC, c.minimum_distance_bp, c.gene_id) AS INTEGER) AS contact_gene_rank,
CAST(row_number() OVER (PARTITION BY c.context, c.id ORDER BY c.minimum_distance_bp, c.gene_id) AS INTEGER) AS nearest_gene_rank FROM {name}_c c JOIN {name}_b b USING (context, id, gene_id) LEFT JOIN {name}_l l USING (context, id, gene_id))"""


_GENE_COLUMNS = (
    "context", "master_dhs_id", "gene_id", "gene_name", "promoter_count", "active_promoter_count", "best_promoter_id", "best_active_promoter_id", "minimum_distance_bp", "best_promoter_active", "contact_strategy", "best_contact_status", "best_observed_balanced_contact",
    "best_contact_weight", "best_observed_over_expected", "candidate_link_score", "candidate_gene_rank", "active_candidate_gene_rank", "contact_gene_rank", "nearest_gene_rank",
)
_FOCUS = f"fe AS (SELECT * FROM el WHERE cls <> 'promoter_associated' AND posterior >= {_THRESHOLD})"
_CONTACT = f"{_FOCUS}, ce AS (SELECT ge.* FROM ge SEMI JOIN fe ON fe.context = ge.context AND fe.id = ge.id WHERE oe >= {_RATIO}), {_gene_sql('cg', 'ce')}"
_DISTANCE = f"""{_FOCUS}, de AS (SELECT ge.* FROM ge SEMI JOIN fe ON fe.context = ge.context AND fe.id = ge.id WHERE strategy = 'powerlaw'), da AS (SELECT * FROM de WHERE active), {_gene_sql('dg', 'da')},
na AS (SELECT context, id, distance, string_agg(DISTINCT gene_id, ';' ORDER BY gene_id) AS g FROM da WHERE (context, id, distance) IN (SELECT context, id, min(distance) FROM da GROUP BY 1, 2) GROUP BY 1, 2, 3), nt AS (SELECT context, id, distance, string_agg(DISTINCT gene_id, ';' ORDER BY gene_id) AS g FROM de WHERE (context, id, distance) IN (SELECT context, id, min(distance) FROM de GROUP BY 1, 2) GROUP BY 1, 2, 3)"""
_NEAREST = f"""{_FOCUS}, nm AS (SELECT f.context, f.id, min(abs(f.summit - p.tss)) AS distance FROM fe f JOIN st8 p ON p.context = f.context AND p.chrom = f.chrom AND p.active GROUP BY 1, 2),
ns AS (SELECT s.context, s.promoter_id, string_agg(CAST(e.id AS VARCHAR), ';' ORDER BY CAST(e.id AS VARCHAR)) AS ids, count(*) AS n, count(*) FILTER (WHERE e.cls = 'promoter_associated') AS own FROM (SELECT context, promoter_id, unnest(string_split(ids, ';')) AS i FROM st8 WHERE active) s JOIN el e ON e.context = s.context AND CAST(e.id AS VARCHAR) = s.i AND e.posterior >= {_THRESHOLD} GROUP BY 1, 2),
ng AS (SELECT m.context, CAST(m.id AS VARCHAR) AS master_dhs_id, p.promoter_id, ns.ids AS active_promoter_supporting_element_ids, ns.n AS active_promoter_supporting_element_count, ns.own AS active_promoter_associated_element_count, p.gene_id, p.tss AS promoter_tss, m.distance AS distance_bp, count(*) OVER (PARTITION BY m.context, m.id) AS nearest_active_tss_tie_count
FROM nm m JOIN fe f ON f.context = m.context AND f.id = m.id JOIN st8 p ON p.context = m.context AND p.chrom = f.chrom AND p.active AND abs(f.summit - p.tss) = m.distance JOIN ns ON ns.context = p.context AND ns.promoter_id = p.promoter_id)"""


def members(spark, d):
    """The long catalog of both contexts; members stand in it with member true."""
    x = a.elements(spark, d).select("id", "chrom", "start", "end", "summit", F.explode(F.array(F.struct(F.lit("c1").alias("context"), F.lit(0).alias("k")), F.struct(F.lit("c2").alias("context"), F.lit(1).alias("k")))).alias("c")).select("*", "c.*").drop("c")
    return x.select(
        "context", "id", "chrom", "start", "end", "summit", F.expr("case id % 5 when 0 then 'promoter_associated' when 1 then 'proximal_enhancer_like' else 'distal_enhancer_like' end as regulatory_class"), F.expr("(id + k) % 4 <> 0 as member"),
        F.expr("(id * 37 % 1000) / 10D + k as atac"), F.expr("case when id % 9 = k then null else ((id + k) * 53 % 1000) / 1000D end as posterior"), F.expr("(id * 71 % 500) / 4D + k as combined"), F.expr("case when id % 31 = 0 then 1 else 0 end as blacklist_overlap"),
        F.expr("case when (id + k) % 4 = 0 then 'inactive_in_context' else 'mixture_unavailable' end as state"),
    )


def _models(spark):
    rows = [("c1", "observed", "hic", "exact", _RESOLUTION, -0.9, 1000.0), ("c2", "powerlaw", "", "", _RESOLUTION, -0.75, 500.0)]
    return spark.createDataFrame(rows, "context string, strategy string, assay string, match string, resolution int, gamma double, scale double")


def graph(spark, d, once=False):
    m = spark.range(180).selectExpr("'c1' as context", "id as bin1", "explode(array(0L, 1L, 2L, 3L)) as d").selectExpr("context", "bin1", "bin1 + d as bin2", "d", "explode(array(0L, 1L)) as c")
    m = m.selectExpr("context", "concat('chr', c) as chrom", "bin1", "bin2", "case when bin1 % 13 = 5 or bin2 % 13 = 5 then double('NaN') else ((bin1 * 7 + d * 3 + c) % 11) / 40D end as value")
    shape = spark.createDataFrame([("c1", "chr0", 180), ("c1", "chr1", 180)], "context string, chrom string, bins long")
    return lk.context_graph(members(spark, d).where("member"), promoters(spark, d), _models(spark), m, shape, _REACH, _PSEUDO, _THRESHOLD, once)


def _round(c: str, digits: int):
    """Rounded; scores, which may end in a five, a little above it."""
    return F.round(F.col(c) + 1e-9 if c == "candidate_link_score" else F.col(c), digits)


def _rounded(genes, extra=()):
    digits = {"best_observed_balanced_contact": 6, "best_contact_weight": 6, "best_observed_over_expected": 6, "candidate_link_score": 4}
    shown = {c: _round(c, n).alias(c) for c, n in digits.items()}
    return genes.select(*[shown.get(c, F.col(c)) for c in (*_GENE_COLUMNS, *extra)])


@query("context_nodes", f"""WITH {_GRAPH} SELECT context, 'element:' || id AS node_id, 'element' AS node_type, CAST(id AS VARCHAR) AS master_dhs_id, '' AS promoter_id, '' AS gene_id, '' AS gene_name, chrom, s, e, summit AS anchor, cls AS regulatory_class, 1 AS atac_accessible, round(CAST(atac AS DOUBLE), 6) AS atac_signal, round(CAST(posterior AS DOUBLE), 6) AS h3k27ac_posterior,
round(CAST(combined AS DOUBLE), 6) AS combined_activity, CAST(coalesce(posterior >= {_THRESHOLD}, false) AS INTEGER) AS active, bl AS blacklist_overlap FROM el UNION ALL SELECT context, 'promoter:' || promoter_id, 'promoter', ids, promoter_id, gene_id, gene_name, chrom, s, e, tss, 'promoter', CAST(ids <> '' AS INTEGER), round(CAST(coalesce(atac, 0) AS DOUBLE), 6),
round(CAST(posterior AS DOUBLE), 6), round(CAST(coalesce(combined, 0) AS DOUBLE), 6), CAST(active AS INTEGER), NULL FROM st8""")
def nodes(spark, d):
    x = graph(spark, d).nodes
    return x.withColumns({c: F.round(c, 6) for c in ("atac_signal", "h3k27ac_posterior", "combined_activity")}).withColumnsRenamed({"start": "s", "end": "e"})


@query("context_edges", f"""WITH {_GEDGES} SELECT context, 'element:' || id AS source_node_id, 'promoter:' || promoter_id AS target_node_id, CAST(id AS VARCHAR) AS master_dhs_id, promoter_id, gene_id, gene_name, distance AS distance_bp, CAST(active AS INTEGER) AS promoter_active, round(pscore, 6) AS promoter_activity_score, CAST(accessible AS INTEGER) AS promoter_atac_accessible,
round(CAST(atac AS DOUBLE), 6) AS promoter_atac_signal, round(CAST(posterior AS DOUBLE), 6) AS promoter_h3k27ac_posterior, strategy AS contact_strategy, CASE strategy WHEN 'observed' THEN 'hic' ELSE '' END AS contact_assay, CASE strategy WHEN 'observed' THEN 'exact' ELSE '' END AS contact_match, {_RESOLUTION} AS contact_resolution_bp, status AS contact_status,
CAST(same_bin AS INTEGER) AS same_contact_bin, round(observed, 6) AS observed_balanced_contact, round(expected, 6) AS powerlaw_expected_contact, round(w, 6) AS contact_weight, round(oe, 6) AS observed_over_expected, round(s + 1e-9, 4) AS candidate_link_score FROM ge""")
def context_edges(spark, d):
    digits = dict.fromkeys(("promoter_activity_score", "promoter_atac_signal", "promoter_h3k27ac_posterior", "observed_balanced_contact", "powerlaw_expected_contact", "contact_weight", "observed_over_expected"), 6) | {"candidate_link_score": 4}
    return graph(spark, d).edges.withColumns({c: _round(c, n) for c, n in digits.items()})


@query("context_genes", f"""WITH {_GEDGES}, {_gene_sql('gg', 'ge')} SELECT gg.*, e.chrom AS element_chrom, e.s AS element_start, e.e AS element_end, e.summit AS element_summit, e.cls AS regulatory_class, round(CAST(e.posterior AS DOUBLE), 6) AS element_h3k27ac_posterior, round(CAST(e.combined AS DOUBLE), 6) AS element_combined_activity, e.bl AS element_blacklist_overlap,
round(CAST(p.atac AS DOUBLE), 6) AS best_promoter_atac_signal, round(CAST(p.posterior AS DOUBLE), 6) AS best_promoter_h3k27ac_posterior, CASE contact_strategy WHEN 'observed' THEN 'hic' ELSE '' END AS contact_assay, CASE contact_strategy WHEN 'observed' THEN 'exact' ELSE '' END AS contact_match, {_RESOLUTION} AS contact_resolution_bp,
round(p.expected, 6) AS best_powerlaw_expected_contact FROM gg JOIN el e ON e.context = gg.context AND CAST(e.id AS VARCHAR) = gg.master_dhs_id JOIN ge p ON p.context = gg.context AND CAST(p.id AS VARCHAR) = gg.master_dhs_id AND p.promoter_id = gg.best_promoter_id""")
def context_genes(spark, d):
    digits = {"best_observed_balanced_contact": 6, "best_contact_weight": 6, "best_observed_over_expected": 6, "candidate_link_score": 4, **dict.fromkeys(("element_h3k27ac_posterior", "element_combined_activity", "best_promoter_atac_signal", "best_promoter_h3k27ac_posterior", "best_powerlaw_expected_contact"), 6)}
    return graph(spark, d).genes.withColumns({c: _round(c, n) for c, n in digits.items()})


@query("active_contact_genes", f"WITH {_GEDGES}, {_CONTACT} SELECT * FROM cg")
def active_contact(spark, d):
    return _rounded(lk.active_contact_genes(graph(spark, d).edges, members(spark, d).where("member"), _THRESHOLD, _RATIO))


@query("active_distance_genes", f"""WITH {_GEDGES}, {_DISTANCE} SELECT dg.*, CAST(candidate_gene_rank = 1 AS INTEGER) AS is_primary_candidate, na.g AS nearest_active_tss_gene_ids, na.distance AS nearest_active_tss_distance_bp, nt.g AS nearest_tss_gene_ids, nt.distance AS nearest_tss_distance_bp
FROM dg JOIN na ON na.context = dg.context AND CAST(na.id AS VARCHAR) = dg.master_dhs_id JOIN nt ON nt.context = dg.context AND CAST(nt.id AS VARCHAR) = dg.master_dhs_id""")
def active_distance(spark, d):
    extra = ("is_primary_candidate", "nearest_active_tss_gene_ids", "nearest_active_tss_distance_bp", "nearest_tss_gene_ids", "nearest_tss_distance_bp")
    return _rounded(lk.active_distance_genes(graph(spark, d).edges, members(spark, d).where("member"), _THRESHOLD), extra)


def _states(spark, d):
    return lk.promoter_activity(promoters(spark, d), members(spark, d).where("member"), _THRESHOLD, by=("context",))


def _nearest_rows(spark, d, states=None):
    return lk.nearest_active_genes(members(spark, d).where("member"), states or _states(spark, d), _THRESHOLD)


@query("nearest_active_genes", f"WITH {_GRAPH}, {_NEAREST} SELECT * FROM ng")
def nearest_active_rows(spark, d):
    columns = ("context", "master_dhs_id", "promoter_id", "active_promoter_supporting_element_ids", "active_promoter_supporting_element_count", "active_promoter_associated_element_count", "gene_id", "promoter_tss", "distance_bp", "nearest_active_tss_tie_count")
    return _nearest_rows(spark, d).select(*columns)


@query("graph_metrics", f"""WITH {_GEDGES}, {_gene_sql('gg', 'ge')}, {_CONTACT}, {_DISTANCE.removeprefix(_FOCUS + ', ')}, {_NEAREST.removeprefix(_FOCUS + ', ')}, r AS (SELECT context, strategy AS contact_strategy, {_RESOLUTION} AS contact_resolution_bp, (SELECT count(*) FROM el x WHERE x.context = mo.context) AS element_node_count,
(SELECT count(*) FROM st8 x WHERE x.context = mo.context) AS promoter_node_count, (SELECT count(*) FROM st8 x WHERE x.context = mo.context AND active) AS active_promoter_count, (SELECT count(*) FROM ge x WHERE x.context = mo.context) AS element_promoter_edge_count, (SELECT count(*) FROM ge x WHERE x.context = mo.context AND observed IS NOT NULL) AS observed_edge_count,
(SELECT count(*) FROM gg x WHERE x.context = mo.context) AS element_gene_candidate_count, (SELECT count(*) FROM cg x WHERE x.context = mo.context) AS active_contact_enhancer_gene_candidate_count, (SELECT count(*) FROM ng x WHERE x.context = mo.context) AS nearest_active_promoter_gene_candidate_count,
(SELECT count(*) FROM dg x WHERE x.context = mo.context) AS active_distance_enhancer_gene_candidate_count FROM mo)
SELECT * FROM r UNION ALL SELECT 'all', NULL, NULL, CAST(sum(COLUMNS('.*_count')) AS BIGINT) FROM r""")
def metrics(spark, d):
    g, m = graph(spark, d, once=True), members(spark, d).where("member")
    return lk.graph_metrics(g, _models(spark), lk.active_contact_genes(g.edges, m, _THRESHOLD, _RATIO), _nearest_rows(spark, d, g.states), lk.active_distance_genes(g.edges, m, _THRESHOLD))


_WIDE_CONTEXT = """max(CASE WHEN k.context = '{c}' THEN CAST(k.member AS INTEGER) END) AS {c}__element_context_membership, round(max(CASE WHEN k.context = '{c}' THEN CAST(k.atac AS DOUBLE) END), 6) AS {c}__element_atac_signal, round(max(CASE WHEN k.context = '{c}' THEN CAST(k.posterior AS DOUBLE) END), 6) AS {c}__element_h3k27ac_posterior,
max(CASE WHEN k.context = '{c}' THEN CASE WHEN k.member THEN 'mixture_unavailable' ELSE 'inactive_in_context' END END) AS {c}__element_activity_state, round(max(CASE WHEN k.context = '{c}' THEN CAST(k.combined AS DOUBLE) END), 6) AS {c}__element_combined_activity, coalesce(max(CASE WHEN t.context = '{c}' AND t.active THEN 1 END), 0) AS {c}__nearest_promoter_active,
coalesce(string_agg(DISTINCT CASE WHEN t.context = '{c}' AND t.active THEN t.promoter_id END, ';' ORDER BY CASE WHEN t.context = '{c}' AND t.active THEN t.promoter_id END), '') AS {c}__active_nearest_promoter_ids, coalesce(max(CASE WHEN u.context = '{c}' THEN u.ids END), '') AS {c}__active_nearest_promoter_supporting_element_ids,
round(max(CASE WHEN t.context = '{c}' THEN CAST(t.score AS DOUBLE) END), 6) AS {c}__nearest_promoter_activity_score_max, round(max(CASE WHEN t.context = '{c}' THEN CAST(coalesce(t.atac, 0) AS DOUBLE) END), 6) AS {c}__nearest_promoter_atac_signal_max, round(max(CASE WHEN t.context = '{c}' THEN CAST(t.posterior AS DOUBLE) END), 6) AS {c}__nearest_promoter_h3k27ac_posterior_max,
round(max(CASE WHEN t.context = '{c}' THEN CAST(coalesce(t.combined, 0) AS DOUBLE) END), 6) AS {c}__nearest_promoter_combined_activity_max"""


@query("nearest_tss_wide", f"""WITH {_GRAPH}, en AS (SELECT DISTINCT id, chrom, s, e, summit, cls FROM cat WHERE cls <> 'promoter_associated'), nd AS (SELECT n.id, min(abs(n.summit - p.tss)) AS distance FROM en n JOIN proms p USING (chrom) GROUP BY 1),
tp AS (SELECT n.id, d.distance, p.* FROM en n JOIN nd d USING (id) JOIN proms p ON p.chrom = n.chrom AND abs(n.summit - p.tss) = d.distance), tb AS (SELECT id, any_value(distance) AS distance, count(*) AS ties, string_agg(promoter_id, ';' ORDER BY tss, promoter_id) AS proms, string_agg(gene_id, ';' ORDER BY tss, promoter_id) AS genes, string_agg(gene_name, ';' ORDER BY tss, promoter_id) AS names,
string_agg(CAST(tss AS VARCHAR), ';' ORDER BY tss, promoter_id) AS tsss, string_agg(strand, ';' ORDER BY tss, promoter_id) AS strands, string_agg(transcript_ids, '|' ORDER BY tss, promoter_id) AS tx FROM tp GROUP BY 1),
t AS (SELECT tp.id, x.* FROM tp JOIN st8 x ON x.promoter_id = tp.promoter_id), u AS (SELECT id, context, string_agg(DISTINCT i, ';' ORDER BY i) AS ids FROM (SELECT id, context, unnest(string_split(ids, ';')) AS i FROM t WHERE active) WHERE i <> '' GROUP BY 1, 2),
w AS (SELECT n.id, {', '.join(_WIDE_CONTEXT.format(c=c) for c in ('c1', 'c2'))} FROM en n JOIN cat k ON k.id = n.id LEFT JOIN t ON t.id = n.id LEFT JOIN u ON u.id = n.id GROUP BY n.id)
SELECT n.id AS master_dhs_id, n.chrom AS element_chrom, n.s AS element_start, n.e AS element_end, n.summit AS element_summit, n.cls AS regulatory_class, tb.distance AS nearest_tss_distance_bp, CAST(coalesce(tb.ties, 0) AS INTEGER) AS nearest_tss_tie_count, coalesce(proms, '') AS nearest_promoter_ids, coalesce(genes, '') AS nearest_gene_ids, coalesce(names, '') AS nearest_gene_names,
coalesce(tsss, '') AS nearest_tss_positions, coalesce(strands, '') AS nearest_tss_strands, coalesce(tx, '') AS nearest_promoter_transcript_ids, 'nearest_annotated_tss' AS evidence_type, array_to_string(list_filter([CASE WHEN c1__nearest_promoter_active = 1 THEN 'c1' END, CASE WHEN c2__nearest_promoter_active = 1 THEN 'c2' END], lambda x: x IS NOT NULL), ';') AS nearest_promoter_active_contexts,
c1__nearest_promoter_active + c2__nearest_promoter_active AS nearest_promoter_active_context_count, w.* EXCLUDE (id) FROM en n LEFT JOIN tb USING (id) JOIN w USING (id)""")
def nearest_wide(spark, d):
    out = lk.nearest_wide(members(spark, d), promoters(spark, d), _states(spark, d), ["c1", "c2"])
    doubles = [f.name for f in out.schema.fields if f.dataType.typeName() == "double"]
    return out.withColumns({c: F.round(c, 6) for c in doubles})


@query("matrix_coarsen_merge", f"WITH {a.PIXELS} SELECT least(b1 // 4, b2 // 4) AS bin1, greatest(b1 // 4, b2 // 4) AS bin2, CAST(sum(n) AS BIGINT) AS count FROM pixels GROUP BY 1, 2")
def coarsen(spark, d):
    return cn.coarsen_merge(a.pixels(spark, d).withColumn("chrom", F.lit("c")), 4).drop("chrom")


@query("matrix_standardize", f"""WITH {a.PIXELS} SELECT 'all' AS context, 'c' AS chrom, least(x // f, y // f) AS bin1, greatest(x // f, y // f) AS bin2, CAST(sum(n) AS BIGINT) AS count FROM (SELECT b1 AS x, b2 AS y, n, 4 AS f FROM pixels UNION ALL SELECT b1 // 2, b2 // 2, n, 2 FROM pixels) GROUP BY 1, 2, 3, 4""")
def standardized(spark, d):
    p = a.pixels(spark, d)
    fine = p.selectExpr("'all' as context", "'s1' as source", "1000 as resolution", "'c' as chrom", "bin1", "bin2", "count")
    other = p.selectExpr("'all' as context", "'s2' as source", "2000 as resolution", "'c' as chrom", "bin1 div 2 as bin1", "bin2 div 2 as bin2", "count")
    have = spark.createDataFrame([("all", "s1", 1000), ("all", "s1", 300), ("all", "s2", 2000), ("all", "s2", 8000)], "context string, source string, resolution int")
    return cn.standardize(fine.unionByName(other), have, 4000)


_DECAY = f"""{a.PIXELS}, wt AS (SELECT k AS bin, CASE WHEN k % 13 = 5 THEN NULL ELSE 0.01 * (1 + k % 7) END AS w FROM (SELECT unnest(range(0, 40)) AS k)), bal AS (SELECT b2 - b1 AS off, n * x.w * y.w AS v FROM pixels JOIN wt x ON x.bin = b1 JOIN wt y ON y.bin = b2 WHERE x.w IS NOT NULL AND y.w IS NOT NULL AND b2 > b1),
vp AS (SELECT y.bin - x.bin AS off, count(*) AS pairs FROM wt x JOIN wt y ON y.bin > x.bin WHERE x.w IS NOT NULL AND y.w IS NOT NULL GROUP BY 1), decay AS (SELECT off, sum(v) AS contact, any_value(pairs) AS pairs, sum(v) / any_value(pairs) AS mean_contact FROM bal JOIN vp USING (off) GROUP BY 1)"""


def _decay(spark, d):
    w = spark.range(40).select(F.lit("c").alias("chrom"), F.col("id").alias("bin"), F.expr("case when id % 13 = 5 then null else 0.01D * (1 + id % 7) end as weight"))
    return cn.distance_decay(a.pixels(spark, d).withColumn("chrom", F.lit("c")), w)


@query("distance_decay", f"""WITH {_DECAY} SELECT off AS "offset", round(contact, 6) AS contact, pairs, round(mean_contact, 6) AS mean_contact FROM decay""")
def decay(spark, d):
    return _decay(spark, d).select("offset", F.round("contact", 6).alias("contact"), "pairs", F.round("mean_contact", 6).alias("mean_contact"))


@query("powerlaw_fit", f"WITH {_DECAY} SELECT round(regr_slope(ln(mean_contact), ln(off * 5000.0)), 6) AS gamma, round(exp(regr_intercept(ln(mean_contact), ln(off * 5000.0))), 6) AS scale, count(*) AS fitted_diagonals FROM decay WHERE mean_contact > 0")
def powerlaw(spark, d):
    return cn.fit_powerlaw(_decay(spark, d), resolution=5000).select(F.round("gamma", 6).alias("gamma"), F.round("scale", 6).alias("scale"), "fitted_diagonals")


@query("geo_mean_model", "SELECT round(avg(s_acctbal / 10000), 9) AS gamma, round(exp(avg(ln(abs(s_acctbal) + 1))), 6) AS scale, count(*) AS contexts FROM supplier")
def atlas(spark, d):
    m = a.table(spark, d, "supplier").select((F.col("s_acctbal") / 10000).alias("gamma"), (F.abs("s_acctbal") + 1).alias("scale"))
    return cn.atlas_model(m).select(F.round("gamma", 9).alias("gamma"), F.round("scale", 6).alias("scale"), "contexts")


_PX = """px(chrom, bin1, bin2, value) AS (VALUES ('c', 0, 1, 2.0), ('c', 1, 2, 3.5), ('c', 1, 4, 1.25), ('c', 2, 3, 'NaN'::DOUBLE), ('c', 3, 4, 'NaN'::DOUBLE), ('c', 0, 5, 'NaN'::DOUBLE)), shape(chrom, bins) AS (VALUES ('c', 6)),
q AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 11 = 0 THEN 'x' ELSE 'c' END AS chrom, l_partkey % 700 AS p1, l_suppkey * 7 % 650 AS p2, 0.5 + l_linenumber AS expected FROM lineitem),
b AS (SELECT q.*, s.bins, least(p1, p2) // 100 AS b1, greatest(p1, p2) // 100 AS b2 FROM q LEFT JOIN shape s USING (chrom)), v AS (SELECT b.*, coalesce(m.value, 0) AS direct, CASE WHEN b1 = b2 AND b1 > 0 THEN coalesce(l.value, 0) END AS vl, CASE WHEN b1 = b2 AND b1 + 1 < bins THEN coalesce(r.value, 0) END AS vr
FROM b LEFT JOIN px m ON m.chrom = b.chrom AND m.bin1 = b1 AND m.bin2 = b2 LEFT JOIN px l ON l.chrom = b.chrom AND b1 = b2 AND l.bin1 = b1 - 1 AND l.bin2 = b1 LEFT JOIN px r ON r.chrom = b.chrom AND b1 = b2 AND r.bin1 = b1 AND r.bin2 = b1 + 1),
n AS (SELECT *, greatest(CASE WHEN isnan(vl) THEN NULL ELSE vl END, CASE WHEN isnan(vr) THEN NULL ELSE vr END) AS near FROM v),
o AS (SELECT *, CASE WHEN bins IS NULL THEN 'chromosome_absent_from_matrix' WHEN b2 >= bins THEN 'position_outside_matrix' WHEN b1 = b2 AND near IS NULL THEN 'unbalanced_or_masked_adjacent_bins' WHEN b1 = b2 THEN 'adjacent_bin_proxy' WHEN isnan(direct) THEN 'unbalanced_or_masked_bin' ELSE 'observed_matrix_pixel' END AS status FROM n),
w AS (SELECT *, CASE status WHEN 'adjacent_bin_proxy' THEN near WHEN 'observed_matrix_pixel' THEN direct END AS observed FROM o)"""


@query("contact_lookup", f"WITH {_PX} SELECT l_orderkey, l_linenumber, l_partkey, status, CAST(observed AS DOUBLE) AS observed, CAST(coalesce(observed + expected, expected) AS DOUBLE) AS weight, round(CAST(observed / expected AS DOUBLE), 9) AS observed_over_expected FROM w")
def lookup(spark, d):
    nan = float("nan")
    px = spark.createDataFrame([("c", 0, 1, 2.0), ("c", 1, 2, 3.5), ("c", 1, 4, 1.25), ("c", 2, 3, nan), ("c", 3, 4, nan), ("c", 0, 5, nan)], "chrom string, bin1 long, bin2 long, value double")
    q = a.table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "case when l_partkey % 11 = 0 then 'x' else 'c' end as chrom", "l_partkey % 700 as pos1", "l_suppkey * 7 % 650 as pos2", "0.5D + l_linenumber as expected")
    out = cn.contact_lookup(q, px, spark.createDataFrame([("c", 6)], "chrom string, bins long"), 100)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "status", "observed", "weight", F.round("observed_over_expected", 9).alias("observed_over_expected"))


@query("ice_balance")
def ice(spark, d):
    return cn.ice_balance(a.pixels(spark, d).withColumn("context", F.lit("all")))
