"""From elements to genes: promoters, nearest start sites, scored edges, ranked candidates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import numbered, powerlaw_expected, sig10
from .contacts import contact_lookup, settled
from .intervals import TILE, band_join, nearest


def promoters(transcripts: DataFrame, sizes: DataFrame, width: int = 1000, prefix: str = "PROM", digits: int = 8) -> DataFrame:
    """Distinct start sites (gene_id, chrom, tss, strand) of transcripts with their window, transcript ids and first gene name.

    ``transcripts``: chrom, start (zero-based), end, strand, gene_id,
    gene_name, transcript_id, line.
    """
    tss = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1)
    sites = transcripts.withColumn("tss", tss).join(F.broadcast(sizes), "chrom").where((F.col("tss") >= 0) & (F.col("tss") < F.col("size")))
    out = sites.groupBy("chrom", "rank", "size", "tss", "gene_id", "strand").agg(F.array_join(F.array_sort(F.collect_set("transcript_id")), ";").alias("transcript_ids"), F.min_by("gene_name", "line").alias("gene_name"))
    # Numbers run by rank, site, gene and strand: those of a tile come after the sites of the tiles before it.
    out = out.withColumn("tile", F.floor(F.col("tss") / TILE))
    per = out.groupBy("rank", "tile").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy("rank", "tile").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = F.row_number().over(Window.partitionBy("rank", "tile").orderBy("tss", "gene_id", "strand"))
    out = out.withColumn("n", n).join(per.select("rank", "tile", before.alias("before")), ["rank", "tile"])
    return out.select(numbered(prefix, digits, F.col("before") + F.col("n")).alias("promoter_id"), "gene_id", "gene_name", "chrom", "tss", "strand", F.greatest(F.col("tss") - width // 2, F.lit(0)).alias("start"), F.least(F.col("tss") + width // 2, F.col("size")).alias("end"), "transcript_ids")


def promoter_activity(proms: DataFrame, elements: DataFrame, threshold: float, reach: int = 500, by: tuple[str, ...] = ()) -> DataFrame:
    """Activity of each promoter from the elements whose summits lie within ``reach`` bp of its start site.

    ``elements``: id, chrom, summit, atac, posterior (nullable), combined, and
    ``by`` (a context, say), in each value of which every promoter gets a row.
    Active if the largest posterior reaches the threshold; the score is the
    largest product of combined activity and posterior of one element.
    """
    near = band_join(elements, proms.select("chrom", "promoter_id", "tss"), reach, "summit", "tss")
    found = near.groupBy(*by, F.col("b_promoter_id").alias("promoter_id")).agg(
        F.max("atac").alias("atac"), F.max("posterior").alias("posterior"), F.max("combined").alias("combined"), F.max(F.col("combined") * F.coalesce("posterior", F.lit(0.0))).alias("score"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("summit", "id"))), lambda s: s["id"].cast("string")), ";").alias("support_ids"),
    )
    grid = proms.crossJoin(elements.select(*by).distinct()) if by else proms  # promoters x contexts is the result
    out = grid.join(found.hint("merge"), [*by, "promoter_id"], "left")
    return out.withColumn("active", F.coalesce(F.col("posterior") >= threshold, F.lit(False))).withColumn("score", F.coalesce("score", F.lit(0.0))).withColumn("support_ids", F.coalesce("support_ids", F.lit("")))


def distance_edges(elements: DataFrame, proms: DataFrame, reach: int, gamma: float, scale: float, resolution: int) -> DataFrame:
    """Every element-promoter pair within ``reach`` with its expected contact and candidate score."""
    pairs = band_join(elements, proms.select("chrom", "promoter_id", "gene_id", "tss", "active", "score"), reach, "summit", "tss")
    x = pairs.withColumn("weight", powerlaw_expected("distance", F.lit(scale), F.lit(gamma), resolution))
    return x.select("id", F.col("b_promoter_id").alias("promoter_id"), F.col("b_gene_id").alias("gene_id"), "distance", "weight", F.col("b_active").alias("active"), (F.col("weight") * F.col("b_score")).alias("score"))


def collapse_genes(edges: DataFrame, by: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row for each (element, gene): best promoter, best active one, counts, least distance, largest weight.

    Scores compare after rounding to ten digits; of equal promoters the
    largest id wins.
    """
    order = F.struct(sig10("score").alias("s"), sig10("weight").alias("w"), (-F.col("distance")).alias("d"), F.col("promoter_id").alias("p"))
    best, live = F.max(order), F.max(F.when(F.col("active"), order))
    out = edges.groupBy(*by, "gene_id").agg(best.alias("b"), live.alias("l"), F.count("*").alias("promoter_count"), F.count_if("active").alias("active_promoter_count"), F.min("distance").alias("minimum_distance"), F.max(sig10("weight")).alias("contact_value"))
    return out.select(*by, "gene_id", "promoter_count", "active_promoter_count", "minimum_distance", "contact_value", F.col("b.p").alias("best_promoter_id"), F.col("b.s").alias("score"), F.col("l.p").alias("best_active_promoter_id"), F.col("l.s").alias("active_score"))


def rank_genes(genes: DataFrame, by: tuple[str, ...] = ("id",)) -> DataFrame:
    """Four ranks in each element: candidate, contact, nearest, and active (null without an active promoter)."""
    of = Window.partitionBy(*by)
    tail = ("minimum_distance", "gene_id")
    active = F.row_number().over(Window.partitionBy(*by, F.col("active_score").isNull()).orderBy(F.col("active_score").desc(), *tail))
    out = genes.withColumn("candidate_rank", F.row_number().over(of.orderBy(F.col("score").desc(), *tail))).withColumn("contact_rank", F.row_number().over(of.orderBy(F.col("contact_value").desc(), *tail)))
    out = out.withColumn("nearest_rank", F.row_number().over(of.orderBy(*tail))).withColumn("active_rank", F.when(F.col("active_score").isNotNull(), active))
    return out.withColumn("is_primary", F.col("candidate_rank") == 1)


def focused(edges: DataFrame, posterior: Column, threshold: float, ratio: float | None = None) -> DataFrame:
    """Edges of elements at or above the posterior, and with an observed/expected ratio at or above ``ratio``; then collapsed and ranked anew."""
    kept = edges.where(posterior >= threshold)
    if ratio is not None:
        kept = kept.where(sig10("observed_over_expected") >= ratio)
    return rank_genes(collapse_genes(kept))


def nearest_active(elements: DataFrame, proms: DataFrame) -> DataFrame:
    """Genes at the nearest active promoter of each element, however far; ties are rows of their own."""
    found = nearest(elements.select("id", "chrom", F.col("summit").alias("pos")), proms.where("active").select("chrom", F.col("tss").alias("pos"), F.col("gene_id").alias("name")))
    return found.select("id", "distance", F.explode("names").alias("gene_id"))


# The fields of nodes, edges and genes, and the classes that count as enhancers, as the published tables name them.
NODE_FIELDS = (
    "context", "node_id", "node_type", "master_dhs_id", "promoter_id", "gene_id", "gene_name", "chrom", "start", "end", "anchor", "regulatory_class", "atac_accessible", "atac_signal", "h3k27ac_posterior", "combined_activity", "active",
    "blacklist_overlap",
)
EDGE_FIELDS = (
    "context", "source_node_id", "target_node_id", "master_dhs_id", "promoter_id", "gene_id", "gene_name", "distance_bp", "promoter_active", "promoter_activity_score", "promoter_atac_accessible", "promoter_atac_signal", "promoter_h3k27ac_posterior",
    "contact_strategy", "contact_assay", "contact_match", "contact_resolution_bp", "contact_status", "same_contact_bin", "observed_balanced_contact", "powerlaw_expected_contact", "contact_weight", "observed_over_expected", "candidate_link_score",
)
GENE_FIELDS = (
    "context", "master_dhs_id", "element_chrom", "element_start", "element_end", "element_summit", "regulatory_class", "element_h3k27ac_posterior", "element_combined_activity", "element_blacklist_overlap", "gene_id", "gene_name", "promoter_count",
    "active_promoter_count", "best_promoter_id", "best_active_promoter_id", "minimum_distance_bp", "best_promoter_active", "best_promoter_atac_signal", "best_promoter_h3k27ac_posterior", "contact_strategy", "contact_assay", "contact_match",
    "contact_resolution_bp", "best_contact_status", "best_observed_balanced_contact", "best_powerlaw_expected_contact", "best_contact_weight", "best_observed_over_expected", "candidate_link_score", "candidate_gene_rank", "active_candidate_gene_rank",
    "contact_gene_rank", "nearest_gene_rank",
)
ENHANCERS = ("proximal_enhancer_like", "distal_enhancer_like")


@dataclass
class ContextGraph:
    """Nodes, edges and genes of all contexts; each is a table with the fields above."""

    nodes: DataFrame
    edges: DataFrame
    genes: DataFrame
    states: DataFrame


def context_graph(elements: DataFrame, proms: DataFrame, models: DataFrame, balanced: DataFrame, shape: DataFrame, reach: int, pseudocount: float, threshold: float, once: bool = False) -> ContextGraph:
    """Element-promoter graphs of all contexts in one plan.

    ``elements`` (members): context, id, chrom, start, end, summit,
    regulatory_class, atac, posterior, combined, blacklist_overlap;
    ``models``: context, strategy ('observed' or 'powerlaw'), assay, match,
    resolution, gamma, scale; ``balanced`` and ``shape``: the matrices of
    observed contexts (see ``contact_lookup``), with a context.  Edges join
    summits and start sites up to ``reach`` apart.  An observed contact weighs
    its balanced value and ``pseudocount`` times the expected one, a modelled
    one the expected one.  Numbers are those of tables written with ten digits.
    With ``once``, states and edges are written to the checkpoint folder, for
    callers that read several tables of the graph.
    """
    states = promoter_activity(proms, elements, threshold, by=("context",))
    if once:
        states = settled(states)
    edges = _graph_edges(elements, states, models, balanced, shape, reach, pseudocount)
    if once:
        edges = settled(edges)
    return ContextGraph(_graph_nodes(elements, states, threshold), edges, graph_genes(edges, elements), states)


def _graph_nodes(elements: DataFrame, states: DataFrame, threshold: float) -> DataFrame:
    empty = F.lit("")
    own = elements.select(
        "context", F.concat(F.lit("element:"), F.col("id").cast("string")).alias("node_id"), F.lit("element").alias("node_type"), F.col("id").cast("string").alias("master_dhs_id"), empty.alias("promoter_id"), empty.alias("gene_id"), empty.alias("gene_name"),
        "chrom", "start", "end", F.col("summit").alias("anchor"), "regulatory_class", F.lit(1).alias("atac_accessible"), sig10("atac").alias("atac_signal"), sig10("posterior").alias("h3k27ac_posterior"), sig10("combined").alias("combined_activity"),
        F.coalesce(F.col("posterior") >= threshold, F.lit(False)).cast("int").alias("active"), F.col("blacklist_overlap").cast("int").alias("blacklist_overlap"),
    )
    zero = lambda c: F.coalesce(sig10(c), F.lit(0.0))
    promoters = states.select(
        "context", F.concat(F.lit("promoter:"), "promoter_id").alias("node_id"), F.lit("promoter").alias("node_type"), F.col("support_ids").alias("master_dhs_id"), "promoter_id", "gene_id", "gene_name",
        "chrom", "start", "end", F.col("tss").alias("anchor"), F.lit("promoter").alias("regulatory_class"), (F.col("support_ids") != "").cast("int").alias("atac_accessible"), zero("atac").alias("atac_signal"), sig10("posterior").alias("h3k27ac_posterior"),
        zero("combined").alias("combined_activity"), F.col("active").cast("int").alias("active"), F.lit(None).cast("int").alias("blacklist_overlap"),
    )
    return own.unionByName(promoters).select(*NODE_FIELDS)


def _graph_edges(elements: DataFrame, states: DataFrame, models: DataFrame, balanced: DataFrame, shape: DataFrame, reach: int, pseudocount: float) -> DataFrame:
    targets = states.select("context", "chrom", "tss", "promoter_id", "gene_id", "gene_name", "active", "score", "support_ids", "atac", "posterior")
    pairs = band_join(elements.select("context", "id", "chrom", "summit"), targets, reach, "summit", "tss", ("context", "chrom")).join(F.broadcast(models), "context")
    x = pairs.withColumn("expected", powerlaw_expected("distance", "scale", "gamma", F.col("resolution"))).withColumns({"pos1": F.col("summit"), "pos2": F.col("b_tss")})
    x = contact_lookup(x, balanced, shape, F.col("resolution"), pseudocount, ("context", "chrom"))
    seen = F.col("strategy") == "observed"
    status, weight = F.when(seen, F.col("status")).otherwise("distance_model"), F.when(seen, F.col("weight")).otherwise(F.col("expected"))
    return x.select(
        "context", F.concat(F.lit("element:"), F.col("id").cast("string")).alias("source_node_id"), F.concat(F.lit("promoter:"), "b_promoter_id").alias("target_node_id"), F.col("id").cast("string").alias("master_dhs_id"),
        F.col("b_promoter_id").alias("promoter_id"), F.col("b_gene_id").alias("gene_id"), F.col("b_gene_name").alias("gene_name"), F.col("distance").alias("distance_bp"), F.col("b_active").cast("int").alias("promoter_active"),
        sig10("b_score").alias("promoter_activity_score"), (F.col("b_support_ids") != "").cast("int").alias("promoter_atac_accessible"), F.coalesce(sig10("b_atac"), F.lit(0.0)).alias("promoter_atac_signal"),
        sig10("b_posterior").alias("promoter_h3k27ac_posterior"), F.col("strategy").alias("contact_strategy"), F.col("assay").alias("contact_assay"), F.col("match").alias("contact_match"), F.col("resolution").alias("contact_resolution_bp"),
        status.alias("contact_status"), F.col("same_bin").alias("same_contact_bin"), sig10(F.when(seen, F.col("observed"))).alias("observed_balanced_contact"), sig10("expected").alias("powerlaw_expected_contact"), sig10(weight).alias("contact_weight"),
        sig10(F.when(seen, F.col("observed_over_expected"))).alias("observed_over_expected"), sig10(weight * F.col("b_score")).alias("candidate_link_score"),
    ).select(*EDGE_FIELDS)


def graph_genes(edges: DataFrame, elements: DataFrame) -> DataFrame:
    """One ranked row for each (context, element, gene) of an edge table.

    The best promoter has the largest score, then weight, then the least
    distance, then the largest id; ranks go by score, by weight and by
    distance, and by the score of the best active promoter, ties by distance
    and gene.
    """
    of = ["context", "master_dhs_id"]
    best = F.struct(
        F.col("candidate_link_score").alias("s"), F.col("contact_weight").alias("w"), (-F.col("distance_bp")).alias("d"), F.col("promoter_id").alias("p"), "gene_name", "promoter_active", "promoter_atac_signal", "promoter_h3k27ac_posterior",
        "contact_strategy", "contact_assay", "contact_match", "contact_resolution_bp", "contact_status", "observed_balanced_contact", "powerlaw_expected_contact", "observed_over_expected",
    )
    live = F.when(F.col("promoter_active") == 1, F.struct(F.col("candidate_link_score").alias("s"), F.col("contact_weight").alias("w"), (-F.col("distance_bp")).alias("d"), F.col("promoter_id").alias("p")))
    # Pairs are many beside what they are joined from, so they are dealt as they come: a task that joins them sorts none.
    genes = edges.repartition(*of).groupBy(*of, "gene_id").agg(
        F.max(best).alias("b"), F.max(live).alias("l"), F.count("*").alias("promoter_count"), F.count_if(F.col("promoter_active") == 1).alias("active_promoter_count"), F.min("distance_bp").alias("minimum_distance_bp"), F.max("contact_weight").alias("top")
    )
    tail = ("minimum_distance_bp", "gene_id")
    here = Window.partitionBy(*of)
    rank = lambda by: F.row_number().over(here.orderBy(by, *tail))
    active = F.when(F.col("l").isNotNull(), rank(F.col("l.s").desc_nulls_last()))  # those without an active promoter come last
    genes = genes.withColumns({"candidate_gene_rank": rank(F.col("b.s").desc()), "active_candidate_gene_rank": active, "contact_gene_rank": rank(F.col("top").desc()), "nearest_gene_rank": F.row_number().over(here.orderBy(*tail))})
    own = elements.select(
        "context", F.col("id").cast("string").alias("master_dhs_id"), F.col("chrom").alias("element_chrom"), F.col("start").alias("element_start"), F.col("end").alias("element_end"), F.col("summit").alias("element_summit"), "regulatory_class",
        sig10("posterior").alias("element_h3k27ac_posterior"), sig10("combined").alias("element_combined_activity"), F.col("blacklist_overlap").cast("int").alias("element_blacklist_overlap"),
    )
    told = {
        "best_promoter_id": "b.p", "best_active_promoter_id": "l.p", "best_promoter_active": "b.promoter_active", "best_promoter_atac_signal": "b.promoter_atac_signal", "best_promoter_h3k27ac_posterior": "b.promoter_h3k27ac_posterior",
        "best_contact_status": "b.contact_status", "best_observed_balanced_contact": "b.observed_balanced_contact", "best_powerlaw_expected_contact": "b.powerlaw_expected_contact", "best_contact_weight": "b.w",
        "best_observed_over_expected": "b.observed_over_expected", "candidate_link_score": "b.s", **{c: f"b.{c}" for c in ("gene_name", "contact_strategy", "contact_assay", "contact_match", "contact_resolution_bp")},
    }
    return genes.join(own.hint("merge"), of).withColumns({name: F.col(c) for name, c in told.items()}).select(*GENE_FIELDS)


def _focus(elements: DataFrame, threshold: float) -> DataFrame:
    """Enhancers whose posterior reaches the threshold."""
    return elements.where(F.col("regulatory_class").isin(*ENHANCERS) & (sig10("posterior") >= threshold))


def _of(edges: DataFrame, elements: DataFrame) -> DataFrame:
    return edges.join(elements.select("context", F.col("id").cast("string").alias("master_dhs_id")).hint("merge"), ["context", "master_dhs_id"], "left_semi")


def active_contact_genes(edges: DataFrame, elements: DataFrame, threshold: float, ratio: float) -> DataFrame:
    """Genes of active enhancers by their contacts of at least ``ratio`` times the expected value, ranked anew."""
    focus = _focus(elements, threshold)
    return graph_genes(_of(edges.where(F.col("observed_over_expected") >= ratio), focus), focus)


def active_distance_genes(edges: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """Genes of active enhancers by active promoters, in contexts with a distance model, ranked anew.

    Beside them stand the genes of the nearest active start site and of the
    nearest start site of all within the graph's reach.
    """
    focus = _focus(elements, threshold)
    x = _of(edges.where("contact_strategy = 'powerlaw'"), focus)

    def closest(rows: DataFrame, name: str) -> DataFrame:
        at = rows.groupBy("context", "master_dhs_id", "distance_bp").agg(F.array_sort(F.collect_set(F.struct("gene_id", "gene_name"))).alias("g"))
        least = at.groupBy("context", "master_dhs_id").agg(F.min_by(F.struct("distance_bp", "g"), "distance_bp").alias("m"))
        joined = lambda f: F.array_join(F.transform("m.g", lambda g: g[f]), ";")
        return least.select("context", "master_dhs_id", joined("gene_id").alias(f"{name}_gene_ids"), joined("gene_name").alias(f"{name}_gene_names"), F.col("m.distance_bp").alias(f"{name}_distance_bp"))

    live = x.where("promoter_active = 1")
    genes = graph_genes(live, focus).withColumn("evidence_type", F.lit("distance_model_active_promoter")).withColumn("is_primary_candidate", (F.col("candidate_gene_rank") == 1).cast("int"))
    of = ["context", "master_dhs_id"]
    return genes.join(closest(live, "nearest_active_tss"), of).join(closest(x, "nearest_tss"), of)


def nearest_active_genes(elements: DataFrame, states: DataFrame, threshold: float) -> DataFrame:
    """For each active enhancer a row for every active promoter that is nearest to it, however far, in each context.

    ``states`` are those of ``promoter_activity`` by context.  Active elements
    that support the promoter are named, and those of them that are
    promoters by class.
    """
    live = elements.where(F.col("posterior") >= threshold).select("context", F.col("id").cast("string").alias("support"), (F.col("regulatory_class") == "promoter_associated").alias("own"))
    active = states.where("active")
    support = active.select("context", "promoter_id", F.explode(F.split("support_ids", ";")).alias("support")).join(live.hint("merge"), ["context", "support"])
    names = lambda c: F.array_sort(F.collect_set(c))
    support = support.groupBy("context", "promoter_id").agg(names(F.col("support")).alias("s"), names(F.when(F.col("own"), F.col("support"))).alias("o"))
    place = F.concat_ws("/", "context", "chrom")
    focus = _focus(elements, threshold).withColumn("id", F.col("id").cast("string"))
    found = nearest(focus.select(F.concat_ws("/", "context", "id").alias("id"), place.alias("chrom"), F.col("summit").alias("pos")), active.select(place.alias("chrom"), F.col("tss").alias("pos"), F.col("promoter_id").alias("name")))
    ties = found.where("distance is not null").select(F.col("id").alias("key"), "distance", F.size("names").alias("ties"), F.explode("names").alias("promoter_id"))
    x = ties.join(focus.withColumn("key", F.concat_ws("/", "context", "id")).hint("merge"), "key").withColumnRenamed("chrom", "element_chrom")
    told = active.join(support.hint("merge"), ["context", "promoter_id"]).select("context", "promoter_id", "gene_id", "gene_name", "tss", F.col("start").alias("p_start"), F.col("end").alias("p_end"), F.col("atac").alias("p_atac"), F.col("posterior").alias("p_posterior"), F.col("combined").alias("p_combined"), "s", "o")
    x = x.join(told.hint("merge"), ["context", "promoter_id"])
    return x.select(
        "context", F.col("id").alias("master_dhs_id"), "element_chrom", F.col("start").alias("element_start"), F.col("end").alias("element_end"), F.col("summit").alias("element_summit"), "regulatory_class", sig10("posterior").alias("element_h3k27ac_posterior"),
        sig10("combined").alias("element_combined_activity"), F.col("blacklist_overlap").cast("int").alias("element_blacklist_overlap"), "promoter_id", F.array_join("s", ";").alias("active_promoter_supporting_element_ids"),
        F.size("s").alias("active_promoter_supporting_element_count"), F.array_join("o", ";").alias("active_promoter_associated_element_ids"), F.size("o").alias("active_promoter_associated_element_count"), "gene_id", "gene_name",
        F.col("tss").alias("promoter_tss"), F.col("p_start").alias("promoter_start"), F.col("p_end").alias("promoter_end"), F.col("distance").alias("distance_bp"), F.col("ties").alias("nearest_active_tss_tie_count"), sig10("p_atac").alias("promoter_atac_signal"),
        sig10("p_posterior").alias("promoter_h3k27ac_posterior"), sig10("p_combined").alias("promoter_combined_activity"), F.lit("nearest_active_promoter_tss").alias("evidence_type"),
    )


def graph_metrics(graph: ContextGraph, models: DataFrame, contact: DataFrame, nearest_rows: DataFrame, distance: DataFrame) -> DataFrame:
    """One row for each context with the sizes of its tables, and one, context 'all', with their sums.

    Fails unless contexts of the graph are those of ``models``, and distance
    candidates only stand in contexts with a distance model.
    """
    count = lambda df, name, where="true": df.where(where).groupBy("context").agg(F.count("*").alias(name))
    parts = [
        count(graph.nodes, "element_node_count", "node_type = 'element'"), count(graph.nodes, "promoter_node_count", "node_type = 'promoter'"), count(graph.nodes, "active_promoter_count", "node_type = 'promoter' and active = 1"),
        count(graph.edges, "element_promoter_edge_count"), count(graph.edges, "observed_edge_count", "observed_balanced_contact is not null"), count(graph.genes, "element_gene_candidate_count"), count(contact, "active_contact_enhancer_gene_candidate_count"),
        count(nearest_rows, "nearest_active_promoter_gene_candidate_count"), count(distance, "active_distance_enhancer_gene_candidate_count"),
    ]
    out = models.select("context", F.col("strategy").alias("contact_strategy"), F.col("resolution").alias("contact_resolution_bp"))
    names = []
    for part in parts:
        names.append(part.columns[1])
        out = out.join(part, "context", "full")
    sound = F.col("contact_strategy").isNotNull() & (F.coalesce(F.col("element_node_count"), F.lit(0)) > 0) & ((F.col("contact_strategy") == "powerlaw") | F.col("active_distance_enhancer_gene_candidate_count").isNull())
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("context")).otherwise(F.raise_error(F.lit("the contexts of the graph, its models and its candidates differ")).cast("string"))
    rows = out.withColumn("context", checked).na.fill(0, names)
    total = rows.agg(*[F.sum(n).alias(n) for n in names]).select(F.lit("all").alias("context"), F.lit(None).cast("string").alias("contact_strategy"), F.lit(None).cast("int").alias("contact_resolution_bp"), *names)
    return rows.unionByName(total)


def nearest_wide(catalog: DataFrame, proms: DataFrame, states: DataFrame, contexts: list[str], classes: tuple[str, ...] = ENHANCERS) -> DataFrame:
    """One row for each enhancer: its nearest start sites, all that tie, and twelve columns a context.

    ``catalog``: id, context, chrom, start, end, summit, regulatory_class,
    member, atac, posterior, state, combined, a row for every context;
    ``states`` are those of ``promoter_activity`` by context.  A promoter's
    states are gathered into one row before the ties are joined, so they are
    aggregated once.  Without a start site on the chromosome the distance is
    null and there are no ties.
    """
    of = lambda c, v: F.max(F.when(F.col("context") == c, v))
    own = F.struct("member", "atac", "posterior", "state", "combined")
    enhancers = catalog.where(F.col("regulatory_class").isin(*classes)).groupBy("id", "chrom", "start", "end", "summit", "regulatory_class").agg(*[F.max(F.when(F.col("context") == c, own)).alias(f"__{i}") for i, c in enumerate(contexts)])  # of the element
    state = F.struct("active", "score", F.coalesce("atac", F.lit(0.0)).alias("atac"), "posterior", F.coalesce("combined", F.lit(0.0)).alias("combined"), "support_ids")
    by_promoter = states.groupBy("promoter_id").agg(*[of(c, state).alias(f"__{i}") for i, c in enumerate(contexts)])
    place = proms.select("promoter_id", F.struct(F.col("tss"), F.col("promoter_id"), "gene_id", "gene_name", "strand", "transcript_ids").alias("p"))
    found = nearest(enhancers.select("id", "chrom", F.col("summit").alias("pos")), proms.select("chrom", F.col("tss").alias("pos"), F.col("promoter_id").alias("name")))
    ties = found.select("id", "distance", F.explode_outer("names").alias("promoter_id")).join(place, "promoter_id", "left").join(by_promoter, "promoter_id", "left")
    at = [F.struct("p", *[f"__{i}" for i in range(len(contexts))])]
    out = ties.groupBy("id").agg(F.max("distance").alias("distance"), F.array_sort(F.collect_list(F.when(F.col("promoter_id").isNotNull(), at[0]))).alias("t")).join(enhancers, "id")
    told = lambda f, sep=";": F.array_join(F.transform("t", lambda t: t["p"][f].cast("string")), sep)

    def live(at: str) -> Column:
        return F.filter("t", lambda t: t[at]["active"])

    def top(at: str, field: str) -> Column:
        return sig10(F.array_max(F.transform("t", lambda t: t[at][field])))

    def support(at: str) -> Column:
        ids = F.flatten(F.transform(live(at), lambda t: F.split(t[at]["support_ids"], ";")))
        return F.array_join(F.array_sort(F.array_remove(F.array_distinct(ids), "")), ";")

    wide = []
    for i, c in enumerate(contexts):
        at = f"__{i}"
        columns = {
            "element_context_membership": F.col(f"{at}.member").cast("int"), "element_atac_signal": sig10(f"{at}.atac"), "element_h3k27ac_posterior": sig10(f"{at}.posterior"), "element_activity_state": F.col(f"{at}.state"),
            "element_combined_activity": sig10(f"{at}.combined"), "nearest_promoter_active": (F.size(live(at)) > 0).cast("int"), "active_nearest_promoter_ids": F.array_join(F.transform(live(at), lambda t: t["p"]["promoter_id"]), ";"),
            "active_nearest_promoter_supporting_element_ids": support(at), "nearest_promoter_activity_score_max": top(at, "score"), "nearest_promoter_atac_signal_max": top(at, "atac"),
            "nearest_promoter_h3k27ac_posterior_max": top(at, "posterior"), "nearest_promoter_combined_activity_max": top(at, "combined"),
        }
        wide += [v.alias(f"{c}__{n}") for n, v in columns.items()]
    active = F.filter(F.array(*[F.when(F.size(live(f"__{i}")) > 0, F.lit(c)) for i, c in enumerate(contexts)]), lambda c: c.isNotNull())
    return out.select(
        F.col("id").alias("master_dhs_id"), F.col("chrom").alias("element_chrom"), F.col("start").alias("element_start"), F.col("end").alias("element_end"), F.col("summit").alias("element_summit"), "regulatory_class",
        F.col("distance").alias("nearest_tss_distance_bp"), F.size("t").alias("nearest_tss_tie_count"), told("promoter_id").alias("nearest_promoter_ids"), told("gene_id").alias("nearest_gene_ids"), told("gene_name").alias("nearest_gene_names"),
        told("tss").alias("nearest_tss_positions"), told("strand").alias("nearest_tss_strands"), told("transcript_ids", "|").alias("nearest_promoter_transcript_ids"), F.lit("nearest_annotated_tss").alias("evidence_type"),
        F.array_join(active, ";").alias("nearest_promoter_active_contexts"), F.size(active).alias("nearest_promoter_active_context_count"), *wide,
    )


def link_rollup(genes: DataFrame, by: str = "context") -> DataFrame:
    """Counts by context and, as context 'all', over all of them."""
    measures = [F.count("*").alias("links"), F.countDistinct("id").alias("elements"), F.countDistinct("gene_id").alias("genes"), F.count_if("is_primary").alias("primary_links")]
    return genes.groupBy(by).agg(*measures).unionByName(genes.agg(*measures).withColumn(by, F.lit("all")))
