import math

import numpy as np
import pytest
from genoframe.operators import contacts as cn, links as lk
from pyspark.sql import functions as F


def sizes(spark):
    return spark.createDataFrame([("chr1", 200_000, 1), ("chr2", 100, 2)], "chrom string, size long, rank int")


def transcripts(spark):
    rows = [("chr1", 1000, 1300, "+", "g1", "one", "t2", 1), ("chr1", 1000, 1500, "+", "g1", "other", "t1", 2), ("chr1", 4000, 5001, "-", "g2", "two", "t3", 3), ("chr2", 500, 900, "+", "g3", "off", "t4", 4)]
    return spark.createDataFrame(rows, "chrom string, start long, end long, strand string, gene_id string, gene_name string, transcript_id string, line long")


def test_promoters(spark):
    got = lk.promoters(transcripts(spark), sizes(spark)).orderBy("promoter_id").collect()
    assert [(r.promoter_id, r.gene_name, r.tss, r.start, r.end, r.transcript_ids) for r in got] == [("PROM00000001", "one", 1000, 500, 1500, "t1;t2"), ("PROM00000002", "two", 5000, 4500, 5500, "t3")]


def elements(spark, rows):
    return spark.createDataFrame(rows, "id long, chrom string, summit long, atac double, posterior double, combined double")


def test_support_is_inclusive_and_scores_are_products(spark):
    p = lk.promoters(transcripts(spark), sizes(spark))
    e = elements(spark, [(1, "chr1", 500, 5.0, 0.2, 10.0), (2, "chr1", 1500, 3.0, 0.6, 2.0), (3, "chr1", 1501, 99.0, 1.0, 99.0), (4, "chr1", 5100, 7.0, None, 4.0)])
    out = {r.gene_id: r for r in lk.promoter_activity(p, e, 0.5).collect()}
    assert (out["g1"].atac, out["g1"].posterior, out["g1"].combined, out["g1"].score, out["g1"].active, out["g1"].support_ids) == (5.0, 0.6, 10.0, 2.0, True, "1;2")
    assert (out["g2"].posterior, out["g2"].active, out["g2"].score) == (None, False, 0.0)


def test_power_law_links_and_ranks(spark):
    p = lk.promoter_activity(lk.promoters(transcripts(spark), sizes(spark)), elements(spark, [(9, "chr1", 1000, 1.0, 0.9, 10.0)]), 0.5)
    e = elements(spark, [(1, "chr1", 1950, 1.0, 0.5, 1.0)])
    edges = lk.distance_edges(e, p, 1_000_000, -1.0, 1000.0, 100)
    got = {r.gene_id: r for r in lk.rank_genes(lk.collapse_genes(edges)).collect()}
    assert got["g1"].candidate_rank == 1 and got["g1"].active_rank == 1 and got["g1"].is_primary
    assert got["g2"].candidate_rank == 2 and got["g2"].active_rank is None and got["g2"].score == 0.0
    assert got["g1"].contact_value == pytest.approx(1000 / 950) and got["g1"].score == pytest.approx(9 * 1000 / 950)


def test_ties_take_the_largest_promoter_and_the_smallest_gene(spark):
    rows = [(1, "p1", "b", 100, 1.0, True, 5.0), (1, "p2", "b", 100, 1.0, True, 5.00000000001), (1, "p3", "a", 100, 1.0, False, 5.0)]
    e = spark.createDataFrame(rows, "id long, promoter_id string, gene_id string, distance long, weight double, active boolean, score double")
    got = {r.gene_id: r for r in lk.rank_genes(lk.collapse_genes(e)).collect()}
    assert got["b"].best_promoter_id == "p2" and got["a"].candidate_rank == 1 and got["b"].candidate_rank == 2 and got["b"].active_rank == 1


def test_focused_filters_before_it_ranks(spark):
    rows = [(1, "p1", "x", 10, 1.0, True, 9.0, 0.99), (1, "p2", "x", 20, 1.0, True, 5.0, 1.0), (1, "p3", "y", 5, 1.0, True, 7.0, None)]
    e = spark.createDataFrame(rows, "id long, promoter_id string, gene_id string, distance long, weight double, active boolean, score double, observed_over_expected double")
    got = lk.focused(e, F.lit(0.5), 0.5, 1.0).collect()
    assert [(r.gene_id, r.best_promoter_id, r.candidate_rank) for r in got] == [("x", "p2", 1)]
    assert lk.focused(e, F.lit(0.499), 0.5, 1.0).count() == 0


def test_nearest_tables(spark):
    p = spark.createDataFrame([("p1", "gene_a", "chr1", 1000, True, 0.9), ("p2", "gene_b", "chr1", 2200, True, 0.8), ("p3", "gene_c", "chr1", 9000, False, 0.1)], "promoter_id string, gene_id string, chrom string, tss long, active boolean, posterior double")
    e = spark.createDataFrame([(1, "chr1", 1600), (2, "chr1", 8000)], "id long, chrom string, summit long")
    assert sorted(tuple(r) for r in lk.nearest_active(e, p).collect()) == [(1, 600, "gene_a"), (1, 600, "gene_b"), (2, 5800, "gene_b")]


def graph_parts(spark):
    proms = spark.createDataFrame(
        [("P1", "ga", "A", "chr1", 1000, "+", 500, 1500, "t1"), ("P2", "gb", "B", "chr1", 2200, "-", 1700, 2700, "t2;t3"), ("P3", "gc", "C", "chr1", 9000, "+", 8500, 9500, "t4"), ("P4", "gb", "B", "chr1", 30_000, "+", 29_500, 30_500, "t5")],
        "promoter_id string, gene_id string, gene_name string, chrom string, tss long, strand string, start long, end long, transcript_ids string",
    )
    rows = [(1, "chr1", 900, 1100, 1010, "promoter_associated", 5.0, 0.9, 10.0, 0), (2, "chr1", 1550, 1650, 1600, "distal_enhancer_like", 2.0, 0.7, 4.0, 1), (3, "chr1", 2100, 2300, 2210, "promoter_associated", 3.0, 0.6, 2.0, 0), (4, "chr1", 8800, 8900, 8850, "proximal_enhancer_like", 1.0, 0.2, 1.0, 0), (5, "chr9", 10, 30, 20, "distal_enhancer_like", 1.0, 0.95, 1.0, 0)]
    e = spark.createDataFrame([(c, *r) for c in ("obs", "mod") for r in rows], "context string, id long, chrom string, start long, end long, summit long, regulatory_class string, atac double, posterior double, combined double, blacklist_overlap int")
    models = spark.createDataFrame([("obs", "observed", "hic", "exact", 1000, -1.0, 1000.0), ("mod", "powerlaw", "", "", 1000, -0.5, 10.0)], "context string, strategy string, assay string, match string, resolution int, gamma double, scale double")
    nan = float("nan")
    px = spark.createDataFrame([("obs", "chr1", 0, 1, 0.5), ("obs", "chr1", 1, 2, 4.0), ("obs", "chr1", 1, 9, nan)], "context string, chrom string, bin1 long, bin2 long, value double")
    shape = spark.createDataFrame([("obs", "chr1", 20)], "context string, chrom string, bins long")
    return proms, e, lk.context_graph(e, proms, models, px, shape, 10_000, 0.5, 0.5), models


def test_context_graph(spark):
    proms, e, g, models = graph_parts(spark)
    assert g.nodes.columns == list(lk.NODE_FIELDS) and g.edges.columns == list(lk.EDGE_FIELDS) and g.genes.columns == list(lk.GENE_FIELDS)
    nodes = {(r.context, r.node_id): r for r in g.nodes.collect()}
    assert len(nodes) == 18 and nodes["obs", "promoter:P1"].master_dhs_id == "1" and nodes["obs", "promoter:P1"].active == 1 and nodes["mod", "promoter:P4"].atac_accessible == 0
    edges = {(r.context, r.master_dhs_id, r.promoter_id): r for r in g.edges.collect()}
    near = edges["obs", "2", "P2"]  # bins 1 and 2: expected 1000 / 1000, observed 4
    assert (near.contact_status, near.observed_balanced_contact, near.contact_weight, near.observed_over_expected, near.distance_bp) == ("observed_matrix_pixel", 4.0, 4.5, 4.0, 600)
    assert near.candidate_link_score == pytest.approx(4.5 * 2.0 * 0.6)
    same = edges["obs", "2", "P1"]  # one bin: the larger neighbour
    assert (same.contact_status, same.same_contact_bin, same.observed_balanced_contact) == ("adjacent_bin_proxy", 1, 4.0)
    masked = edges["obs", "2", "P3"]
    assert (masked.contact_status, masked.observed_balanced_contact, masked.observed_over_expected) == ("unbalanced_or_masked_bin", None, None) and masked.contact_weight == pytest.approx(0.5 * 1000 / 7400)
    model = edges["mod", "2", "P3"]
    assert model.contact_status == "distance_model" and model.contact_weight == pytest.approx(10 * 7400**-0.5) and model.observed_balanced_contact is None
    assert not any(k[1] == "5" or k[2] == "P4" for k in edges)
    genes = {(r.context, r.master_dhs_id, r.gene_id): r for r in g.genes.collect()}
    one = genes["obs", "2", "ga"]
    assert (one.candidate_gene_rank, one.active_candidate_gene_rank, one.nearest_gene_rank, one.best_promoter_id, one.promoter_count) == (1, 1, 1, "P1", 1)
    assert genes["obs", "2", "gc"].active_candidate_gene_rank is None and genes["obs", "2", "gc"].candidate_gene_rank == 3


def test_focused_graphs_and_metrics(spark):
    proms, e, g, models = graph_parts(spark)
    contact = lk.active_contact_genes(g.edges, e, 0.5, 1.0)
    assert {(r.context, r.master_dhs_id, r.gene_id, r.candidate_gene_rank) for r in contact.collect()} == {("obs", "2", "ga", 1), ("obs", "2", "gb", 2)}
    distance = lk.active_distance_genes(g.edges, e, 0.5)
    rows = {r.gene_id: r for r in distance.collect()}
    assert set(rows) == {"ga", "gb"} and rows["ga"].is_primary_candidate == 1 and rows["gb"].nearest_tss_gene_ids == "ga;gb" and rows["gb"].nearest_active_tss_gene_names == "A;B" and rows["ga"].nearest_tss_distance_bp == 600
    states = lk.promoter_activity(proms, e, 0.5, by=("context",))
    near = lk.nearest_active_genes(e, states, 0.5)
    got = {(r.context, r.master_dhs_id, r.promoter_id): r for r in near.collect()}
    assert set(got) == {(c, "2", p) for c in ("obs", "mod") for p in ("P1", "P2")}
    tie = got["obs", "2", "P1"]
    assert (tie.distance_bp, tie.nearest_active_tss_tie_count, tie.active_promoter_supporting_element_ids, tie.active_promoter_associated_element_count, tie.gene_name) == (600, 2, "1", 1, "A")
    m = {r.context: r for r in lk.graph_metrics(g, models, contact, near, distance).collect()}
    assert (m["obs"].element_node_count, m["mod"].promoter_node_count, m["all"].active_promoter_count, m["obs"].active_distance_enhancer_gene_candidate_count, m["all"].active_contact_enhancer_gene_candidate_count) == (5, 4, 4, 0, 2)
    with pytest.raises(Exception, match="differ"):
        lk.graph_metrics(g, models.where("context = 'obs'"), contact, near, distance).collect()


def test_wide_nearest_table(spark):
    proms, e, _, _ = graph_parts(spark)
    states = lk.promoter_activity(proms, e, 0.5, by=("context",))
    catalog = e.withColumn("member", F.col("id") != 4).withColumn("state", F.lit("s"))
    out = {r.master_dhs_id: r for r in lk.nearest_wide(catalog, proms, states, ["obs", "mod"]).collect()}
    assert set(out) == {2, 4, 5} and len(out[2]) == 17 + 24
    two, four, far = out[2], out[4], out[5]
    assert (two.nearest_tss_distance_bp, two.nearest_tss_tie_count, two.nearest_promoter_ids, two.nearest_promoter_transcript_ids, two.nearest_promoter_active_contexts) == (600, 2, "P1;P2", "t1|t2;t3", "obs;mod")
    assert (two.obs__active_nearest_promoter_ids, two.obs__active_nearest_promoter_supporting_element_ids, two.obs__nearest_promoter_activity_score_max) == ("P1;P2", "1;3", 9.0)
    assert (four.nearest_gene_ids, four.mod__nearest_promoter_active, four.mod__element_context_membership, four.nearest_promoter_active_context_count) == ("gc", 0, 0, 0)
    assert (far.nearest_tss_distance_bp, far.nearest_tss_tie_count, far.nearest_promoter_ids, far.obs__nearest_promoter_atac_signal_max) == (None, 0, "", None)


def test_contact_models(spark):
    rng = np.random.default_rng(3)
    rows = [("x", s, r, "chr1", i, j, int(rng.poisson(4000 / (j - i + 1) ** 0.9)) + 1) for s, r in (("s1", 500), ("s2", 1000)) for i in range(60) for j in range(i, 60)]
    px = spark.createDataFrame(rows, "context string, source string, resolution long, chrom string, bin1 long, bin2 long, count long")
    res = spark.createDataFrame([("x", "s1", 500), ("x", "s2", 1000), ("x", "s2", 300)], "context string, source string, resolution long")
    merged = cn.standardize(px, res, 1000)
    want = {}
    for _, _, r, _, i, j, c in rows:
        f = 1000 // r
        want[min(i // f, j // f), max(i // f, j // f)] = want.get((min(i // f, j // f), max(i // f, j // f)), 0) + c
    assert {(r.bin1, r.bin2): r["count"] for r in merged.collect()} == want
    with pytest.raises(Exception, match="no resolution"):
        cn.standardize(px, res, 1700).collect()
    models = cn.contact_models(merged, spark.createDataFrame([("chr1", 60, 0)], "chrom string, bins long, first long"), 1000)
    fit = models.fits.first()
    assert -1.4 < fit.gamma < -0.4 and models.atlas.first().scale == pytest.approx(fit.scale) and models.pixels.count() == len(want)
    small = merged.select("context", "bin1", "bin2", "count")
    one, two = ({r.bin: r.weight for r in cn.balance(small, limit=n).collect()} for n in (10**9, 0))
    assert set(one) == set(two) and all((one[b] is None) == (two[b] is None) and (one[b] is None or one[b] == pytest.approx(two[b], rel=1e-9)) for b in one)


def test_resolution(spark):
    a = spark.createDataFrame([("a", r) for r in (100, 200, 400, 800, 1600, 3200)] + [("b", r) for r in (100, 1000, 2000, 4000)] + [("c", 4000)], "source string, resolution long")
    assert {r.source: r.selected for r in cn.select_resolution(a, 5000).collect()} == {"a": 200, "b": 1000, "c": None}


def test_decay_counts_zeros_and_leaves_out_masked_bins(spark):
    w = spark.createDataFrame([("c", i, 1.0 if i < 3 else None) for i in range(4)], "chrom string, bin long, weight double")
    px = spark.createDataFrame([("c", 0, 1, 4), ("c", 2, 3, 9)], "chrom string, bin1 long, bin2 long, count long")
    got = cn.distance_decay(px, w).collect()
    assert [(r.offset, r.contact, r.pairs, r.mean_contact) for r in got] == [(1, 4.0, 2, 2.0)]


def test_power_law_fit(spark):
    d = spark.createDataFrame([(i, 7.0 * (i * 100.0) ** -0.8) for i in range(1, 40)], "offset long, mean_contact double")
    r = cn.fit_powerlaw(d, resolution=100).first()
    assert r.gamma == pytest.approx(-0.8) and r.scale == pytest.approx(7.0)
    m = cn.atlas_model(spark.createDataFrame([(-1.0, 1.0), (-0.5, 4.0)], "gamma double, scale double")).first()
    assert (m.gamma, m.scale) == (-0.75, pytest.approx(2.0))


def test_balancing_evens_out_marginals(spark):
    rng = np.random.default_rng(2)
    bias = rng.uniform(0.5, 2, 40)
    i, j = np.triu_indices(40)
    c = np.round(2000 * bias[i] * bias[j] / (1 + j - i))
    bins, w, ok = cn.balance_one(i, j, c)
    use = j - i >= 2
    m = np.bincount(i[use], (c * w[i] * w[j])[use], 40) + np.bincount(j[use], (c * w[i] * w[j])[use], 40)
    assert ok and m == pytest.approx(np.ones(40), abs=0.02)
    c[(i == 5) | (j == 5)] = 0
    keep = c > 0
    _, w, _ = cn.balance_one(i[keep], j[keep], c[keep])
    assert len(w) == 39 and np.isfinite(w).all()
    assert cn.balance_one(np.array([0, 0]), np.array([2, 3]), np.array([1, 1]))[2] is False


def test_large_balancing_gives_the_same_weights(spark):
    rng = np.random.default_rng(2)
    bias = rng.uniform(0.5, 2, 30)
    i, j = np.triu_indices(30)
    rows = [(g, int(a), int(b), int(c)) for g in ("x", "y") for a, b, c in zip(i, j, np.round(2000 * bias[i] * bias[j] / (1 + j - i)), strict=True) if not (g == "y" and 7 in (a, b) and (a + b) % 3)]
    px = spark.createDataFrame(rows, "context string, bin1 long, bin2 long, count long")
    few = {"min_nnz": 8}
    want = {(r.context, r.bin): (r.weight, r.converged) for r in cn.ice_balance(px, **few).collect()}
    got = {(r.context, r.bin): (r.weight, r.converged) for r in cn.ice_balance_large(px, steps=60, **few).collect()}
    assert got.keys() == want.keys()
    for k, (w, ok) in want.items():
        assert got[k][1] == ok and (w is None) == (got[k][0] is None) and (w is None or abs(got[k][0] - w) < 1e-6 * abs(w)), k


def test_lookup_reads_missing_pixels_as_zero_and_masked_ones_as_masked(spark):
    px = spark.createDataFrame([("c", 0, 1, 2.0), ("c", 1, 3, float("nan")), ("c", 3, 4, float("nan")), ("c", 2, 3, float("nan"))], "chrom string, bin1 long, bin2 long, value double")
    q = spark.createDataFrame([(1, "c", 50, 150, 1.0), (2, "c", 150, 350, 1.0), (3, "c", 50, 480, 0.0), (4, "c", 20, 30, 2.0), (5, "c", 320, 330, 1.0), (6, "c", 10, 900, 1.0), (7, "x", 1, 2, 1.0)], "k int, chrom string, pos1 long, pos2 long, expected double")
    out = {r.k: r for r in cn.contact_lookup(q, px, spark.createDataFrame([("c", 5)], "chrom string, bins long"), 100, 0.5).collect()}
    assert [out[k].status for k in range(1, 8)] == ["observed_matrix_pixel", "unbalanced_or_masked_bin", "observed_matrix_pixel", "adjacent_bin_proxy", "unbalanced_or_masked_adjacent_bins", "position_outside_matrix", "chromosome_absent_from_matrix"]
    assert (out[1].observed, out[1].weight, out[1].observed_over_expected) == (2.0, 2.5, 2.0) and (out[3].observed, out[3].observed_over_expected) == (0.0, None)
    assert out[4].observed == 2.0 and out[2].weight == 0.5 and math.isclose(out[4].weight, 3.0)


def test_merged_replicates(spark):
    one = spark.createDataFrame([("c", a, b, 1) for a in range(20) for b in range(a, 20)], "chrom string, bin1 long, bin2 long, count long")
    assert cn.coarsen_merge(one.union(one), 1).agg(F.min("count")).first()[0] == 2
    assert {(r.bin1, r.bin2): r["count"] for r in cn.coarsen_merge(one, 10).collect()} == {(0, 0): 55, (0, 1): 100, (1, 1): 55}


def test_lookup_spreads_pairs_of_one_pixel(spark, monkeypatch):
    from genoframe.operators import contacts as cn

    nan = float("nan")
    px = spark.createDataFrame([("c", 0, 1, 2.0), ("c", 1, 2, 3.5), ("c", 1, 4, 1.25), ("c", 2, 3, nan), ("c", 3, 4, nan), ("c", 2, 2, 9.0)], "chrom string, bin1 long, bin2 long, value double")
    at = [(c, 100 * i + 1, 100 * j + 2, 0.5) for c in "cx" for i in range(6) for j in range(6)]
    pairs, shape = spark.createDataFrame(at, "chrom string, pos1 long, pos2 long, expected double"), spark.createDataFrame([("c", 5)], "chrom string, bins long")
    out = cn.contact_lookup(pairs, px, shape, 100)
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(str, out.collect()))
    monkeypatch.setattr(cn, "SMALL", 0)
    assert got == sorted(map(str, cn.contact_lookup(pairs, px, shape, 100).collect()))
    by = {(r.chrom, r.pos1 // 100, r.pos2 // 100): (r.status, r.observed) for r in out.collect()}
    assert by["c", 1, 1] == ("adjacent_bin_proxy", 3.5) and by["c", 3, 3] == ("unbalanced_or_masked_adjacent_bins", None) and by["c", 2, 3] == ("unbalanced_or_masked_bin", None)
    assert by["c", 4, 1] == ("observed_matrix_pixel", 1.25) and by["c", 0, 4] == ("observed_matrix_pixel", 0.0) and by["c", 5, 0][0] == "position_outside_matrix" and by["x", 0, 0][0] == "chromosome_absent_from_matrix"
