import math

import numpy as np
import pytest
from genoframe.functions import columns as cl
from genoframe.operators import catalog as ct, quantify as qt
from pyspark.sql import functions as F


def test_cpm(spark):
    one = spark.createDataFrame([(31, 1_000_000, 31)], "raw long, total long, width long")
    assert one.select(cl.cpm_per_kb("raw", "total", "width")).first()[0] == 1000.0
    for bad in ((1, 0, 31), (1, 10, 0)):
        with pytest.raises(Exception, match="positive"):
            spark.createDataFrame([bad], "raw long, total long, width long").select(cl.cpm_per_kb("raw", "total", "width")).collect()


def test_classes_states_and_tiers(spark):
    d = spark.createDataFrame([(500,), (501,), (1000,), (1001,), (None,)], "d long")
    assert [r[0] for r in d.select(cl.distance_class("d")).collect()] == ["promoter_associated", "proximal_enhancer_like", "proximal_enhancer_like", "distal_enhancer_like", "unclassified_no_tss_on_contig"]
    s = spark.createDataFrame([(False, 1.0, 0.9), (True, 0.0, None), (True, 1.0, None), (True, 1.0, 0.5), (True, 1.0, 0.49)], "m boolean, s double, p double")
    assert [r[0] for r in s.select(cl.activity_state("m", "s", "p")).collect()] == ["inactive_in_context", "accessible_no_h3k27ac_signal", "mixture_unavailable", "active_high_mixture", "low_h3k27ac_mixture"]
    z = ct.log_zscores(spark.createDataFrame([("c", x) for x in (0.0, 1.0, 10.0, 100.0)], "context string, signal double")).orderBy("signal").collect()
    assert z[0].tier == "no_h3k27ac_signal" and z[0].z is None and z[3].z == pytest.approx(1 / np.std([0, 1, 2])) and z[3].tier == "moderate_z_gt_1"


def test_replicates(spark):
    rows = [(1, "c", "atac", "b", 4, 10, 2.0), (1, "c", "atac", "a", 2, 20, 4.0), (1, "c", "h3k27ac", "x", 1, 5, 4.0)]
    s = spark.createDataFrame(rows, "id long, context string, assay string, library string, raw_count long, total_units long, cpm_per_kb double")
    out = {r.assay: r for r in qt.replicate_aggregate(s).collect()}
    assert (out["atac"].library_ids, out["atac"].mean_value, out["atac"].raw_count, out["atac"].total_units) == ("a,b", 3.0, 6, 30)
    assert out["atac"].sd_value == pytest.approx(math.sqrt(2)) and out["h3k27ac"].sd_value == 0.0
    assert qt.assay_pivot(qt.replicate_aggregate(s)).first().activity == pytest.approx(math.sqrt(12))


def tmm(counts, sizes):
    """The published method in numpy."""
    y = counts[:, counts.sum(0) > 0].astype(float)
    q = np.array([np.quantile(y[i] / sizes[i], 0.75) for i in range(len(y))])
    ref = int(np.argmin(np.abs(q - q.mean())))
    out = []
    for i in range(len(y)):
        ok = (y[i] > 0) & (y[ref] > 0)
        a, b = y[i][ok], y[ref][ok]
        m, e = np.log2((a / sizes[i]) / (b / sizes[ref])), (np.log2(a / sizes[i]) + np.log2(b / sizes[ref])) / 2
        v = (sizes[i] - a) / sizes[i] / a + (sizes[ref] - b) / sizes[ref] / b
        rank = lambda x: np.array([(x < t).sum() + ((x == t).sum() + 1) / 2 for t in x])
        n = len(m)
        if np.abs(m).max() < 1e-6:
            out.append(1.0)
            continue
        lo, la = math.floor(n * 0.3) + 1, math.floor(n * 0.05) + 1
        rm, ra = rank(np.round(m, 12)), rank(np.round(e, 12))
        keep = (rm >= lo) & (rm <= n + 1 - lo) & (ra >= la) & (ra <= n + 1 - la)
        out.append(2 ** ((m[keep] / v[keep]).sum() / (1 / v[keep]).sum()))
    out = np.array(out)
    return out / np.exp(np.log(out).mean())


def test_tmm(spark):
    rng = np.random.default_rng(3)
    base = rng.gamma(2, 20, 300)
    counts = np.stack([rng.poisson(base * f) for f in (1, 1.5, 0.7, 2)])
    counts[1, :40] *= 6
    sizes = counts.sum(1) * 2
    rows = [("atac", f"l{i}", int(sizes[i]), j, int(counts[i, j])) for i in range(4) for j in range(300)] + [("h3", f"m{i}", 1000, j, 5 + j) for i in range(2) for j in range(9)]
    got = {(r.assay, r.library): r.factor for r in qt.tmm_factors(spark.createDataFrame(rows, "assay string, library string, lib_size long, feature long, count long")).collect()}
    assert [got["atac", f"l{i}"] for i in range(4)] == pytest.approx(tmm(counts, sizes).tolist(), rel=1e-9)
    assert got["h3", "m0"] == got["h3", "m1"] == 1.0
    summary = qt.factor_summary(spark.createDataFrame([(*k, v) for k, v in got.items()], "assay string, library string, factor double")).collect()
    assert all(r.factor_product == pytest.approx(1) for r in summary)


def test_window_ties_prefer_center_then_left(spark):
    rows = [(1, "c", "l", w, 500, 4, 1e6) for w in ("right_500", "left_500", "center_500")] + [(2, "c", "l", "right_500", 500, 4, 1e6), (2, "c", "l", "left_500", 500, 4, 1e6), (2, "c", "l", "center_500", 0, 0, 1e6)] + [(3, "c", "l", w, 0, 0, 1e6) for w in ("left_500", "center_500")]
    out = {r.id: r for r in ct.window_signal(spark.createDataFrame(rows, "id long, context string, library string, window string, width_bp long, raw_count long, effective double")).collect()}
    assert (out[1].max_window, out[2].max_window, out[3].max_window) == ("center_500", "left_500", None) and out[1].max_signal == 8.0 and out[3].max_signal is None


def test_mixtures(spark):
    rng = np.random.default_rng(1)
    two = np.concatenate([rng.normal(-1.5, 0.18, 300), rng.normal(1.2, 0.22, 300)])
    got = ct.guarded_mixture(two)
    assert got["mixture_supported"] and got["delta_bic"] > 10 and got["ashman_d"] > 2 and got["low_mean"] < got["posterior_crossing"] < got["high_mean"]
    one = ct.guarded_mixture(rng.normal(0, 1, 1000))
    assert not one["mixture_supported"] and one["low_mean"] is not None and one["support_reason"]
    assert ct.guarded_mixture(np.ones(500))["support_reason"] == "zero_variance" and ct.guarded_mixture(np.ones(50))["support_reason"] == "insufficient_positive_members"
    df = spark.createDataFrame([("a", float(v)) for v in two], "context string, log10_signal double")
    fit = ct.fit_mixtures(df)
    row = fit.first()
    assert row.low_mean == pytest.approx(got["low_mean"]) and row.high_weight == pytest.approx(0.5, abs=0.02)
    post = df.join(fit, "context").select("log10_signal", ct.posterior().alias("p")).collect()
    assert all((r.p >= 0.5) == (r.log10_signal >= row.posterior_crossing) for r in post)


def test_mixtures_over_all_tasks(spark):
    """Steps as aggregations give what a task that holds the context gives."""
    rng = np.random.default_rng(5)
    draws = {
        "two": np.concatenate([rng.normal(-1, 0.3, 900), rng.normal(1, 0.3, 1100)]),
        "ties": np.round(np.concatenate([rng.normal(0, 0.5, 700), rng.normal(2.5, 0.4, 500)]), 1),
        "uneven": np.concatenate([rng.normal(0, 0.2, 1500), rng.normal(3, 0.2, 40), [np.nan, np.inf, -np.inf]]),
        "few": rng.normal(0, 1, 150),
        "flat": np.full(300, 2.0),
        "empty": np.array([np.nan, np.inf]),
        None: np.concatenate([rng.normal(-2, 0.3, 300), rng.normal(2, 0.6, 300)]),
    }
    df = spark.createDataFrame([(k, float(v)) for k, x in draws.items() for v in x] + [("two", None)], "context string, log10_signal double").repartition(5)
    want = {k: ct.guarded_mixture(x) for k, x in draws.items()}
    for limit in (0, 400):  # all contexts, then the larger ones beside the others
        got = {r.context: r.asDict() for r in ct.fit_mixtures(df, limit=limit).collect()}
        assert got.keys() == want.keys()
        for k, row in want.items():
            assert got[k]["positive_member_n"] == row["positive_member_n"]
            for c in row.keys() - {"context"}:
                assert got[k][c] == (row[c] if row[c] is None or isinstance(row[c], str | bool) else pytest.approx(row[c], rel=1e-6, abs=1e-6)), (limit, k, c)


def test_crossing_and_blocks():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 0.5, 400), rng.normal(3, 1.0, 300)])
    likelihood, fit = ct.fit_two(x)
    at = fit.crossing()
    assert abs(float(fit.log_odds(np.array([at]))[0])) < 1e-6 and fit.mean[0] < at < fit.mean[1]
    one, two = fit.expectation(x, 1 << 16), fit.expectation(x, 7)
    assert one[0] == pytest.approx(two[0]) and np.allclose(one[1], two[1])
    assert ct.Mixture((0.5, 0.5), (0.0, 2.0), (1.0, 1.0)).crossing() == pytest.approx(1.0)
    assert ct.Mixture((0.999999, 0.000001), (0.0, 0.1), (1.0, 1.0)).crossing() is None and ct.Mixture((0.5, 0.5), (1.0, 1.0), (1.0, 2.0)).crossing() is None


def test_component_densities(spark):
    mix = spark.createDataFrame([("a", 0.4, 0.6, 0.0, 2.0, 1.0, 0.25), ("b", None, None, None, None, None, None)], "context string, low_weight double, high_weight double, low_mean double, high_mean double, low_variance double, high_variance double")
    out = ct.component_densities(mix, spark.createDataFrame([("a", -6.0, 8.0), ("b", 0.0, 1.0)], "context string, lower double, upper double"), points=1401).collect()
    assert {r.context for r in out} == {"a"} and sum(r.total for r in out) * 0.01 == pytest.approx(1.0, abs=1e-6) and sum(r.low for r in out) * 0.01 == pytest.approx(0.4, abs=1e-6)


def test_strict_join(spark):
    a, b = (spark.createDataFrame([(k, k) for k in ks], f"k int, {c} int") for ks, c in (((1, 2), "x"), ((1, 2), "y")))
    assert qt.strict_join(a, b, ["k"]).count() == 2
    with pytest.raises(Exception, match="different or repeated"):
        qt.strict_join(a, b.where("k = 1"), ["k"]).count()
    with pytest.raises(Exception, match="different or repeated"):
        qt.strict_join(a, b.union(b.where("k = 1")), ["k"]).count()


def test_rounding_rules(spark):
    x = spark.createDataFrame([(1.23456789012345, 0.0025), (123456789.876, None)], "v double, p double")
    got = [tuple(r) for r in x.select(cl.sig10("v"), cl.bed9_score("p")).collect()]
    assert got == [(1.23456789, 2), (123456789.9, 0)]


def test_posterior_is_null_without_a_fit(spark):
    from genoframe.operators.catalog import posterior

    rows = [(1.0, 0.5, 0.0, 1.0, 0.5, 2.0, 1.0), (1.0, None, None, None, None, None, None), (None, 0.5, 0.0, 1.0, 0.5, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "log10_signal double, low_weight double, low_mean double, low_variance double, high_weight double, high_mean double, high_variance double")
    assert [r.p for r in df.select(posterior().alias("p")).collect()] == [0.5, None, None]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_zscores_join_no_group_in_one_task(spark):
    from genoframe.operators.catalog import log_zscores

    x = spark.createDataFrame([("c", 1.0), ("c", 100.0), ("d", 5.0), ("d", 0.0)], "context string, signal double")
    out = log_zscores(x)
    assert "SortMergeJoin" not in _plan(out)
    assert sorted((r.signal, r.z) for r in out.collect() if r.context == "c") == [(1.0, -1.0), (100.0, 1.0)]


def test_background_deals_no_assay_to_one_task(spark):
    import re

    from genoframe.operators.quantify import background_counts, tmm_factors

    u = spark.createDataFrame([("x", f"l{i % 2}", "c", 10 * i, 10 * i + 5) for i in range(40)], "assay string, library string, chrom string, start long, end long")
    out = background_counts(u, spark.createDataFrame([("c", 1000)], "chrom string, size long"), 100)
    assert not re.search(r"hashpartitioning\(assay#\d+, \d+\)", _plan(out).split("AdaptiveSparkPlan", 1)[-1].replace("Window", "")) and out.count() == 8
    joins = re.findall(r"SortMergeJoin \[assay#\d+, library#\d+\],", _plan(tmm_factors(out)))
    assert len(joins) <= 1  # the factors' own table, a row a library


def test_elements_beyond_their_chromosome_have_no_largest_window(spark, tmp_path):
    import __spark_entry__ as entry
    import duckdb

    d, c = str(tmp_path), duckdb.connect()
    spark.createDataFrame([(k, 5) for k in (3, 6, 3 * 40_000)], "p_partkey long, p_size int").write.parquet(f"{d}/part.parquet")
    lines = [(o, k, s, 1, 20.0, r, x) for o, k in enumerate((3, 6, 3, 3 * 40_000)) for s in range(4) for r, x in (("A", "F"), ("N", "O"))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(3, "s3", 1)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{d}/supplier.parquet")
    for t in ("part", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    want = sorted(c.execute(entry.oracle_sql()["window_argmax"]).fetchall())
    assert {r[0] for r in want} == {3, 6}
    assert sorted(tuple(r) for r in entry.queries()["window_argmax"](spark, d).collect()) == want
    for name in ("regulatory_catalog", "regulatory_wide"):
        assert {r.master_dhs_id for r in entry.queries()[name](spark, d).collect()} == {3, 6}


def test_catalog_without_activity(spark):
    """Queries that show no combined activity need not work one out."""
    signal = spark.createDataFrame([(1, "F", 10.0), (2, "F", 0.0)], "id long, context string, max_signal double")
    near = spark.createDataFrame([(1, 20), (2, 5000)], "id long, distance long")
    mixtures = spark.createDataFrame([("F", True, 0.5, 0.5, 0.0, 1.0, 0.1, 0.1)], "context string, mixture_supported boolean, low_weight double, high_weight double, low_mean double, high_mean double, low_variance double, high_variance double")
    got = ct.build_catalog(signal, signal.select("id", "context"), near, None, mixtures)
    assert "combined_activity" not in got.columns
    assert {r.id: (r.regulatory_class, r.state) for r in got.collect()} == {1: ("promoter_associated", "active_high_mixture"), 2: ("distal_enhancer_like", "accessible_no_h3k27ac_signal")}


def test_regulatory_tables_broadcast_no_rows_of_elements(spark, tmp_path, monkeypatch):
    """Files of a few MB hold millions of elements, so only tables of a row a chromosome, context or library may be broadcast by a file's size."""
    import re

    import __spark_entry__ as entry
    from genoframe.operators import intervals as iv

    d, plans, settled = str(tmp_path), [], ct.settled
    spark.range(600).selectExpr("id as p_partkey", "cast(id % 50 as int) as p_size").write.parquet(f"{d}/part.parquet")
    spark.range(4000).selectExpr("id div 4 as l_orderkey", "id % 600 as l_partkey", "id % 8 as l_suppkey", "cast(id % 4 as int) as l_linenumber", "20.0D as l_quantity", "if(id % 3 = 0, 'A', 'N') as l_returnflag", "if(id % 2 = 0, 'F', 'O') as l_linestatus").write.parquet(f"{d}/lineitem.parquet")
    spark.range(20).selectExpr("id as s_suppkey", "concat('s', id) as s_name", "cast(id % 7 as int) as s_nationkey").write.parquet(f"{d}/supplier.parquet")
    monkeypatch.setattr(ct, "settled", lambda df: (plans.append(_plan(df)), settled(df))[1])
    out = entry.queries()["regulatory_wide"](spark, d)
    plans.append(_plan(out))
    keys = {k for p in plans for on in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", p) for k in re.findall(r"(\w+)#\d+", on)}
    assert len(plans) == 5 and keys == {"chrom", "context"}
    assert all(p.count("CartesianProduct") == 0 for p in plans) and out.count() == 600
    near = iv.nearest(spark.read.parquet(f"{d}/part.parquet").selectExpr("p_partkey as id", "'chr0' as chrom", "p_partkey as pos"), spark.createDataFrame([("s", "chr0", 7)], "name string, chrom string, pos long"))
    assert "Broadcast" not in _plan(spark.range(600).join(near.select("id", "distance"), "id"))
