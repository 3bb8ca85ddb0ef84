"""Peak calling against per-base versions in plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from genoframe.operators import peaks as pk

SIZES = {"chr1": 4000, "chr2": 2500}


def log_tail(k, m):
    """-log10 P(X > k), by exact-enough summation of logarithms."""
    terms = [i * math.log(m) - m - math.lgamma(i + 1) for i in range(k + 1, k + 1 + 40 + int(20 * math.sqrt(k + m)) + int(m))]
    top = max(terms)
    return -(top + math.log(sum(math.exp(t - top) for t in terms))) / math.log(10)


@pytest.fixture(scope="module")
def points():
    rng = random.Random(4)
    out = []
    for library in ("a", "b"):
        for chrom, size in SIZES.items():
            out += [(library, chrom, rng.randrange(size), rng.choice("+-")) for _ in range(60)]
            for centre in (700, 705, 1500, 2400):
                out += [(library, chrom, min(size - 1, max(0, int(rng.gauss(centre, 40)))), rng.choice("+-")) for _ in range(30 if library == "a" else 12)]
    return [*out, ("a", "chrX", 5, "+"), ("b", "chr1", 0, "+"), ("b", "chr2", 2499, "-")]


@pytest.fixture(scope="module")
def tables(spark, points):
    sizes = spark.createDataFrame([(c, s) for c, s in SIZES.items()], "chrom string, size long")
    return spark.createDataFrame(points, "library string, chrom string, pos long, strand string").repartition(3), sizes


def per_base(points, extend=150, windows=(1000, 10_000), control=None):
    """{library: {(chrom, base): (pileup, expected, p, q)}}"""
    out = {}
    for library in {p[0] for p in points}:
        mine = [p for p in points if p[0] == library and p[1] in SIZES]
        source = mine if control is None else [p for p in control if p[0] == library and p[1] in SIZES]
        genome, scale = sum(SIZES.values()), len(mine) / len(source)
        spans = windows if control is None else (extend, *windows)
        cover = {}
        for name, width, rows in [("k", extend, mine), *[(w, w, source) for w in spans]]:
            cover[name] = Counter()
            for _, chrom, pos, _ in rows:
                for x in range(max(0, pos - width // 2), min(SIZES[chrom], pos - width // 2 + width)):
                    cover[name][chrom, x] += 1
        base = {}
        for chrom, size in SIZES.items():
            for x in range(size):
                k = cover["k"][chrom, x]
                m = max([len(mine) * extend / genome] + [cover[w][chrom, x] * extend * scale / w for w in spans])
                base[chrom, x] = (k, m, round(log_tail(k, m), 5) if k else 0.0)
        counts = Counter(p for k, _, p in base.values() if k)
        q, before, low = {}, 0, math.inf
        for p in sorted(counts, reverse=True):
            low = min(low, p + math.log10(1 + before) - math.log10(genome))
            q[p], before = max(low, 0.0), before + counts[p]
        out[library] = {at: (k, m, p, q[p] if k else 0.0) for at, (k, m, p) in base.items()}
    return out


def spread(track):
    out = defaultdict(dict)
    for r in track.collect():
        for x in range(r.start, r.end):
            assert (r.chrom, x) not in out[r.library]
            out[r.library][r.chrom, x] = (r.pileup, r.expected, r.p_score, r.q_score)
    return out


def agree(got, want):
    assert set(got) == set(want)
    for library, bases in want.items():
        for at, (k, m, p, q) in bases.items():
            if at in got[library]:
                assert got[library][at] == pytest.approx((k, m, p, q), abs=3e-5), (library, at)
            else:
                assert k == 0


@pytest.mark.parametrize("tile", [256, 1 << 20])
def test_track_equals_single_bases(tables, points, tile):
    agree(spread(pk.qpois_track(*tables, tile=tile)), per_base(points))


def test_track_with_a_control(spark, tables, points):
    rng = random.Random(6)
    control = [(library, c, rng.randrange(s), "+") for library in ("a", "b") for c, s in SIZES.items() for _ in range(90)]
    df = spark.createDataFrame(control, "library string, chrom string, pos long, strand string")
    agree(spread(pk.qpois_track(*tables, control=df, windows=(500,))), per_base(points, windows=(500,), control=control))


def test_tails(spark):
    rows = [(k, m) for k in (0, 1, 5, 19, 20, 21, 150, 3000) for m in (0.01, 0.5, 3.0, 20.5, 160.0, 2900.0)]
    got = spark.createDataFrame(rows, "k long, m double").select("k", "m", pk.poisson_log_tail("k", "m").alias("t")).collect()
    for r in got:
        assert -r.t / math.log(10) == pytest.approx(log_tail(r.k, r.m), rel=1e-8, abs=1e-9), (r.k, r.m)
    assert spark.range(1).select(pk.poisson_log_tail(F.lit(3), F.lit(0.0)).alias("t")).first().t is None


def plain_peaks(bases, cutoff, gap, shortest):
    out = []
    for chrom, size in SIZES.items():
        runs = []
        for x in range(size):
            if bases[chrom, x][3] > cutoff:
                if runs and x - runs[-1][1] <= gap:
                    runs[-1][1] = x + 1
                else:
                    runs.append([x, x + 1])
        out += [(chrom, a, b, max(bases[chrom, x][0] for x in range(a, b) if bases[chrom, x][3] > cutoff)) for a, b in runs if b - a >= shortest]
    return out


def test_peaks(tables, points):
    track, want = pk.qpois_track(*tables).persist(), per_base(points)
    got = pk.peak_calls(track, q=0.01, gap=30, shortest=100).collect()
    cut = -math.log10(0.01)
    assert sorted((r.library, r.chrom, r.start, r.end, r.pileup) for r in got) == sorted((lib, *p) for lib, b in want.items() for p in plain_peaks(b, cut, 30, 100))
    assert len({r.chrom for r in got if r.library == "a"}) == 2
    for r in got:
        k, m, p, q = want[r.library][r.chrom, r.summit]
        assert (k, p, q) == pytest.approx((r.pileup, r.p_score, r.q_score), abs=3e-5) and r.fold == pytest.approx((k + 1) / (m + 1)) and r.score == min(1000, int(q * 10 + 1e-9))
    wide = pk.broad_peaks(track, q=0.01, broad_q=0.2, gap=30, shortest=100).collect()
    assert sorted((r.library, r.chrom, r.start, r.end) for r in wide) == sorted((lib, *p[:3]) for lib, b in want.items() for p in plain_peaks(b, -math.log10(0.2), 120, 100))
    assert sum(r.narrow_n for r in wide) == len(got)
    totals = tables[0].groupBy("library").agg(F.count("*").alias("n"))
    one, two = (t.agg(F.sum("pileup")).first()[0] for t in (track.where("library = 'b'"), pk.per_million(track, totals).where("library = 'b'")))
    assert two == pytest.approx(one * 1e6 / totals.where("library = 'b'").first().n)


def test_cross_correlation(tables, points):
    got = {(r.library, r.shift): r.correlation for r in pk.cross_correlation(*tables, furthest=40).collect()}
    for library in ("a", "b"):
        strand = {s: Counter((c, x) for lib, c, x, t in points if lib == library and t == s and c in SIZES) for s in "+-"}
        n = sum(SIZES.values())
        mean = {s: sum(v.values()) / n for s, v in strand.items()}
        sd = {s: math.sqrt(sum(c * c for c in v.values()) / n - mean[s] ** 2) for s, v in strand.items()}
        for d in (0, 1, 17, 40):
            both = sum(c * strand["-"][chrom, x + d] for (chrom, x), c in strand["+"].items()) / n
            assert got[library, d] == pytest.approx((both - mean["+"] * mean["-"]) / (sd["+"] * sd["-"]), abs=1e-9)
    best = pk.correlation_summary(pk.cross_correlation(*tables, furthest=40), 10).collect()
    assert {r.library: r.fragment_length for r in best} == {lib: min((-got[lib, d], d) for d in range(41))[1] for lib in ("a", "b")}


def test_fingerprint(tables, points):
    got = pk.coverage_fingerprint(*tables, width=300).orderBy("library", "n").collect()
    for library in ("a", "b"):
        bins = Counter((c, x // 300) for lib, c, x, _ in points if lib == library and c in SIZES)
        counts = sorted([*bins.values(), *[0] * (sum(-(-s // 300) for s in SIZES.values()) - len(bins))])
        for r in (r for r in got if r.library == library):
            assert r.bins == counts.count(r.n) and r.bin_share == pytest.approx(sum(c <= r.n for c in counts) / len(counts)) and r.point_share == pytest.approx(sum(c for c in counts if c <= r.n) / sum(counts))
        assert sum(r.bins for r in got if r.library == library) == len(counts)


def test_empty(spark, tables):
    none = tables[0].where("false")
    assert pk.qpois_track(none, tables[1]).count() == 0 and pk.cross_correlation(none, tables[1]).count() == 0 and pk.coverage_fingerprint(none, tables[1]).count() == 0
