"""Queries on peak calling and strand statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import peaks as pk, refine as rf
from ..operators.contacts import settled
from . import adapters as a
from .book import query
from .interval_queries import UNION, spans

def track(spark, d):
    return pk.qpois_track(a.tags(spark, d), a.sizes(spark), by=("assay",))


def _changes(source: str, column: str, width: int) -> str:
    left = width // 2
    shown = {c: ("v" if c == column else "0") for c in ("k", "w1", "w10")}
    values = ", ".join(f"{v} AS {c}" for c, v in shown.items())
    return f"SELECT assay, chrom, xp, {values} FROM (SELECT assay, chrom, unnest([greatest(pos - {left}, 0), least(pos - {left} + {width}, size)]) AS xp, unnest([1, -1]) AS v FROM {source} JOIN sizes USING (chrom) WHERE greatest(pos - {left}, 0) < least(pos - {left} + {width}, size))"


#: The track as steps; the tail is summed from its largest term.
TRACK = f"""{a.TAGS}, {a.SIZES}, ch AS (SELECT assay, chrom, xp, sum(k) AS k, sum(w1) AS w1, sum(w10) AS w10 FROM ({_changes('tags', 'k', 150)} UNION ALL {_changes('tags', 'w1', 1000)} UNION ALL {_changes('tags', 'w10', 10_000)}) GROUP BY 1, 2, 3),
lv AS (SELECT assay, chrom, xp AS s, lead(xp) OVER w AS e, sum(k) OVER w AS k, sum(w1) OVER w AS w1, sum(w10) OVER w AS w10 FROM ch WINDOW w AS (PARTITION BY assay, chrom ORDER BY xp)), tot AS (SELECT assay, count(*) AS n, (SELECT sum(size) FROM sizes) AS genome FROM tags GROUP BY 1),
st AS (SELECT assay, chrom, s, e, CAST(k AS BIGINT) AS k, greatest(n * 150.0::DOUBLE / genome, w1 * 150::DOUBLE / 1000, w10 * 150::DOUBLE / 10000) AS m FROM lv JOIN tot USING (assay) WHERE e IS NOT NULL AND (k <> 0 OR w1 <> 0 OR w10 <> 0)),
pr AS (SELECT assay, k, m, sum(e - s) AS bases, CASE WHEN m < k + 2 THEN least(-m + (k + 1) * ln(m) - lgamma(k + 2) + ln(list_sum(list_transform(range(0, 30 + CAST(ceil(10 * sqrt(k + m)) AS BIGINT)), lambda i: exp(i * ln(m) - lgamma(k + 2 + i) + lgamma(k + 2))))), 0)
    ELSE ln(1 - least(exp(-m) * list_sum(list_transform(range(0, k + 1), lambda i: exp(i * ln(m) - lgamma(i + 1)))), 1)) END AS lp FROM st WHERE k > 0 GROUP BY assay, k, m),
sc AS (SELECT *, round(-lp / ln(10), 5) AS p FROM pr), ps AS (SELECT assay, p, sum(bases) AS n FROM sc GROUP BY 1, 2), rk AS (SELECT assay, p, p + log10(1 + coalesce(sum(ps.n) OVER (PARTITION BY assay ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) - log10(genome) AS raw FROM ps JOIN tot USING (assay)),
qs AS (SELECT assay, p, greatest(min(raw) OVER (PARTITION BY assay ORDER BY p DESC), 0) AS q FROM rk), tr AS (SELECT st.assay, st.chrom, st.s, st.e, st.k, st.m, coalesce(sc.p, 0) AS p, coalesce(qs.q, 0) AS q FROM st LEFT JOIN sc ON sc.assay = st.assay AND sc.k = st.k AND sc.m = st.m LEFT JOIN qs ON qs.assay = sc.assay AND qs.p = sc.p)"""


@query("qpois_track", f"WITH {TRACK} SELECT assay, chrom, s, e, k AS pileup, round(m, 6) AS expected, p AS p_score, round(q, 6) AS q_score FROM tr")
def qpois(spark, d):
    return spans(track(spark, d)).withColumns({"expected": F.round("expected", 6), "q_score": F.round("q_score", 6)})


def _runs(cutoff: str, gap: int) -> str:
    return UNION.format(t=f"(SELECT assay, chrom AS c0, assay || chr(47) || chrom AS chrom, s, e, k AS k_, m, p, q FROM tr WHERE q > {cutoff})", gap=gap)


@query("peak_calls", f"""WITH {TRACK}, {_runs('-log10(0.05)', 50)}, pk AS (SELECT chrom AS key, s, e FROM merged WHERE e - s >= 150), x AS (SELECT pk.s AS ps, pk.e AS pe, t.* FROM pk JOIN tr t ON pk.key = t.assay || chr(47) || t.chrom AND pk.s <= t.s AND t.e <= pk.e AND t.q > -log10(0.05)),
b AS (SELECT *, row_number() OVER (PARTITION BY assay, chrom, ps ORDER BY s) AS i, count(*) OVER (PARTITION BY assay, chrom, ps) AS n FROM (SELECT *, max(k) OVER (PARTITION BY assay, chrom, ps) AS top FROM x) WHERE k = top)
SELECT assay, chrom, ps AS s, pe AS e, (s + e) // 2 AS summit, k AS pileup, round((k + 1) / (m + 1), 6) AS fold, p AS p_score, round(q, 6) AS q_score FROM b WHERE i = (n + 1) // 2""")
def peaks(spark, d):
    out = pk.peak_calls(track(spark, d), by=("assay",))
    return spans(out).drop("score").withColumns({"fold": F.round("fold", 6), "q_score": F.round("q_score", 6)})


@query("refined_peaks")
def refined(spark, d):
    """Peaks split along their q-scores; iterative, so held against a plain version in the tests."""
    steps = settled(track(spark, d).where("assay = 'atac'"))
    calls = pk.peak_calls(steps, by=("assay",)).select("chrom", "start", "end", F.col("start").alias("candidate_id"))
    return rf.refine_peaks(calls, steps.select("chrom", "start", "end", F.col("q_score").alias("score")))


@query("strand_cross_correlation", f"""WITH {a.TAGS}, {a.SIZES}, c AS (SELECT assay, chrom, pos, strand, count(*) AS c FROM tags JOIN sizes USING (chrom) GROUP BY 1, 2, 3, 4), sm AS (SELECT assay, coalesce(sum(c) FILTER (WHERE strand = '+'), 0) AS pc, coalesce(sum(c * c) FILTER (WHERE strand = '+'), 0) AS pcc, coalesce(sum(c) FILTER (WHERE strand = '-'), 0) AS mc, coalesce(sum(c * c) FILTER (WHERE strand = '-'), 0) AS mcc, (SELECT CAST(sum(size) AS DOUBLE) FROM sizes) AS n FROM c GROUP BY 1),
pm AS (SELECT x.assay, y.pos - x.pos AS shift, sum(x.c * y.c) AS pm FROM c x JOIN c y ON x.assay = y.assay AND x.chrom = y.chrom AND x.strand = '+' AND y.strand = '-' AND y.pos BETWEEN x.pos AND x.pos + 200 GROUP BY 1, 2)
SELECT sm.assay, g.shift, round((n * coalesce(pm, 0) - pc * mc) / (sqrt(n * pcc - pc * pc) * sqrt(n * mcc - mc * mc)), 9) AS correlation FROM sm CROSS JOIN (SELECT unnest(range(0, 201)) AS shift) g LEFT JOIN pm ON pm.assay = sm.assay AND pm.shift = g.shift""")
def correlation(spark, d):
    return pk.cross_correlation(a.tags(spark, d), a.sizes(spark), by=("assay",), furthest=200).withColumn("correlation", F.round("correlation", 9))


@query("coverage_fingerprint", f"""WITH {a.TAGS}, {a.SIZES}, b AS (SELECT assay, chrom, pos // 500 AS bin, count(*) AS n FROM tags JOIN sizes USING (chrom) GROUP BY 1, 2, 3), h AS (SELECT assay, n, count(*) AS bins FROM b GROUP BY 1, 2),
f AS (SELECT * FROM h UNION ALL SELECT assay, 0, (SELECT sum((size + 499) // 500) FROM sizes) - sum(bins) FROM h GROUP BY 1)
SELECT assay, n, CAST(bins AS BIGINT) AS bins, round(sum(bins) OVER w / sum(bins) OVER (PARTITION BY assay), 9) AS bin_share, round(sum(n * bins) OVER w / sum(n * bins) OVER (PARTITION BY assay), 9) AS point_share FROM f WINDOW w AS (PARTITION BY assay ORDER BY n)""")
def fingerprint(spark, d):
    out = pk.coverage_fingerprint(a.tags(spark, d), a.sizes(spark), by=("assay",))
    return out.withColumns({c: F.round(c, 9) for c in ("bin_share", "point_share")})
