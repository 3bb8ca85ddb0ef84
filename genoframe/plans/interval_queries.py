"""Queries on interval algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import numbered
from ..operators import intervals as iv
from . import adapters as a
from .book import query

SPAN = ("start", "end")


def spans(df):
    """start and end under names that SQL does not reserve."""
    return df.withColumnRenamed("start", "s").withColumnRenamed("end", "e")


@query("interval_overlap_join", f"""WITH {a.ELEMENTS}, {a.UNITS}
SELECT u.unit_id, x.id, least(u.e, x.e) - greatest(u.s, x.s) AS overlap FROM units u JOIN elements x ON u.chrom = x.chrom AND u.s < x.e AND x.s < u.e""")
def overlap(spark, d):
    pairs = iv.overlap_join(a.units(spark, d), a.elements(spark, d), 256)
    return pairs.select("unit_id", F.col("b_id").alias("id"), (F.least("end", "b_end") - F.greatest("start", "b_start")).alias("overlap"))


@query("nested_overlap_join", f"""WITH {a.ELEMENTS}, spans AS (SELECT o_orderkey AS order_id, 'chr' || (o_custkey % 3) AS chrom, (o_orderkey * 37) % 80000 AS s, (o_orderkey * 37) % 80000 + CASE o_orderstatus WHEN 'P' THEN CAST(floor(o_totalprice / 50) AS BIGINT) ELSE 20 + o_custkey % 50 END AS e FROM orders)
SELECT order_id, x.id, least(o.e, x.e) - greatest(o.s, x.s) AS overlap FROM spans o JOIN elements x ON o.chrom = x.chrom AND o.s < x.e AND x.s < o.e""")
def nested(spark, d):
    at = "(o_orderkey * 37) % 80000"
    o = a.table(spark, d, "orders").selectExpr("o_orderkey as order_id", "concat('chr', o_custkey % 3) as chrom", f"{at} as start", f"{at} + case o_orderstatus when 'P' then cast(floor(o_totalprice / 50) as bigint) else 20 + o_custkey % 50 end as `end`")
    pairs = iv.nested_overlap_join(o, a.elements(spark, d), 256)
    return pairs.select("order_id", F.col("b_id").alias("id"), (F.least("end", "b_end") - F.greatest("start", "b_start")).alias("overlap"))


@query("interval_count", f"""WITH {a.ELEMENTS}, {a.UNITS}, t AS (SELECT count(*) AS total_units FROM units)
SELECT x.id, count(u.unit_id) AS raw_count, any_value(t.total_units) AS total_units FROM elements x CROSS JOIN t LEFT JOIN units u ON u.chrom = x.chrom AND u.s < x.e AND x.s < u.e GROUP BY x.id""")
def count(spark, d):
    u = a.units(spark, d)
    total = u.agg(F.count("*").alias("total_units"))
    return iv.count_overlaps(a.elements(spark, d), u, 256).join(F.broadcast(total))


def _windows(spark, d):
    return iv.summit_windows(a.elements(spark, d), a.sizes(spark))


WINDOWS = f"""{a.SIZES}, win AS (SELECT x.id, x.chrom, x.summit, w.w AS "window", greatest(least(x.summit + w.lo, z.size), 0) AS s, greatest(least(x.summit + w.hi, z.size), 0) AS e
FROM elements x JOIN sizes z USING (chrom), (VALUES ('left_500', -750, -250), ('center_500', -250, 250), ('right_500', 250, 750)) w(w, lo, hi))"""


@query("summit_windows", f"""WITH {a.ELEMENTS}, {WINDOWS} SELECT id, chrom, summit, "window", s, e, e - s AS width_bp FROM win""")
def windows(spark, d):
    return spans(_windows(spark, d))


@query("window_coverage_count", f"""WITH {a.ELEMENTS}, {a.UNITS}, {WINDOWS}
SELECT w.id, w."window", w.e - w.s AS width_bp, count(u.unit_id) AS raw_count FROM win w LEFT JOIN units u ON u.chrom = w.chrom AND u.s < w.e AND w.s < u.e AND w.s < w.e GROUP BY 1, 2, 3""")
def window_count(spark, d):
    w = _windows(spark, d).withColumn("key", F.concat_ws(":", "id", "window"))
    counts = iv.count_overlaps(w, a.units(spark, d), 512, key="key")
    return w.join(counts, "key").select("id", "window", "width_bp", "raw_count")


UNION = """r AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {t}),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM r),
merged AS (SELECT chrom, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY chrom, k)"""


@query("interval_union", f"WITH {a.SEGMENTS}, {UNION.format(t='segments', gap=0)} SELECT chrom, s, e, n FROM merged")
def union(spark, d):
    return spans(iv.interval_union(a.segments(spark, d)))


@query("gap_components", f"WITH {a.SEGMENTS}, {UNION.format(t='segments', gap=3600)} SELECT chrom, s, e, n FROM merged")
def components(spark, d):
    return spans(iv.interval_union(a.segments(spark, d), gap=3600))


_TARGETS = "targets AS (SELECT event_id AS id, chrom, s - 9000 AS s, s + 3000 AS e FROM segments)"


@query("covered_fraction", f"""WITH {a.SEGMENTS}, {_TARGETS}, {UNION.format(t='segments', gap=0)}
SELECT t.id, CAST(sum(CASE WHEN m.s IS NULL THEN 0 ELSE least(t.e, m.e) - greatest(t.s, m.s) END) AS BIGINT) AS covered_bp, round(sum(CASE WHEN m.s IS NULL THEN 0 ELSE least(t.e, m.e) - greatest(t.s, m.s) END) / 12000, 9) AS covered_fraction
FROM targets t LEFT JOIN merged m ON t.chrom = m.chrom AND t.s < m.e AND m.s < t.e GROUP BY t.id""")
def covered(spark, d):
    s = a.segments(spark, d)
    t = s.select(F.col("event_id").alias("id"), "chrom", (F.col("start") - 9000).alias("start"), (F.col("start") + 3000).alias("end"))
    out = iv.covered_bases(t, s, width=16384)
    return out.select("id", "covered_bp", F.round("covered_fraction", 9).alias("covered_fraction"))


@query("nearest_all_ties", f"""WITH {a.ELEMENTS}, {a.SITES}, p AS (SELECT chrom, pos - pos % 400 AS pos, name FROM sites), m AS (SELECT x.id, min(abs(x.summit - p.pos)) AS distance FROM elements x JOIN p USING (chrom) GROUP BY x.id)
SELECT x.id, m.distance, string_agg(DISTINCT p.name, ';' ORDER BY p.name) AS names FROM elements x JOIN m USING (id) JOIN p ON p.chrom = x.chrom AND abs(x.summit - p.pos) = m.distance GROUP BY x.id, m.distance""")
def nearest(spark, d):
    points = a.sites(spark, d).withColumn("pos", F.col("pos") - F.col("pos") % 400)
    found = iv.nearest(a.elements(spark, d).select("id", "chrom", F.col("summit").alias("pos")), points)
    return found.select("id", "distance", F.array_join("names", ";").alias("names"))


@query("band_join", f"""WITH {a.ELEMENTS}, {a.SITES} SELECT x.id, p.name, abs(x.summit - p.pos) AS distance FROM elements x JOIN sites p ON x.chrom = p.chrom AND abs(x.summit - p.pos) <= 5000""")
def band(spark, d):
    out = iv.band_join(a.elements(spark, d), a.sites(spark, d), 5000, "summit", "pos")
    return out.select("id", F.col("b_name").alias("name"), "distance")


@query("containment_join", f"""WITH {a.ELEMENTS}, {a.UNITS} SELECT u.unit_id, x.id FROM units u JOIN elements x ON u.chrom = x.chrom AND x.s <= u.s AND u.e <= x.e AND u.s < u.e""")
def containment(spark, d):
    return iv.containment_join(a.units(spark, d), a.elements(spark, d), 256).select("unit_id", F.col("b_id").alias("id"))


STEPS = """ev AS (SELECT chrom, s AS pos, {v} AS d FROM {t} UNION ALL SELECT chrom, e, -({v}) FROM {t}), ch AS (SELECT chrom, pos AS s, sum(d) AS d FROM ev GROUP BY chrom, pos),
lv AS (SELECT chrom, s, lead(s) OVER (PARTITION BY chrom ORDER BY s) AS e, sum(d) OVER (PARTITION BY chrom ORDER BY s) AS value FROM ch)"""


@query("mean_step_function", f"""WITH {a.SEGMENTS}, {STEPS.format(v='1 + event_id % 5', t='segments')} SELECT chrom, s, e, round(value / 3.0, 9) AS value FROM lv WHERE e IS NOT NULL AND value > 0""")
def mean_track(spark, d):
    x = a.segments(spark, d).withColumn("height", 1 + F.col("event_id") % 5)
    return spans(iv.mean_track(x, 3, "height")).withColumn("value", F.round("value", 9))


@query("coverage_bedgraph", f"""WITH {a.UNITS}, {STEPS.format(v='1', t='units')} SELECT chrom, s, e, CAST(value AS BIGINT) AS depth, round(value * 1e6 / (SELECT count(*) FROM units), 6) AS scaled FROM lv WHERE e IS NOT NULL AND value > 0""")
def coverage(spark, d):
    u = a.units(spark, d)
    total = u.agg(F.count("*").alias("total"))
    out = spans(iv.coverage(u)).join(F.broadcast(total))
    return out.select("chrom", "s", "e", F.col("value").alias("depth"), F.round(F.col("value") * 1e6 / F.col("total"), 6).alias("scaled"))


@query("pileup_events", f"""WITH {a.UNITS}, x AS (SELECT chrom, greatest(s - 75, 0) AS s, greatest(s - 75, 0) + 150 AS e FROM units WHERE assay = 'atac'), {STEPS.format(v='1', t='x')}
SELECT chrom, s, e, CAST(value AS BIGINT) AS depth FROM lv WHERE e IS NOT NULL AND value > 0""")
def pileup(spark, d):
    x = a.units(spark, d).where("assay = 'atac'").withColumn("start", F.greatest(F.col("start") - 75, F.lit(0)))
    return spans(iv.pileup(x, extend=150)).withColumnRenamed("value", "depth")


@query("step_function_align", f"""WITH {a.SEGMENTS}, ev AS (SELECT chrom, s AS pos, CASE WHEN replicate = 0 THEN 1 ELSE 0 END AS da, CASE WHEN replicate <> 0 THEN 1 ELSE 0 END AS db FROM segments
UNION ALL SELECT chrom, e, CASE WHEN replicate = 0 THEN -1 ELSE 0 END, CASE WHEN replicate <> 0 THEN -1 ELSE 0 END FROM segments), ch AS (SELECT chrom, pos AS s, sum(da) AS da, sum(db) AS db FROM ev GROUP BY 1, 2),
lv AS (SELECT chrom, s, lead(s) OVER w AS e, sum(da) OVER w AS a, sum(db) OVER w AS b FROM ch WINDOW w AS (PARTITION BY chrom ORDER BY s))
SELECT chrom, s, e, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b FROM lv WHERE e IS NOT NULL AND (a <> 0 OR b <> 0)""")
def align(spark, d):
    x = a.segments(spark, d).withColumn("value", F.lit(1.0))
    return spans(iv.align_steps(x.where("replicate = 0"), x.where("replicate <> 0")))


@query("centered_extend", f"""WITH {a.SITES}, {a.SIZES} SELECT name, chrom, pos, greatest(pos - 75, 0) AS s, least(pos + 75, size) AS e FROM sites JOIN sizes USING (chrom)""")
def extend(spark, d):
    return spans(iv.centered_extend(a.sites(spark, d), 150, a.sizes(spark))).select("name", "chrom", "pos", "s", "e")


_CLIP = f"""{a.UNITS}, x AS (SELECT chrom, s - 100 AS s, e - 100 AS e, CASE chrom WHEN 'chr0' THEN 30000 WHEN 'chr1' THEN 70000 ELSE 50000 END AS size FROM units)"""


@query("clip_with_stats", f"""WITH {_CLIP} SELECT count(*) AS records, count(*) FILTER (WHERE NOT (s >= size OR e <= 0)) AS written, count(*) FILTER (WHERE NOT (s >= size OR e <= 0) AND s < 0) AS clipped_left,
count(*) FILTER (WHERE NOT (s >= size OR e <= 0) AND e > size) AS clipped_right, count(*) FILTER (WHERE s >= size OR e <= 0) AS discarded, max(greatest(e - size, 0)) AS max_over_right FROM x""")
def clip(spark, d):
    small = spark.createDataFrame([("chr0", 30000), ("chr1", 70000), ("chr2", 50000)], "chrom string, size long")
    moved = a.units(spark, d).withColumn("start", F.col("start") - 100).withColumn("end", F.col("end") - 100)
    return iv.clip_stats(iv.clip(moved, small))


@query("reference_sort", f"""WITH {a.UNITS}, {a.SIZES} SELECT unit_id, row_number() OVER (PARTITION BY chrom ORDER BY s, e, unit_id) AS place, rank FROM units JOIN sizes USING (chrom)""")
def ordered(spark, d):
    return iv.reference_places(a.units(spark, d), a.sizes(spark), "unit_id").select("unit_id", "place", "rank")


@query("fixed_bins", f"""WITH {a.SIZES}, b AS (SELECT chrom, rank, k * 10000 AS s, least((k + 1) * 10000, size) AS e FROM (SELECT chrom, rank, size, unnest(range(0, (size + 9999) // 10000)) AS k FROM sizes))
SELECT 'BGBIN' || lpad(CAST(row_number() OVER (ORDER BY rank, s) AS VARCHAR), 7, '0') AS bin_id, chrom, s, e FROM b""")
def bins(spark, d):
    return spans(iv.fixed_bins(a.sizes(spark)))


@query("midpoint_bin_count", f"""WITH {a.SIZES}, {a.UNITS}, b AS (SELECT chrom, rank, k * 10000 AS s, least((k + 1) * 10000, size) AS e FROM (SELECT chrom, rank, size, unnest(range(0, (size + 9999) // 10000)) AS k FROM sizes)),
c AS (SELECT chrom, ((s + e) // 2) // 10000 * 10000 AS s, count(*) AS n FROM units GROUP BY 1, 2)
SELECT 'BGBIN' || lpad(CAST(row_number() OVER (ORDER BY rank, b.s) AS VARCHAR), 7, '0') AS bin_id, b.chrom, b.s, b.e, coalesce(c.n, 0) AS raw_count FROM b LEFT JOIN c ON b.chrom = c.chrom AND b.s = c.s""")
def midpoints(spark, d):
    return spans(iv.midpoint_counts(a.units(spark, d), iv.fixed_bins(a.sizes(spark))))


_CHECK = f"""{a.SEGMENTS}, x AS (SELECT event_id AS id, chrom, s, e, s + value AS summit FROM segments), y AS (SELECT *, lag(s) OVER w AS ps, max(e) OVER (PARTITION BY chrom ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM x WINDOW w AS (PARTITION BY chrom ORDER BY id))"""


@query("interval_validate", f"""WITH {_CHECK} SELECT id, 'unsorted' AS violation FROM y WHERE s < ps UNION ALL SELECT id, 'overlaps_previous' FROM y WHERE s < pe""")
def validate(spark, d):
    return iv.validate_intervals(a.segments(spark, d).withColumnRenamed("event_id", "id"))


@query("nonoverlap_check", f"""WITH {a.ELEMENTS}, y AS (SELECT id, s, e, summit, lag(e) OVER (PARTITION BY chrom ORDER BY s) AS pe FROM elements) SELECT count(*) AS elements, count(*) FILTER (WHERE s < pe) AS overlapping, count(*) FILTER (WHERE summit < s OR summit >= e) AS bad_summits FROM y""")
def nonoverlap(spark, d):
    x = a.elements(spark, d)
    v = iv.validate_intervals(x, sequence="start")
    counts = v.agg(F.count_if(F.col("violation") == "overlaps_previous").alias("overlapping"), F.count_if(F.col("violation") == "summit_outside").alias("bad_summits"))
    return x.agg(F.count("*").alias("elements")).join(F.broadcast(counts))


@query("registry_validate", f"""WITH {a.ELEMENTS}, z(chrom, size) AS (VALUES ('chr0', 20000), ('chr1', 30000)) SELECT x.id, 'unknown_chromosome' AS violation FROM elements x ANTI JOIN z USING (chrom) UNION ALL SELECT x.id, 'beyond_chromosome' FROM elements x JOIN z USING (chrom) WHERE x.e > z.size""")
def registry_validate(spark, d):
    small = spark.createDataFrame([("chr0", 20000), ("chr1", 30000)], "chrom string, size long")
    return iv.validate_intervals(a.elements(spark, d), small, sequence="start")


@query("plateau_summit", f"""WITH {a.ELEMENTS}, {a.UNITS}, {STEPS.format(v='1', t='units')}, sig AS (SELECT chrom, s, e, value FROM lv WHERE e IS NOT NULL AND value > 0),
h AS (SELECT x.id, x.chrom, greatest(x.s, g.s) AS s, least(x.e, g.e) AS e, (x.s + x.e - 1) // 2 AS mid, g.value FROM elements x JOIN sig g ON x.chrom = g.chrom AND x.s < g.e AND g.s < x.e),
t AS (SELECT * FROM (SELECT *, max(value) OVER (PARTITION BY id) AS top FROM h) WHERE value = top), r AS (SELECT *, max(e) OVER (PARTITION BY id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM t),
k AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY s) AS run FROM r), m AS (SELECT id, run, mid, top, min(s) AS s, max(e) AS e FROM k GROUP BY 1, 2, 3, 4),
b AS (SELECT id, (s + e - 1) // 2 AS summit, top, row_number() OVER (PARTITION BY id ORDER BY abs((s + e - 1) // 2 - mid), s) AS j FROM m)
SELECT x.id, coalesce(b.summit, (x.s + x.e - 1) // 2) AS summit, CAST(b.top AS DOUBLE) AS signal, b.id IS NULL AS fallback FROM elements x LEFT JOIN b ON b.id = x.id AND b.j = 1""")
def plateau(spark, d):
    return iv.plateau_summit(a.elements(spark, d), iv.coverage(a.units(spark, d)), 256).select("id", "summit", "signal", "fallback")


_WIDE = "m AS (SELECT id, chrom, summit, s - 60 - id % 50 AS s, e + 60 + id % 40 AS e FROM elements)"


@query("adjacent_clip", f"""WITH {a.ELEMENTS}, {_WIDE}, y AS (SELECT *, lag(summit) OVER w AS ps, lag(e) OVER w AS pe, lead(summit) OVER w AS ns, lead(s) OVER w AS nb FROM m WINDOW w AS (PARTITION BY chrom ORDER BY summit, s, e))
SELECT id, CASE WHEN pe > s THEN greatest(s, (ps + summit + 1) // 2) ELSE s END AS s, CASE WHEN e > nb THEN least(e, (summit + ns + 1) // 2) ELSE e END AS e, coalesce(e > nb, false) AS clipped FROM y""")
def adjacent(spark, d):
    wide = a.elements(spark, d).withColumn("start", F.col("start") - 60 - F.col("id") % 50).withColumn("end", F.col("end") + 60 + F.col("id") % 40)
    return spans(iv.adjacent_clip(wide)).select("id", "s", "e", "clipped")


@query("ordinal_id", f"""WITH {a.ELEMENTS}, {a.SIZES} SELECT id, 'DHS' || lpad(CAST(row_number() OVER (ORDER BY rank, summit, s, e) AS VARCHAR), 7, '0') AS ordinal_id FROM elements JOIN sizes USING (chrom)""")
def ordinals(spark, d):
    return iv.ordinal_ids(a.elements(spark, d), a.sizes(spark)).select("id", "ordinal_id")


@query("string_ops", f"""WITH {a.SITES} SELECT name, 'PROM' || lpad(CAST(pos AS VARCHAR), 8, '0') AS code, replace(name, 'Supplier#', '') AS bare, len(string_split(name, '#')) AS parts, regexp_matches(name, '^[A-Za-z0-9#_.-]+$') AS valid FROM sites""")
def strings(spark, d):
    return a.sites(spark, d).select("name", numbered("PROM", 8, "pos").alias("code"), F.replace("name", F.lit("Supplier#"), F.lit("")).alias("bare"), F.size(F.split("name", "#")).cast("long").alias("parts"), F.rlike("name", F.lit("^[A-Za-z0-9#_.-]+$")).alias("valid"))
