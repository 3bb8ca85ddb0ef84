"""Peak calling on counting units: pile-up against a local expectation, Poisson tails, q-values by bases, peaks.

All tracks are step functions, and one running sum over the ends of all
extended units gives pile-up and window counts together, in tiles.  Tails and
q-values are worked out once for each distinct (pile-up, expectation), with
the bases that have it; ranks are carried over tiles of p, so neither a
genome nor a frequent value is one task.  A track and the tails are written
once, to the checkpoint folder, since several steps read them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col
from .contacts import settled
from .intervals import TILE, _changes, _levels, named_runs

#: Tiles of q-value ranks in one unit of -log10 p.
P_TILES = 16


def log_factorial(n: np.ndarray) -> np.ndarray:
    """ln n! of whole numbers: exact up to 20, then by Stirling's series (to about 1e-13)."""
    z = n + 1.0
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return np.where(n <= 20, _SMALL[np.minimum(n, 20).astype(int)], series)


_SMALL = np.array([math.log(math.factorial(n)) for n in range(21)])


def _log_sums(steps: np.ndarray, factor: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """ln of 1 + the sums of as many terms as ``steps`` says; ``factor`` leads from a term to the next one in the rows that it is given."""
    order = np.argsort(-steps, kind="stable")  # the rows that still go on come first
    left = np.searchsorted(np.sort(steps), np.arange(1, steps.max(initial=0) + 1))
    term, total = np.ones(len(steps)), np.ones(len(steps))
    for i, done in enumerate(left, 1):
        n = len(steps) - done
        term[:n] *= factor(i, order[:n])
        total[:n] += term[:n]
    out = np.empty(len(steps))
    out[order] = np.log(total)
    return out


def log_tails(k: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """ln P(X > k) of Poisson variables of positive means."""
    upper = mean < k + 2
    ratio = np.where(upper, mean / (k + 2), k / mean)  # of the second term to the largest; those after it fall faster
    with np.errstate(divide="ignore"):
        enough = np.where(ratio > 0, np.minimum(10 * np.sqrt(k + mean), -35 / np.log(np.minimum(ratio, 1 - 1e-9))), 1)
    steps, out = (12 + np.ceil(enough)).astype(int), np.empty(len(k))
    n, m = k[upper], mean[upper]
    above = -m + (n + 1) * np.log(m) - log_factorial(n + 1) + _log_sums(steps[upper], lambda i, at: m[at] / (n[at] + 1 + i))
    out[upper] = np.minimum(above, 0.0)
    c, v = k[~upper], mean[~upper]
    below = -v + c * np.log(v) - log_factorial(c) + _log_sums(steps[~upper], lambda i, at: np.maximum(c[at] - i + 1, 0) / v[at])
    with np.errstate(divide="ignore"):
        out[~upper] = np.log1p(-np.minimum(np.exp(below), 1.0))
    return out


def _log_tails(k: pd.Series, mean: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(k), dtype="Float64")
    good = (k.notna() & (mean > 0)).to_numpy(bool)
    out[good] = log_tails(k[good].to_numpy(float), mean[good].to_numpy(float))
    return out


def poisson_log_tail(k: Column | str, expected: Column | str) -> Column:
    """ln P(X > k) of a Poisson variable, as a sum around its largest term, so that far tails keep their digits.

    ``k`` is a whole number, 0 or more; null where the expectation is not
    positive.  The terms of a batch of rows are worked out together.
    """
    return F.pandas_udf(_log_tails, "double")(col(k).cast("long"), col(expected).cast("double"))


def q_scores(counts: DataFrame, bases: DataFrame, by: tuple[str, ...], score: str = "p_score", weight: str = "bases") -> DataFrame:
    """``counts`` (by, score = -log10 p, weight = how many bases have it) with ``q_score``, -log10 of the q-value.

    ``bases``: by, total.  By Benjamini and Hochberg over single bases: a
    score is discounted by the bases that score higher, and no base may have a
    better q-value than one of a higher score.
    """
    keys = list(by)
    each = counts.groupBy(*keys, score).agg(F.sum(weight).alias("__n")).withColumn("__tile", F.floor(F.col(score) * P_TILES))
    higher = Window.partitionBy(*keys).orderBy(F.desc("__tile")).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys, "__tile").orderBy(F.desc(score))
    tiles = each.groupBy(*keys, "__tile").agg(F.sum("__n").alias("__sum")).select(*keys, "__tile", F.coalesce(F.sum("__sum").over(higher), F.lit(0)).alias("__before"))
    ranked = each.join(tiles, [*keys, "__tile"]).join(bases, keys)
    before = F.col("__before") + F.coalesce(F.sum("__n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    raw = ranked.withColumn("__raw", F.col(score) + F.log10((1 + before).cast("double")) - F.log10(F.col("total").cast("double")))
    least = raw.groupBy(*keys, "__tile").agg(F.min("__raw").alias("__least")).select(*keys, "__tile", F.min("__least").over(higher).alias("__carried"))
    lowest = F.least("__carried", F.min("__raw").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    out = raw.join(least, [*keys, "__tile"]).withColumn("q_score", F.greatest(lowest, F.lit(0.0))).select(*keys, score, "q_score")
    return counts.join(out, [*keys, score])


def _around(points: DataFrame, width: int, name: str, by: tuple[str, ...], sizes: DataFrame) -> DataFrame:
    """What intervals of ``width`` around points add to a track, cut to the chromosome."""
    left = width // 2
    x = points.join(F.broadcast(sizes.select("chrom", "size")), "chrom")
    return x.select(*by, "chrom", F.greatest(F.col("pos") - left, F.lit(0)).alias("start"), F.least(F.col("pos") - left + width, F.col("size")).alias("end"), F.lit(name).alias("track"), "n")


def _counted(points: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Points by base: by, chrom, pos, n; stretches of 2^16 bases lie together."""
    counts = points.groupBy(*by, "chrom", "pos").agg(F.count("*").alias("n"))
    return counts.repartition(*by, "chrom", F.floor(F.col("pos") / (1 << 16)))


def qpois_track(points: DataFrame, sizes: DataFrame, by: tuple[str, ...] = ("library",), extend: int = 150, windows: tuple[int, ...] = (1000, 10_000), control: DataFrame | None = None, tile: int = TILE) -> DataFrame:
    """Steps with pile-up, local expectation and scores: by, chrom, start, end, pileup, expected, p_score, q_score.

    ``points`` (by, chrom, pos) are 5' ends or insertions; each covers
    ``extend`` bases around it.  The expectation is the largest of the
    background, all points over the genome, and of the points in the windows
    around a base, all scaled to ``extend``; they are those of ``control``
    (with the same ``by``), scaled to as many points, where it is given, and
    the window of ``extend`` counts too.  ``sizes``: chrom, size.  Stretches
    without any point in reach are left out; they count for q-values as bases
    that score 0, as do all bases without pile-up.  Points on chromosomes that
    ``sizes`` does not name are ignored.
    """
    keys = list(by)
    known = points.join(F.broadcast(sizes.select("chrom")), "chrom", "left_semi")
    source = known if control is None else control.join(F.broadcast(sizes.select("chrom")), "chrom", "left_semi")
    spans = windows if control is None else (extend, *windows)
    names = {w: f"w{w}" for w in spans}
    # Deep data crowd on the same bases, so points of one base are counted first; what lies near is dealt to one task, where its changes fold.
    counted = settled(_counted(known, by))
    control_counted = counted if control is None else settled(_counted(source, by))
    parts = _around(counted, extend, "pileup", by, sizes)
    for w in spans:
        parts = parts.unionByName(_around(control_counted, w, names[w], by, sizes))
    tracks = ("pileup", *names.values())
    changes = _changes(parts, {t: F.when(F.col("track") == t, F.col("n")).otherwise(0) for t in tracks}, (*by, "chrom"))
    steps = _levels(changes, tracks, (*by, "chrom"), tile).where(" or ".join(f"{t} <> 0" for t in tracks))
    genome = sizes.agg(F.sum("size").alias("total"))
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("n"))
    if control is not None:
        totals = totals.join(control_counted.groupBy(*keys).agg(F.sum("n").alias("c")), keys)
    totals = totals.join(F.broadcast(genome)).withColumn("scale", F.lit(1.0) if control is None else F.col("n") / F.col("c"))
    local = [F.col(names[w]) * F.lit(extend) * F.col("scale") / F.lit(w) for w in spans]
    steps = steps.join(F.broadcast(totals), keys).withColumn("expected", F.greatest(F.col("n") * F.lit(extend).cast("double") / F.col("total"), *local))
    steps = settled(steps.select(*keys, "chrom", "start", "end", "pileup", "expected"))
    pairs = steps.where("pileup > 0").groupBy(*keys, "pileup", "expected").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))
    scored = settled(pairs.withColumn("p_score", F.round(-poisson_log_tail("pileup", "expected") / math.log(10), 5)))
    scored = q_scores(scored, totals.select(*keys, "total"), by).select(*keys, "pileup", "expected", "p_score", "q_score")
    out = steps.join(scored, [*keys, "pileup", "expected"], "left")
    return out.select(*keys, "chrom", "start", "end", "pileup", "expected", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("p_score", "q_score")])


def per_million(track: DataFrame, totals: DataFrame, by: tuple[str, ...] = ("library",)) -> DataFrame:
    """Pile-up and expectation per million points; ``totals``: by, n."""
    x = track.join(F.broadcast(totals.select(*by, "n")), list(by))
    return x.withColumns({c: F.col(c) * 1e6 / F.col("n") for c in ("pileup", "expected")}).drop("n")


def _regions(steps: DataFrame, by: tuple[str, ...], gap: int, shortest: int) -> DataFrame:
    """The steps of runs at most ``gap`` apart that span ``shortest`` bases, with the run's borders."""
    keys = [*by, "chrom"]
    runs = named_runs(steps, gap, tuple(keys))
    spans = runs.groupBy(*keys, "run_start").agg(F.max("end").alias("run_end")).where(F.col("run_end") - F.col("run_start") >= shortest)
    return runs.join(spans, [*keys, "run_start"])


def peak_calls(track: DataFrame, by: tuple[str, ...] = ("library",), q: float = 0.05, gap: int = 50, shortest: int = 150) -> DataFrame:
    """Narrow peaks: by, chrom, start, end, summit, pileup, fold, p_score, q_score, score.

    Steps with a q-value below ``q`` join over gaps of at most ``gap`` bases;
    runs of ``shortest`` bases or more are peaks.  The summit is the middle of
    the highest step, of several the middle one; the other values are those
    at the summit.  ``fold`` is (pile-up + 1) / (expectation + 1), ``score``
    ten times q_score, cut to a whole number of at most 1000.
    """
    keys = [*by, "chrom", "run_start", "run_end"]
    x = _regions(settled(track.where(F.col("q_score") > -math.log10(q))), by, gap, shortest)
    top = x.groupBy(*keys).agg(F.max("pileup").alias("top"))
    best = x.join(top, keys).where("pileup = top").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "end", "pileup", "expected", "p_score", "q_score"))).alias("steps"))
    at = best.withColumn("s", F.get("steps", F.floor((F.size("steps") + 1) / 2).cast("int") - 1))
    return at.select(
        *by, "chrom", F.col("run_start").alias("start"), F.col("run_end").alias("end"), F.expr("(s.start + s.end) div 2").alias("summit"), F.col("s.pileup").alias("pileup"), ((F.col("s.pileup") + 1) / (F.col("s.expected") + 1)).alias("fold"),
        F.col("s.p_score").alias("p_score"), F.col("s.q_score").alias("q_score"), F.least(F.floor(F.col("s.q_score") * 10), F.lit(1000)).cast("int").alias("score"),
    )


def broad_peaks(track: DataFrame, by: tuple[str, ...] = ("library",), q: float = 0.05, broad_q: float = 0.1, gap: int = 50, shortest: int = 150) -> DataFrame:
    """Broad regions, with how many narrow peaks lie in each, and means over their bases: by, chrom, start, end, narrow_n, pileup, fold, p_score, q_score.

    Runs of steps below ``broad_q`` over gaps of up to four times ``gap``.
    """
    keys = [*by, "chrom", "run_start", "run_end"]
    width = F.col("end") - F.col("start")
    track = settled(track.where(F.col("q_score") > -math.log10(max(q, broad_q))))
    x = _regions(track.where(F.col("q_score") > -math.log10(broad_q)), by, 4 * gap, shortest)
    mean = lambda c: (F.sum(c * width) / F.sum(width))
    wide = x.groupBy(*keys).agg(mean(F.col("pileup")).alias("pileup"), mean((F.col("pileup") + 1) / (F.col("expected") + 1)).alias("fold"), mean(F.col("p_score")).alias("p_score"), mean(F.col("q_score")).alias("q_score"))
    # A narrow peak is made of steps of one broad run, so it is counted there by any of its steps.
    narrow = _regions(track.where(F.col("q_score") > -math.log10(q)), by, gap, shortest).where("start = run_start").select(*by, "chrom", "start")
    inside = x.join(narrow, [*by, "chrom", "start"]).groupBy(*keys).agg(F.count("*").alias("narrow_n"))
    out = wide.join(inside, keys, "left").withColumn("narrow_n", F.coalesce("narrow_n", F.lit(0)))
    return out.select(*by, "chrom", F.col("run_start").alias("start"), F.col("run_end").alias("end"), "narrow_n", "pileup", "fold", "p_score", "q_score")


def cross_correlation(points: DataFrame, sizes: DataFrame, by: tuple[str, ...] = ("library",), furthest: int = 400) -> DataFrame:
    """Pearson's correlation of plus- and minus-strand 5' ends over all bases, at every shift: by, shift, correlation.

    ``points``: by, chrom, pos, strand.  A shift of d compares a base with the
    one d bases on.  Ends are counted by base first; a base of the plus strand
    meets the minus strand's in its own tile of ``furthest`` + 1 bases and the
    next, so no chromosome is one task.  Null where a strand does not vary.
    """
    keys, width = list(by), furthest + 1
    counts = points.join(F.broadcast(sizes.select("chrom")), "chrom", "left_semi").groupBy(*keys, "chrom", "pos", "strand").agg(F.count("*").alias("c"))
    one = lambda strand, name: F.sum(F.when(F.col("strand") == strand, F.col(name)))
    sums = counts.withColumn("cc", F.col("c") * F.col("c")).groupBy(*keys).agg(*[F.coalesce(one(s, v), F.lit(0)).alias(f"{n}{v}") for s, n in (("+", "p"), ("-", "m")) for v in ("c", "cc")])
    plus = counts.where("strand = '+'").select(*keys, "chrom", "pos", F.col("c").alias("p"), F.explode(F.array(F.floor(F.col("pos") / width), F.floor(F.col("pos") / width) + 1)).alias("tile"))
    minus = counts.where("strand = '-'").select(*keys, "chrom", F.col("pos").alias("at"), F.col("c").alias("m"), F.floor(F.col("pos") / width).alias("tile"))
    met = plus.join(minus, [*keys, "chrom", "tile"]).withColumn("shift", F.col("at") - F.col("pos")).where(F.col("shift").between(0, furthest)).groupBy(*keys, "shift").agg(F.sum(F.col("p") * F.col("m")).alias("pm"))
    grid = sums.join(F.broadcast(sizes.agg(F.sum("size").cast("double").alias("n")))).withColumn("shift", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(furthest).cast("long"))))
    spread = lambda s: F.col("n") * F.col(f"{s}cc") - F.col(f"{s}c") * F.col(f"{s}c")
    r = (F.col("n") * F.coalesce("pm", F.lit(0)) - F.col("pc") * F.col("mc")) / F.nullif(F.sqrt(spread("p")) * F.sqrt(spread("m")), F.lit(0.0))
    return grid.join(met, [*keys, "shift"], "left").select(*keys, "shift", r.alias("correlation"))


def correlation_summary(curve: DataFrame, read_length: int, by: tuple[str, ...] = ("library",)) -> DataFrame:
    """Fragment length (the shift of the highest correlation, of several the smallest), and the normalised and relative strand coefficients."""
    best = F.max_by("shift", F.struct("correlation", -F.col("shift")))
    x = curve.groupBy(*by).agg(best.alias("fragment_length"), F.max("correlation").alias("top"), F.min("correlation").alias("least"), F.max(F.when(F.col("shift") == read_length, F.col("correlation"))).alias("phantom"))
    return x.select(*by, "fragment_length", (F.col("top") / F.nullif("least", F.lit(0.0))).alias("nsc"), ((F.col("top") - F.col("least")) / F.nullif(F.col("phantom") - F.col("least"), F.lit(0.0))).alias("rsc"))


def coverage_fingerprint(points: DataFrame, sizes: DataFrame, by: tuple[str, ...] = ("library",), width: int = 500) -> DataFrame:
    """How points spread over bins of ``width`` bases, from the emptiest to the fullest: by, n (points in a bin), bins, bin_share, point_share.

    The shares are cumulative up to bins of n points.  Bins are counted by n
    before they are ranked, so a row stands for all bins of one n.
    """
    keys = list(by)
    binned = points.join(F.broadcast(sizes.select("chrom")), "chrom", "left_semi").groupBy(*keys, "chrom", F.floor(F.col("pos") / width).alias("bin")).agg(F.count("*").alias("n"))
    hist = binned.groupBy(*keys, "n").agg(F.count("*").alias("bins"))
    every = sizes.agg(F.sum(F.ceil(F.col("size") / width)).alias("every"))
    empty = hist.groupBy(*keys).agg(F.sum("bins").alias("used")).join(F.broadcast(every)).select(*keys, F.lit(0).cast("long").alias("n"), (F.col("every") - F.col("used")).alias("bins"))
    order = Window.partitionBy(*keys).orderBy("n")
    upto, whole = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    points_of = F.col("n") * F.col("bins")
    return hist.unionByName(empty).select(*keys, "n", "bins", (F.sum("bins").over(upto) / F.sum("bins").over(whole)).alias("bin_share"), (F.sum(points_of).over(upto) / F.sum(points_of).over(whole)).alias("point_share"))
