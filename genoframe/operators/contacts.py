"""Contact matrices as sparse pixel tables: coarsening, balancing, decay with distance."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


def select_resolution(available: DataFrame, target: int) -> DataFrame:
    """Per source: the coarsest available resolution that divides the target; null if none does."""
    fits = F.when((F.col("resolution") <= target) & (F.lit(target) % F.col("resolution") == 0), F.col("resolution"))
    return available.groupBy("source").agg(F.max(fits).alias("selected"))


def coarsen_merge(pixels: DataFrame, factor: int) -> DataFrame:
    """Sum of pixels (chrom, bin1, bin2, count) of all replicates over blocks of ``factor`` bins; bin1 <= bin2."""
    a, b = F.expr(f"bin1 div {factor}"), F.expr(f"bin2 div {factor}")
    return pixels.groupBy("chrom", F.least(a, b).alias("bin1"), F.greatest(a, b).alias("bin2")).agg(F.sum("count").alias("count"))


def balance_one(b1: np.ndarray, b2: np.ndarray, count: np.ndarray, ignore: int = 2, mad_max: float = 5.0, min_nnz: int = 10, tolerance: float = 1e-5, steps: tuple[int, ...] = (200, 2000)) -> tuple[np.ndarray, np.ndarray, bool]:
    """(bins, weights, converged) of iterative correction; masked bins have the weight NaN.

    Diagonals nearer than ``ignore``, bins with few pixels and bins whose log
    marginal lies far below the median are left out.  If it does not settle in
    the first number of steps it starts again with the next.
    """
    bins = np.unique(np.concatenate([b1, b2]))
    i, j = np.searchsorted(bins, b1), np.searchsorted(bins, b2)
    use = (b2 - b1) >= ignore
    i, j, c = i[use], j[use], count[use].astype(float)
    n = len(bins)
    margin = lambda v: np.bincount(i, v, n) + np.bincount(j, v, n)
    good = margin(np.ones(len(c))) >= min_nnz
    total = margin(c)
    if good.any() and mad_max:
        logs = np.log(total[good & (total > 0)])
        if len(logs):
            middle = np.median(logs)
            good &= total >= np.exp(middle - mad_max * np.median(np.abs(logs - middle)))
    good &= total > 0
    settled = False
    weight = np.full(n, np.nan)
    for limit in steps:
        w = np.where(good, 1.0, 0.0)
        for _ in range(limit):
            m = margin(c * w[i] * w[j])
            live = m > 0
            if not live.any():
                break
            mean = m[live].mean()
            scaled = np.where(live, m / mean, 1.0)
            w = w / scaled
            settled = m[live].var() / mean**2 < tolerance
            if settled:
                break
        if settled:
            mean = margin(c * w[i] * w[j])
            mean = mean[mean > 0].mean()
            weight = np.where(good, w / np.sqrt(mean), np.nan)
            break
    return bins, weight, settled


def ice_balance(pixels: DataFrame, by: tuple[str, ...] = ("context",), **options) -> DataFrame:
    """Weights of the bins of each group's matrix: by, bin, weight (null if masked), converged.

    A group's matrix is one task; ``ice_balance_large`` is for those that are too large for it.
    """

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bins, weight, settled = balance_one(group["bin1"].to_numpy(), group["bin2"].to_numpy(), group["count"].to_numpy(), **options)
        out = pd.DataFrame({c: [k] * len(bins) for c, k in zip(by, key, strict=True)})
        return out.assign(bin=bins, weight=weight, converged=settled)

    kinds = ", ".join(f"{c} {pixels.schema[c].dataType.simpleString()}" for c in by)
    out = pixels.groupBy(*by).applyInPandas(run, f"{kinds}, bin long, weight double, converged boolean")
    return out.withColumn("weight", F.when(~F.isnan("weight"), F.col("weight")))


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, which cuts its lineage.

    The folder is the session's; on one machine a temporary one where none is
    set.  A cluster must name a folder that all its machines share.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="genoframe-checkpoint-"))
    return df.checkpoint()


def ice_balance_large(pixels: DataFrame, by: tuple[str, ...] = ("context",), ignore: int = 2, mad_max: float = 5.0, min_nnz: int = 10, tolerance: float = 1e-5, steps: int | tuple[int, ...] = (200, 2000)) -> DataFrame:
    """The correction of ``ice_balance`` for matrices that no task can hold: by, bin, weight (null if masked), converged.

    Pixels stay where they are.  A step joins the weights of the bins, which
    are few beside the pixels, and adds up marginals with map-side partials;
    only the weights are written, once a step.  Groups that have settled keep
    their weights; the others start again with the next number of steps.
    """
    keys = list(by)
    far = pixels.where(F.col("bin2") - F.col("bin1") >= ignore).select(*keys, "bin1", "bin2", F.col("count").cast("double").alias("count"))

    def margins(values: DataFrame) -> DataFrame:
        ends = values.select(*keys, F.explode(F.array("bin1", "bin2")).alias("bin"), "value")
        return ends.groupBy(*keys, "bin").agg(F.sum("value").alias("m"), F.count("*").alias("nnz"))

    bins = pixels.select(*keys, F.explode(F.array("bin1", "bin2")).alias("bin")).distinct()
    first = bins.join(margins(far.withColumnRenamed("count", "value")), [*keys, "bin"], "left")
    enough = (F.col("nnz") >= min_nnz) & (F.col("m") > 0)
    logs = first.withColumn("lm", F.when(enough, F.log("m")))
    middle = logs.groupBy(*keys).agg(F.percentile("lm", 0.5).alias("mid"))
    spread = logs.join(middle, keys).groupBy(*keys, "mid").agg(F.percentile(F.abs(F.col("lm") - F.col("mid")), 0.5).alias("mad"))
    good = enough & (F.col("m") >= F.exp(F.col("mid") - mad_max * F.col("mad")))
    start = settled(first.join(spread, keys, "left").select(*keys, "bin", F.when(F.coalesce(good, F.lit(False)), 1.0).otherwise(0.0).alias("w")))
    weights = start.withColumn("converged", F.lit(False))
    for limit in (steps,) if isinstance(steps, int) else steps:
        again = start.withColumnRenamed("w", "w0")
        weights = weights.join(again, [*keys, "bin"]).select(*keys, "bin", F.when(F.col("converged"), F.col("w")).otherwise(F.col("w0")).alias("w"), "converged")
        for _ in range(limit):
            live = weights.where("w > 0 and not converged")
            x = far.join(live.select(*keys, F.col("bin").alias("bin1"), F.col("w").alias("w1")), [*keys, "bin1"]).join(live.select(*keys, F.col("bin").alias("bin2"), F.col("w").alias("w2")), [*keys, "bin2"])
            m = margins(x.select(*keys, "bin1", "bin2", (F.col("count") * F.col("w1") * F.col("w2")).alias("value"))).where("m > 0")
            moments = m.groupBy(*keys).agg(F.avg("m").alias("mean"), F.var_pop("m").alias("var"))
            scaled = m.join(moments, keys).select(*keys, "bin", (F.col("m") / F.col("mean")).alias("s"))
            done = moments.select(*keys, (F.col("var") / F.col("mean") / F.col("mean") < tolerance).alias("now"))
            moved = weights.join(scaled, [*keys, "bin"], "left").join(done, keys, "left")
            weights = settled(moved.select(*keys, "bin", (F.col("w") / F.coalesce("s", F.lit(1.0))).alias("w"), (F.col("converged") | F.coalesce("now", F.lit(True))).alias("converged")))
            if not weights.where("not converged").limit(1).count():
                break
        else:
            continue
        break
    live = weights.where("w > 0")
    x = far.join(live.select(*keys, F.col("bin").alias("bin1"), F.col("w").alias("w1")), [*keys, "bin1"]).join(live.select(*keys, F.col("bin").alias("bin2"), F.col("w").alias("w2")), [*keys, "bin2"])
    scale = margins(x.select(*keys, "bin1", "bin2", (F.col("count") * F.col("w1") * F.col("w2")).alias("value"))).where("m > 0").groupBy(*keys).agg(F.sqrt(F.avg("m")).alias("scale"))
    weight = F.when(F.col("converged") & (F.col("w") > 0), F.col("w") / F.col("scale"))
    return weights.join(scale, keys, "left").select(*keys, "bin", weight.alias("weight"), (F.col("converged") & F.col("scale").isNotNull()).alias("converged"))


def balance(pixels: DataFrame, by: tuple[str, ...] = ("context",), limit: int = 20_000_000) -> DataFrame:
    """Weights by ``ice_balance``, or by ``ice_balance_large`` if a group has more than ``limit`` pixels; both give the same."""
    largest = pixels.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    return (ice_balance if largest <= limit else ice_balance_large)(pixels, by)


def _masked_pairs(weights: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, offset, twice): pairs of masked bins at each offset, from the autocorrelation of a group's mask, one number a bin."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        at = group["bin"].to_numpy()
        size = 1 << int(2 * (at.max() + 1) - 1).bit_length()
        mask = np.zeros(size)
        mask[at] = 1
        wave = np.fft.rfft(mask)
        pairs = np.rint(np.fft.irfft(wave * wave.conj(), size)[: at.max() + 1]).astype(np.int64)
        pairs[0] = 0
        offset = np.flatnonzero(pairs)
        return pd.DataFrame({c: pd.Series([k] * len(offset), dtype=object) for c, k in zip(by, key, strict=True)}).assign(offset=offset, twice=pairs[offset])

    kinds = ", ".join(f"{c} {weights.schema[c].dataType.simpleString()}" for c in by)
    return weights.where("weight is null").select(*by, F.col("bin").cast("long").alias("bin")).groupBy(*by).applyInPandas(run, f"{kinds}, offset long, twice long")


def distance_decay(pixels: DataFrame, weights: DataFrame, by: tuple[str, ...] = ("chrom",), least: int = 1) -> DataFrame:
    """Mean balanced contact of each diagonal offset: sums over pixels, over all pairs of bins that are not masked, zeros included.

    ``weights`` has a row for every bin, from 0.  Of the n - d pairs at an
    offset d those with a masked first or second bin are taken off, by running
    counts of masked bins, and those with two masked bins put back, which the
    mask's autocorrelation counts: no bins are paired.
    """
    good = weights.where("weight is not null")
    w1 = good.select(*by, F.col("bin").alias("bin1"), F.col("weight").alias("w1"))
    w2 = good.select(*by, F.col("bin").alias("bin2"), F.col("weight").alias("w2"))
    balanced = pixels.join(w1, [*by, "bin1"]).join(w2, [*by, "bin2"]).withColumn("offset", F.col("bin2") - F.col("bin1")).where(F.col("offset") >= least)
    sums = balanced.groupBy(*by, "offset").agg(F.sum(F.col("count") * F.col("w1") * F.col("w2")).alias("contact"))
    total = weights.groupBy(*by).agg((F.max("bin") + 1).alias("n"), F.count_if(F.col("weight").isNull()).alias("m"))
    upto = weights.select(*by, "bin", F.sum(F.when(F.col("weight").isNull(), 1).otherwise(0)).over(Window.partitionBy(*by).orderBy("bin")).alias("masked"))
    x = sums.join(total, list(by)).withColumn("hi", F.col("n") - F.col("offset") - 1).withColumn("lo", F.col("offset") - 1)
    x = x.join(upto.select(*by, F.col("bin").alias("hi"), F.col("masked").alias("first_masked")), [*by, "hi"], "left").join(upto.select(*by, F.col("bin").alias("lo"), F.col("masked").alias("below")), [*by, "lo"], "left")
    both = _masked_pairs(weights, by)
    zero = lambda c: F.coalesce(c, F.lit(0))
    pairs = F.col("n") - F.col("offset") - zero("first_masked") - (F.col("m") - zero("below")) + zero("twice")
    out = x.join(both, [*by, "offset"], "left").withColumn("pairs", pairs)
    return out.select(*by, "offset", "contact", "pairs", (F.col("contact") / F.col("pairs")).alias("mean_contact"))


def fit_powerlaw(decay: DataFrame, by: tuple[str, ...] = (), resolution: int = 1) -> DataFrame:
    """Slope and scale of log mean contact over log distance, from offsets with positive contact."""
    x = decay.where("mean_contact > 0 and offset > 0").withColumn("lx", F.log(F.col("offset") * F.lit(float(resolution)))).withColumn("ly", F.log("mean_contact"))
    return x.groupBy(*by).agg(F.regr_slope("ly", "lx").alias("gamma"), F.exp(F.regr_intercept("ly", "lx")).alias("scale"), F.count("*").alias("fitted_diagonals"))


# The slopes between which a fit counts as a decay with distance.
SLOPES = (-3.0, -0.05)


def standardize(pixels: DataFrame, resolutions: DataFrame, target: int) -> DataFrame:
    """Replicate matrices (context, source, chrom, bin1, bin2, count) at ``target`` bp, summed by context.

    ``resolutions``: context, source, resolution; each source is read at the
    coarsest one that divides the target, and fails if none does.
    """
    chosen = select_resolution(resolutions, target)
    have = F.when(F.col("selected").isNotNull(), F.col("selected")).otherwise(F.raise_error(F.lit("a source has no resolution that divides the target")).cast("int"))
    x = pixels.join(chosen.select("source", have.alias("resolution")), ["source", "resolution"])
    factor = F.lit(target) / F.col("resolution")
    a, b = F.floor(F.col("bin1") / factor), F.floor(F.col("bin2") / factor)
    return x.groupBy("context", "chrom", F.least(a, b).alias("bin1"), F.greatest(a, b).alias("bin2")).agg(F.sum("count").alias("count"))


@dataclass
class ContactModels:
    """What ``contact_models`` makes of a set of matrices: balanced pixels, weights, and a decay fit a context with that of the atlas."""

    pixels: DataFrame
    weights: DataFrame
    fits: DataFrame
    atlas: DataFrame


def contact_models(merged: DataFrame, shape: DataFrame, resolution: int, least: int = 1) -> ContactModels:
    """Balance every context's matrix, fit its decay with distance, and join the fits to the atlas model.

    ``merged``: context, chrom, bin1, bin2, count; ``shape``: chrom, bins,
    first (the number of the chromosome's first bin in the whole matrix).  A
    slope outside of ``SLOPES`` fails.
    """
    whole = merged.join(shape, "chrom").select("context", (F.col("first") + F.col("bin1")).alias("bin1"), (F.col("first") + F.col("bin2")).alias("bin2"), "count")
    balanced = settled(balance(whole))
    bins = shape.select("chrom", "first", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    grid = bins.crossJoin(merged.select("context").distinct())  # bins x contexts is the result
    weights = grid.withColumn("at", F.col("first") + F.col("bin")).join(balanced.select("context", F.col("bin").alias("at"), "weight"), ["context", "at"], "left").select("context", "chrom", "bin", "weight")
    sums = distance_decay(merged, weights, ("context", "chrom"), least).groupBy("context", "offset").agg(F.sum("contact").alias("contact"), F.sum("pairs").alias("pairs"))
    fits = fit_powerlaw(sums.withColumn("mean_contact", F.col("contact") / F.col("pairs")), ("context",), resolution)
    sound = F.when(F.col("gamma").between(*SLOPES), F.col("gamma")).otherwise(F.raise_error(F.format_string("%s: the contacts do not fall with distance", "context")).cast("double"))
    fits = fits.withColumn("gamma", sound)
    a, b = (weights.select("context", "chrom", F.col("bin").alias(f"bin{i}"), F.col("weight").alias(f"w{i}")) for i in (1, 2))
    value = F.coalesce(F.col("count") * F.col("w1") * F.col("w2"), F.lit(float("nan")))
    pixels = merged.join(a, ["context", "chrom", "bin1"]).join(b, ["context", "chrom", "bin2"]).select("context", "chrom", "bin1", "bin2", "count", value.alias("value"))
    return ContactModels(pixels, weights, fits, atlas_model(fits))


def atlas_model(models: DataFrame) -> DataFrame:
    """One model for contexts without contacts: the mean slope and the geometric mean scale."""
    return models.agg(F.avg("gamma").alias("gamma"), F.exp(F.avg(F.log("scale"))).alias("scale"), F.count("*").alias("contexts"))


#: Pixels of a matrix that is broadcast.
SMALL = 100_000


def contact_lookup(pairs: DataFrame, balanced: DataFrame, shape: DataFrame, resolution: int | Column, pseudocount: float = 1.0, by: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """Contact evidence of position pairs.

    ``pairs``: by, pos1, pos2, expected; ``balanced``: by, bin1 <= bin2,
    value, NaN where a stored pixel touches a masked bin; ``shape``: by,
    bins.  A pixel that is not stored reads as 0.  Positions in one bin take
    the larger finite contact with a neighbour bin.  Adds same_bin, status,
    observed, weight and observed_over_expected.
    """
    size = resolution if isinstance(resolution, Column) else F.lit(resolution)
    b1, b2 = (F.floor(f("pos1", "pos2") / size) for f in (F.least, F.greatest))
    x = pairs.join(F.broadcast(shape.select(*by, "bins")), list(by), "left").withColumn("b1", b1).withColumn("b2", b2)
    same = F.col("b1") == F.col("b2")
    # What positions in two bins or in one ask for, by the same key: a pixel beside the diagonal stands for its bins too.
    at = lambda lo, hi, **v: F.struct(F.col(lo).alias("b1"), F.col(hi).alias("b2"), *[v.get(c, F.lit(None).cast("double")).alias(c) for c in ("v", "vl", "vr")])
    value = F.col("value").cast("double")
    beside = F.when(F.col("bin2") - F.col("bin1") == 1, F.array(at("bin1", "bin1", vr=value), at("bin2", "bin2", vl=value))).otherwise(F.array())
    table = balanced.select(*by, F.explode(F.concat(F.array(at("bin1", "bin2", v=value)), beside)).alias("p")).select(*by, "p.*")
    table = table.groupBy(*by, "b1", "b2").agg(*[F.max(c).alias(c) for c in ("v", "vl", "vr")])
    if balanced.limit(SMALL + 1).count() <= SMALL:  # many pairs may ask for one pixel of a small matrix, so they stay where they are
        table = F.broadcast(table)
    x = x.join(table, [*by, "b1", "b2"], "left")
    usable = lambda c, there: F.when(there, F.coalesce(F.col(c), F.lit(0.0)))
    finite = lambda c: F.when(~F.isnan(c) & (c >= 0), c)
    left, right = finite(usable("vl", F.col("b1") > 0)), finite(usable("vr", F.col("b1") + 1 < F.col("bins")))
    near, direct = F.greatest(left, right), finite(F.coalesce(F.col("v"), F.lit(0.0)))
    outside = F.col("b2") >= F.col("bins")
    status = (
        F.when(F.col("bins").isNull(), "chromosome_absent_from_matrix").when(outside, "position_outside_matrix")
        .when(same, F.when(near.isNull(), "unbalanced_or_masked_adjacent_bins").otherwise("adjacent_bin_proxy"))
        .otherwise(F.when(direct.isNull(), "unbalanced_or_masked_bin").otherwise("observed_matrix_pixel"))
    )
    x = x.withColumn("status", status).withColumn("observed", F.when(F.col("status") == "adjacent_bin_proxy", near).when(F.col("status") == "observed_matrix_pixel", direct))
    prior = F.lit(pseudocount) * F.col("expected")
    x = x.withColumn("weight", F.coalesce(F.col("observed") + prior, prior)).withColumn("observed_over_expected", F.when(F.col("expected") > 0, F.col("observed") / F.col("expected")))
    return x.withColumn("same_bin", same.cast("int")).drop("v", "vl", "vr", "b1", "b2", "bins")
