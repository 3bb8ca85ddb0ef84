"""Counts to activity: library signal, robust normalisation, replicates, contexts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import cpm_per_kb, geometric_mean, normalized_cpm
from .intervals import count_overlaps

LIBRARY = ("library", "assay", "context")


def signal_of_counts(elements: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Every element in every library of ``totals`` (library, assay, context, total_units): raw_count (0 without a row in ``counts``) and cpm_per_kb."""
    grid = elements.select("id", "chrom", "start", "end").crossJoin(F.broadcast(totals))  # elements x libraries is the result
    out = grid.join(counts, ["id", *LIBRARY], "left").withColumn("raw_count", F.coalesce("raw_count", F.lit(0)))
    return out.withColumn("cpm_per_kb", cpm_per_kb("raw_count", "total_units", F.col("end") - F.col("start")))


def library_signal(elements: DataFrame, units: DataFrame, width: int = 1024) -> DataFrame:
    """Every element in every library: raw_count, total_units (all units, wherever they lie) and cpm_per_kb."""
    totals = units.groupBy(*LIBRARY).agg(F.count("*").alias("total_units"))
    return signal_of_counts(elements, count_overlaps(elements, units, width, by=LIBRARY), totals)


def replicate_aggregate(signal: DataFrame, value: str = "cpm_per_kb") -> DataFrame:
    """Per (id, context, assay): replicates, their sorted ids, sums, mean and sample sd (0 for one replicate)."""
    return signal.groupBy("id", "context", "assay").agg(
        F.count("*").alias("replicate_n"), F.array_join(F.array_sort(F.collect_list("library")), ",").alias("library_ids"), F.sum("raw_count").alias("raw_count"), F.avg("raw_count").alias("mean_raw_count"),
        F.sum("total_units").alias("total_units"), F.avg(value).alias("mean_value"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("sd_value"),
    )


def assay_pivot(aggregated: DataFrame, assays: tuple[str, ...] = ("atac", "h3k27ac")) -> DataFrame:
    """One row for each (id, context), values by assay, and their geometric mean as activity."""
    wide = aggregated.groupBy("id", "context").pivot("assay", list(assays)).agg(F.max("mean_value").alias("mean"), F.max("raw_count").alias("raw"))
    a, b = assays
    return wide.withColumn("activity", geometric_mean(f"{a}_mean", f"{b}_mean"))


def _average_rank(rows: DataFrame, keys: list[str], value: str, name: str, tiles: int = 64) -> DataFrame:
    """(keys, value, name): the average rank of each value in its group.

    Values are counted first and ranked in tiles of 1/``tiles``; a tile takes
    the counts of those before it from a table of one row a tile, so neither
    a group nor a frequent value is one task.
    """
    c = rows.groupBy(*keys, value).agg(F.count("*").alias("__n")).withColumn("__tile", F.floor(F.col(value) * tiles))
    before = Window.partitionBy(*keys).orderBy("__tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = c.groupBy(*keys, "__tile").agg(F.sum("__n").alias("__all")).select(*keys, "__tile", F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*keys, "__tile").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("__before") + F.coalesce(F.sum("__n").over(within), F.lit(0)) + (F.col("__n") + 1) / 2
    return c.join(carried, [*keys, "__tile"]).select(*keys, value, rank.alias(name))


def tmm_factors(counts: DataFrame, log_trim: float = 0.3, sum_trim: float = 0.05, cutoff: float = -1e10) -> DataFrame:
    """Trimmed-mean-of-M factors per assay: (assay, library, factor) from (assay, library, lib_size, feature, count).

    Features without a count in any library of the assay are left out.  The
    reference library is the one whose upper quartile of count/lib_size is
    nearest to their mean.  M and A are trimmed by average ranks, and the
    factors of an assay multiply to 1.
    """
    rows = counts.withColumn("all", F.sum("count").over(Window.partitionBy("assay", "feature"))).where(F.col("all") > 0).drop("all")
    quartile = rows.groupBy("assay", "library").agg(F.percentile(F.col("count") / F.col("lib_size"), 0.75).alias("q"))
    away = F.abs(F.col("q") - F.avg("q").over(Window.partitionBy("assay")))
    reference = quartile.withColumn("k", F.row_number().over(Window.partitionBy("assay").orderBy(F.round(away, 15), "library"))).where("k = 1").select("assay", F.col("library").alias("reference"))
    marked = rows.join(F.broadcast(reference), "assay")
    base = marked.where("library = reference").select("assay", "feature", F.col("count").alias("r"), F.col("lib_size").alias("nr"))
    pair = marked.join(base, ["assay", "feature"]).withColumn("y", F.col("count").cast("double")).withColumn("n", F.col("lib_size").cast("double"))
    pair = pair.where("y > 0 and r > 0")
    m = F.log2((F.col("y") / F.col("n")) / (F.col("r") / F.col("nr")))
    a = (F.log2(F.col("y") / F.col("n")) + F.log2(F.col("r") / F.col("nr"))) / 2
    v = (F.col("n") - F.col("y")) / F.col("n") / F.col("y") + (F.col("nr") - F.col("r")) / F.col("nr") / F.col("r")
    pair = pair.select("assay", "library", F.round(m, 12).alias("m"), F.round(a, 12).alias("a"), v.alias("v")).where(F.col("a") > cutoff)
    of = ["assay", "library"]
    ranked = pair.join(_average_rank(pair, of, "m", "rm"), [*of, "m"]).join(_average_rank(pair, of, "a", "ra"), [*of, "a"])
    size = pair.groupBy(*of).agg(F.count("*").alias("n"), F.max(F.abs("m")).alias("top"))
    ranked = ranked.join(F.broadcast(size), of)  # a row a library
    lo_m, lo_a = F.floor(F.col("n") * log_trim) + 1, F.floor(F.col("n") * sum_trim) + 1
    kept = (F.col("rm") >= lo_m) & (F.col("rm") <= F.col("n") + 1 - lo_m) & (F.col("ra") >= lo_a) & (F.col("ra") <= F.col("n") + 1 - lo_a)
    raw = ranked.groupBy("assay", "library").agg(F.max("top").alias("top"), F.sum(F.when(kept, F.col("m") / F.col("v"))).alias("x"), F.sum(F.when(kept, 1 / F.col("v"))).alias("w"))
    libraries = quartile.select("assay", "library").join(raw, ["assay", "library"], "left")
    factor = F.when((F.col("top") < 1e-6) | F.col("w").isNull(), 1.0).otherwise(F.pow(2.0, F.col("x") / F.col("w")))
    logs = libraries.withColumn("f", F.log(factor))
    return logs.select("assay", "library", F.exp(F.col("f") - F.avg("f").over(Window.partitionBy("assay"))).alias("factor"))


def factor_summary(factors: DataFrame) -> DataFrame:
    """Number, product, least and largest factor of each assay."""
    return factors.groupBy("assay").agg(F.count("*").alias("libraries"), F.product("factor").alias("factor_product"), F.min("factor").alias("min_factor"), F.max("factor").alias("max_factor"))


def background_counts(units: DataFrame, sizes: DataFrame, width: int = 10_000) -> DataFrame:
    """(assay, library, lib_size, feature, count): units by the bin of their midpoint, for all bins that hold a unit of the assay.

    Only chromosomes of ``sizes`` have bins; the size of a library counts all its units.
    """
    totals = units.groupBy("assay", "library").agg(F.count("*").alias("lib_size"))
    at = F.expr("(start + end) div 2")
    mid = units.join(F.broadcast(sizes.select("chrom", "size")), "chrom").where(at < F.col("size"))
    counts = mid.groupBy("assay", "library", F.concat_ws(":", "chrom", F.floor(at / width).cast("string")).alias("feature")).agg(F.count("*").alias("count"))
    grid = counts.select("assay", "feature").distinct().join(F.broadcast(totals), "assay")  # bins x libraries of an assay is the result
    return grid.join(counts, ["assay", "library", "feature"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def normalized_activity(elements: DataFrame, units: DataFrame, sizes: DataFrame, method: str = "background", width: int = 1024) -> DataFrame:
    """One row for each (element, context): figures of both assays, plain and normalised, and their activity.

    ``method``: the factors come from the elements' own counts ('master') or
    from genomic bins ('background').  Values are means of replicates with
    their sample deviation (0 for one replicate).
    """
    if method not in ("master", "background"):
        raise ValueError(f"unknown method {method}")
    signal = library_signal(elements, units, width)
    counts = signal.select("assay", "library", F.col("total_units").alias("lib_size"), F.col("id").alias("feature"), F.col("raw_count").alias("count")) if method == "master" else background_counts(units, sizes)
    factors = tmm_factors(counts)
    x = signal.join(F.broadcast(factors), ["assay", "library"])
    x = x.withColumn("normalized", normalized_cpm("raw_count", F.col("total_units") * F.col("factor"), F.col("end") - F.col("start")))
    sd = lambda c: F.coalesce(F.stddev_samp(c), F.lit(0.0))
    per = x.groupBy("id", "chrom", "start", "end", "context", "assay").agg(
        F.count("*").alias("library_n"), F.array_join(F.array_sort(F.collect_list("library")), ";").alias("library_ids"), F.sum("raw_count").alias("raw_count_sum"), F.avg("raw_count").alias("raw_count_mean"), F.sum("total_units").alias("total_units_sum"),
        F.avg("cpm_per_kb").alias("cpm_per_kb"), sd("cpm_per_kb").alias("cpm_per_kb_sd"), F.avg("normalized").alias("normalized_cpm_per_kb"), sd("normalized").alias("normalized_cpm_per_kb_sd"),
    )
    values = per.columns[6:]
    wide = per.groupBy("id", "chrom", "start", "end", "context").agg(*[F.max(F.when(F.col("assay") == assay, F.col(v))).alias(f"{assay}_{v}") for assay in ("atac", "h3k27ac") for v in values])
    activity = geometric_mean("atac_normalized_cpm_per_kb", "h3k27ac_normalized_cpm_per_kb")
    return wide.withColumn("width_bp", F.col("end") - F.col("start")).withColumn("normalization_method", F.lit(method)).withColumn("activity", activity)


def strict_join(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner join that fails unless both sides have the same keys, each once."""
    x = a.withColumn("__a", F.lit(1)).withColumn("__n", F.count("*").over(Window.partitionBy(*on)))
    y = b.withColumn("__b", F.lit(1)).withColumn("__m", F.count("*").over(Window.partitionBy(*on)))
    good = (F.col("__a") + F.col("__b") == 2) & (F.col("__n") * F.col("__m") == 1)
    check = F.when(good, 1).otherwise(F.raise_error(F.lit("the two tables have different or repeated keys")).cast("int"))
    return x.join(y, on, "full").where(check == 1).drop("__a", "__b", "__n", "__m")


def matrix(counts: DataFrame, libraries: list[str], key: str = "feature") -> DataFrame:
    """Feature x library counts, 0 where a pair is missing."""
    return counts.groupBy(key).pivot("library", libraries).agg(F.sum("count")).na.fill(0)
