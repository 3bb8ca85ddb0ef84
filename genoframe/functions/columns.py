"""Scalar rules as Column expressions; none of them leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded(value: Column, valid: Column, message: str) -> Column:
    """``value`` where ``valid`` holds; anywhere else the query fails with ``message``."""
    return F.when(valid, value).otherwise(F.raise_error(F.lit(message)).cast("double"))


def cpm_per_kb(raw: ColumnLike, total: ColumnLike, width: ColumnLike) -> Column:
    """Counts per million units and kilobase; fails unless total and width are positive."""
    raw, total, width = col(raw), col(total), col(width)
    return guarded(raw * 1e9 / (total.cast("double") * width), (total > 0) & (width > 0), "totals and widths must be positive")


def normalized_cpm(raw: ColumnLike, effective: ColumnLike, width: ColumnLike) -> Column:
    """The same with an effective library size; null where the width is 0."""
    return F.when(col(width) > 0, col(raw) * 1e9 / (col(effective) * col(width)))


def geometric_mean(a: ColumnLike, b: ColumnLike) -> Column:
    return F.sqrt(col(a) * col(b))


# Class labels, with their track colours, and state and tier labels, as the published tables spell them.
CLASS_COLORS = {
    "promoter_associated": "215,48,39",
    "proximal_enhancer_like": "253,174,97",
    "distal_enhancer_like": "69,117,180",
    "unclassified_no_tss_on_contig": "117,112,179",
}
STATES = ("inactive_in_context", "active_high_mixture", "low_h3k27ac_mixture", "accessible_no_h3k27ac_signal", "mixture_unavailable")
TIERS = ("no_h3k27ac_signal", "high_z_gt_1.64", "moderate_z_gt_1", "lower_z_le_1")


def distance_class(distance: ColumnLike) -> Column:
    """By the distance to the nearest start site: up to 500 bp, up to 1000 bp, beyond, or none on the contig."""
    promoter, proximal, distal, none = CLASS_COLORS
    d = col(distance)
    return F.when(d.isNull(), none).when(d <= 500, promoter).when(d <= 1000, proximal).otherwise(distal)


def activity_state(member: ColumnLike, signal: ColumnLike, posterior: ColumnLike) -> Column:
    """State of an element in a context, from membership, signal and the posterior (null without a fit or a signal)."""
    inactive, high, low, silent, unavailable = STATES
    return F.when(~col(member), inactive).when(col(posterior) >= 0.5, high).when(col(posterior).isNotNull(), low).when(col(signal) <= 0, silent).otherwise(unavailable)


def z_tier(signal: ColumnLike, z: ColumnLike) -> Column:
    silent, high, moderate, lower = TIERS
    return F.when(col(signal) <= 0, silent).when(col(z) > 1.64, high).when(col(z) > 1, moderate).otherwise(lower)


def powerlaw_expected(distance: ColumnLike, scale: ColumnLike, gamma: ColumnLike, minimum: int | Column) -> Column:
    return col(scale) * F.pow(F.greatest(col(distance), F.lit(minimum)).cast("double"), col(gamma))


def gaussian_log_density(x: ColumnLike, mean: ColumnLike, variance: ColumnLike) -> Column:
    x, mean, variance = col(x), col(mean), col(variance)
    return -0.5 * (F.log(F.lit(2.0) * F.pi() * variance) + (x - mean) * (x - mean) / variance)


def posterior_high(x: ColumnLike, low: tuple, high: tuple) -> Column:
    """Posterior of the high component; low and high are (weight, mean, variance); by log-sum-exp; null where any of them is."""
    a = F.log(col(low[0])) + gaussian_log_density(x, low[1], low[2])
    b = F.log(col(high[0])) + gaussian_log_density(x, high[1], high[2])
    return F.when((a - b).isNotNull(), 1 / (1 + F.exp(F.greatest(F.least(a - b, F.lit(700.0)), F.lit(-700.0)))))


def sig10(x: ColumnLike) -> Column:
    """Rounded to ten significant digits, as tables written with %.10g read back (a decimal half goes up)."""
    return F.when(col(x).isNotNull(), F.format_string("%.9e", col(x))).try_cast("double")


def bed9_color(regulatory_class: ColumnLike) -> Column:
    return F.create_map(*[F.lit(x) for pair in CLASS_COLORS.items() for x in pair])[col(regulatory_class)]


def bed9_score(posterior: ColumnLike) -> Column:
    """A thousand times the posterior, halves to even; 0 without one."""
    return F.coalesce(F.bround(1000 * col(posterior)), F.lit(0)).cast("int")


def has_flags(flag: ColumnLike, required: int, excluded: int) -> Column:
    """All required bits set and no excluded one."""
    return (col(flag).bitwiseAND(required) == required) & (col(flag).bitwiseAND(excluded) == 0)


def numbered(prefix: str, digits: int, n: ColumnLike) -> Column:
    """An identifier such as DHS0000001."""
    return F.concat(F.lit(prefix), F.lpad(col(n).cast("string"), digits, "0"))


def joined(values: ColumnLike, separator: str = ";") -> Column:
    """Sorted values of an array as one string."""
    return F.array_join(F.array_sort(col(values)), separator)
