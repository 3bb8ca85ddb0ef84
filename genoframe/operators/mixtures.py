"""Mixtures of contexts that no task can hold: each step is one aggregation over the distinct values with their counts."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import gaussian_log_density
from .catalog import MIN_N, STARTS, STEPS, TOLERANCE, Mixture, _density, judged, unfitted
from .contacts import settled

QUANTILES = sorted({q for start in STARTS for q in start})


def _beside(cells: DataFrame, rows: Iterable[tuple], columns: str) -> DataFrame:
    """``cells`` with figures of their context: a few rows a context that the driver made, inline in the plan, so that a step starts no Python worker."""
    literal = lambda v: f"{v!r}D" if isinstance(v, float) else f"{v!r}L"
    inline = ", ".join(f"({', '.join(map(literal, r))})" for r in rows)
    return cells.join(F.broadcast(cells.sparkSession.sql(f"SELECT * FROM VALUES {inline} AS t({columns})")), "g")


def _quantiles(cells: DataFrame, n: dict[int, int]) -> dict[int, dict[float, float]]:
    """Exact quantiles (linear between ranks) of each context.

    ``cells`` (g, x, c) are range-partitioned by (g, x).  Counts of partitions
    tell which of them holds a rank; only those are sorted.
    """
    ranks = [(g, k) for g, m in n.items() for k in sorted({min(int((m - 1) * q) + d, m - 1) for q in QUANTILES for d in (0, 1)})]
    at = cells.withColumn("p", F.spark_partition_id())
    parts = at.groupBy("g", "p").agg(F.sum("c").alias("size")).withColumn("before", F.sum("size").over(Window.partitionBy("g").orderBy("p")) - F.col("size"))
    asked = _beside(parts, ranks, "g, k").where("before <= k and k < before + size")
    near = at.join(asked.select("g", "p", "before").distinct(), ["g", "p"])
    upto = near.withColumn("upto", F.col("before") + F.sum("c").over(Window.partitionBy("g", "p").orderBy("x")))
    found = {(r.g, r.k): r.x for r in _beside(upto, ranks, "g, k").where("upto - c <= k and k < upto").select("g", "k", "x").collect()}
    out: dict[int, dict[float, float]] = {}
    for g, m in n.items():
        for q in QUANTILES:
            k = int((m - 1) * q)
            a, b = found[g, k], found[g, min(k + 1, m - 1)]
            out.setdefault(g, {})[q] = a + (b - a) * ((m - 1) * q - k)
    return out


def _expectation(cells: DataFrame, fits: dict[tuple[int, int], Mixture]) -> dict[tuple[int, int], tuple[float, np.ndarray]]:
    """Log-likelihood and the sums of each component (shares, share times x, share times x squared) of every fit, in one job."""
    rows = [(g, s, *map(float, (*m.weight, *m.mean, *m.variance))) for (g, s), m in fits.items()]
    x = _beside(cells, rows, "g, s, w0, w1, m0, m1, v0, v1")
    low, top = (F.log(f"w{i}") + gaussian_log_density("x", f"m{i}", f"v{i}") for i in (0, 1))
    x = x.withColumn("low", low).withColumn("odds", top - F.col("low"))
    x = x.withColumn("high", 1 / (1 + F.exp(-F.greatest(F.least("odds", F.lit(700.0)), F.lit(-700.0)))))
    likelihood = F.col("low") + F.greatest("odds", F.lit(0.0)) + F.log1p(F.exp(-F.abs("odds")))
    shares = ((1 - F.col("high")) * F.col("c"), F.col("high") * F.col("c"))
    sums = [F.sum(share * power).alias(f"s{i}{j}") for i, share in enumerate(shares) for j, power in enumerate((F.lit(1.0), F.col("x"), F.col("x") * F.col("x")))]
    got = x.groupBy("g", "s").agg(F.sum(likelihood * F.col("c")).alias("likelihood"), *sums).collect()
    return {(r.g, r.s): (r.likelihood, np.array([[r[f"s{i}{j}"] for j in range(3)] for i in (0, 1)])) for r in got}


def _climbed(cells: DataFrame, fits: dict[tuple[int, int], Mixture], floor: dict[int, float]) -> dict[tuple[int, int], tuple[float, Mixture]]:
    """All fits at their end, with the log-likelihood before the last step.  A step is one job for all that still rise."""
    was, done = dict.fromkeys(fits, -np.inf), {}
    for _ in range(STEPS):
        for at, (likelihood, sums) in _expectation(cells, fits).items():
            if (sums[:, 0] <= 1e-8).any():
                done[at] = likelihood, fits.pop(at)
                continue
            fits[at] = fits[at].maximised(sums, floor[at[0]])
            if likelihood - was[at] <= TOLERANCE * (1 + abs(likelihood)):
                done[at] = likelihood, fits.pop(at)
            else:
                was[at] = likelihood
        if not fits:
            break
    return done | {at: (was[at], m) for at, m in fits.items()}


def fit_large(values: DataFrame, names: list, value: str = "log10_signal") -> list[dict]:
    """The rows of ``fit_mixtures`` for the contexts ``names``, by the same steps.

    Equal values are one row with a count, range-partitioned by context and
    value and written once; no task holds a context.  The driver keeps some
    twenty numbers a context.  Nulls and values that are not finite are left
    out.
    """
    spark = values.sparkSession
    kind = values.schema["context"].dataType.simpleString()
    numbers = F.broadcast(spark.createDataFrame(list(enumerate(names)), f"g long, name {kind}"))
    x = F.col(value).cast("double")
    finite = values.join(numbers, F.col("context").eqNullSafe(F.col("name"))).where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    counted = finite.groupBy("g", (x + F.lit(0.0)).alias("x")).agg(F.count("*").cast("double").alias("c"))
    cells = settled(counted.repartitionByRange("g", "x"))
    moments = {r.g: (int(r.n), r.mean) for r in cells.groupBy("g").agg(F.sum("c").alias("n"), (F.sum(F.col("c") * F.col("x")) / F.sum("c")).alias("mean")).collect()}
    means = [(g, mean) for g, (n, mean) in moments.items() if n >= MIN_N]
    away = F.col("x") - F.col("mean")
    square = {r.g: r.v for r in _beside(cells, means, "g, mean").groupBy("g").agg((F.sum(F.col("c") * away * away) / F.sum("c")).alias("v")).collect()} if means else {}
    n = {g: moments[g][0] for g, v in square.items() if v > 1e-12}
    fits, floor = {}, {g: max(square[g] * 1e-6, 1e-8) for g in n}
    for g, at in (_quantiles(cells, n) if n else {}).items():
        for s, (a, b) in enumerate(STARTS):
            fits[g, s] = Mixture((0.5, 0.5), (at[a], at[b]), (max(square[g], floor[g]),) * 2)
    ends = _climbed(cells, fits, floor) if fits else {}
    out = []
    for g, name in enumerate(names):
        if g not in n:
            row = unfitted(moments.get(g, (0, 0.0))[0])
        else:
            likelihood, fit = max(((v, m.ordered()) for (h, _), (v, m) in sorted(ends.items(), key=lambda e: e[0]) if h == g), key=lambda e: e[0])
            one = n[g] * (float(_density(np.float64(0.0), 0.0, square[g])) - 0.5)
            row = judged(n[g], one, likelihood, fit)
        out.append(row | {"context": name})
    return out
