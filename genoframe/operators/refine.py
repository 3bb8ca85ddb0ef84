"""Progressive refinement of wide candidate peaks by rising score thresholds."""

from __future__ import annotations

import math
from bisect import bisect_left
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .intervals import containment_join
from .streams import map_groups

SHAPE = "chrom string, candidate_id long, kind string, start long, end long, score double, exponent int"


@dataclass
class _Island:
    """A run of segments that are all active up to ``level``, and the islands that are left of it beyond."""

    start: int
    end: int
    score: float
    level: int
    inner: list[_Island]


def _islands(rows: list[tuple], gap: int) -> tuple[list[_Island], list[_Island]]:
    """The islands of all segments, by start, and those of the highest level.

    The tide falls: segments surface from the highest level down, and each
    joins what already stands within ``gap`` of it.  An island that a level
    changes becomes a new one around those it has swallowed.
    """
    land: list[_Island] = []  # what stands above the water, by start, farther apart than the gap
    top: list[_Island] = []
    for level in sorted({r[3] for r in rows}, reverse=True):
        for start, end, score, _ in (r for r in rows if r[3] == level):
            new = _Island(start, end, score, level, [])
            lo = hi = bisect_left(land, start, key=lambda x: x.start)
            if lo and land[lo - 1].end + gap >= start:
                lo -= 1
            reach = max([end, *(x.end for x in land[lo:hi])])
            while hi < len(land) and land[hi].start <= reach + gap:
                reach = max(reach, land[hi].end)
                hi += 1
            for x in land[lo:hi]:
                new.start, new.end, new.score = min(new.start, x.start), max(new.end, x.end), max(new.score, x.score)
                new.inner += x.inner if x.level == level else [x]
            land[lo:hi] = [new]
        top = top or list(land)
    return land, top


def refine_one(rows: list[tuple], low: int, high: int, shortest: int, longest: int, gap: int) -> list[tuple]:
    """(kind, start, end, score, exponent) from one candidate's segments (start, end, score, last exponent), by start.

    An island is as high as its lowest segment; the exponent at which it stands
    alone is one beyond the level of the island around it.
    """
    outer, top = _islands(rows, gap)
    chosen: list[tuple] = []
    level = [(island, low) for island in outer]
    while level:
        fits = [(i, e) for i, e in level if shortest <= i.end - i.start <= longest]
        chosen += [("selected", i.start, i.end, i.score, e) for i, e in fits]
        level = [(x, i.level + 1) for i, _ in level if i.end - i.start > max(longest, shortest - 1) for x in i.inner]
    chosen.sort(key=lambda c: c[1])
    starts = [c[1] for c in chosen]
    for i in top if rows and max(r[3] for r in rows) == high else []:
        k = bisect_left(starts, i.end)  # what is chosen lies apart, so only the last that starts before the end can touch
        if i.score > high and i.end - i.start >= shortest and not (k and chosen[k - 1][2] > i.start):
            chosen.append(("excluded", i.start, i.end, i.score, high))
    return sorted(chosen, key=lambda c: (c[1], c[2]))


def refine_peaks(candidates: DataFrame, segments: DataFrame, low: int = 2, high: int = 325, shortest: int = 50, longest: int = 400, gap: int = 1, width: int = 4096) -> DataFrame:
    """Split candidates (chrom, start, end, candidate_id) along scored segments (chrom, start, end, score).

    Segments above ``low`` that lie wholly in a candidate form components; one
    too long is split at the next threshold where something of it drops out,
    until its parts are between ``shortest`` and ``longest``.  What still
    scores above ``high`` without a part is excluded.  One candidate is a
    group: its segments are bounded by its length.
    """
    last = F.when(F.isnan("score") | (F.col("score") == float("inf")), F.lit(high)).otherwise(F.least(F.lit(high), F.ceil("score").cast("int") - 1))
    inside = containment_join(segments.where(F.col("score") > low).withColumn("last", last), candidates, width)
    rows = inside.select("chrom", F.col("b_candidate_id").alias("candidate_id"), "start", "end", "score", "last")

    def run(inside: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (chrom, candidate), part in groupby(inside.itertuples(index=False, name=None), itemgetter(0, 1)):
            found = refine_one(sorted(s[2:] for s in part), low, high, shortest, longest, gap)
            out += [(chrom, candidate, *p) for p in found]
        return pd.DataFrame(out, columns=["chrom", "candidate_id", "kind", "start", "end", "score", "exponent"])

    return map_groups(rows, ["chrom", "candidate_id"], ["chrom", "candidate_id"], run, SHAPE)


def peak_score(score: float) -> int:
    """BED score of a refined peak: ten times the score, half-even, at most 1000."""
    return min(1000, round(10 * score)) if math.isfinite(score) else 1000
