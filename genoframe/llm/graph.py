"""Connected components with DataFrame joins: alternating large-star and small-star steps.

Edges never leave the executors; the driver sees a count and a checksum for
each round.  Every round is written to the shared folder, so its lineage ends
there, and the table of the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .work import Work


def _mark(df: DataFrame) -> tuple:
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, work: Work, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Return (node, component) for every node on an edge; component is the smallest node reachable.

    Null ends and loops are ignored; an empty edge table gives an empty result.
    Raises if ``rounds`` do not suffice (a chain of n nodes needs about log2 n).
    """
    kind = edges.schema[a].dataType
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    now = work.save(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0] and rounds:
        rounds -= 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = work.save(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        work.drop(now)
        now, was, mark = new, mark, _mark(new)
        if was == mark:
            break
    else:
        if mark[0]:
            raise RuntimeError("connected_components: not settled in the given rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").cast(kind).alias("node"), F.col("v").alias("component")).distinct()
    return stars.union(roots)
