"""Shards cut from a Hilbert curve over quantised metadata, so that files prune in several dimensions.

Only numbers move: (curve index, text checksum, doc_id) rows are sorted by
range, ranks come from the partitions' row counts, and a shard is a run of
ranks.  Counts of shards are at most one apart whatever the data's skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .work import Work


def hilbert_index(cell: tuple[int, ...], bits: int) -> int:
    """Position of a cell on the Hilbert curve through a cube of side 2**bits (Gray-code transpose form)."""
    x, n = list(cell), len(cell)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ t) >> b & 1)
    return out


def curve(spark, dims: int, bits: int) -> DataFrame:
    """(cell, h) for all 2**(dims*bits) cells; cell packs the coordinates, the first highest."""
    side = 1 << bits
    if dims * bits > 15:
        raise ValueError("at most 2**15 cells")
    rows = []
    for cell in range(side**dims):
        at = tuple(cell >> bits * (dims - 1 - i) & (side - 1) for i in range(dims))
        rows.append((cell, hilbert_index(at, bits)))
    return spark.createDataFrame(rows, "cell int, h int")


def _ranked(rows: DataFrame, column: str, side: int) -> Column:
    """The coordinate of a value: its rank by frequency, and ``side`` - 1 for all but the ``side`` - 1 most frequent ones.

    Every frequent value has a coordinate of its own, so a file that leaves
    out a coordinate leaves out its value.  At most ``side`` - 1 values come to
    the driver.
    """
    top = rows.groupBy(column).agg(F.count("*").alias("c")).orderBy(F.col("c").desc(), column).limit(side - 1).collect()
    out = F.lit(side - 1)
    for i, r in reversed(list(enumerate(top))):
        out = F.when(F.col(column) == F.lit(r[0]), i).otherwise(out)
    return out


def hilbert_shards(docs: DataFrame, shards: int = 8, bits: int = 4, columns: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Deal documents into ``shards`` runs of the curve over ``columns`` (by rank of frequency) and the text's size (quantiles).

    ``docs`` needs doc_id, text and the columns.  Returns doc_id, size (UTF-8
    bytes plus 1; of a null text 1), text_crc32, h (curve index), law
    ('rows'), shard, slot (gapless from 0 in each shard) and grown_shard
    (null: the law does not keep rows in place when a shard is added).  Nulls
    in the columns are a value of their own; rows without doc_id come first in
    their cell; repeated rows each get a slot; equal texts of one cell are
    neighbours.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = Work(spark, "shards")
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    side = 1 << bits
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"q{i}") for i, c in enumerate(columns)],
    )
    rows = work.save(rows, "rows")
    cuts = rows.agg(F.percentile_approx("size", [i / side for i in range(1, side)], 10_000).alias("q")).first()["q"] or []
    step = sum((F.when(F.col("size") > c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    cell = step.cast("int")
    for i in range(len(columns)):
        cell = cell + _ranked(rows, f"q{i}", side) * (side ** (i + 1))
    table = F.broadcast(curve(spark, len(columns) + 1, bits))  # a fixed number of cells
    placed = rows.withColumn("cell", cell).join(table, "cell").select("h", "text_crc32", "doc_id", "size")
    dealt = placed.repartitionByRange("h", "text_crc32", "doc_id").sortWithinPartitions("h", "text_crc32", "doc_id")
    # The id counts rows within a partition below bit 33 and partitions above it; saved, so both stand still.
    dealt = work.save(dealt.withColumn("at", F.monotonically_increasing_id()), "dealt")
    part = F.shiftright("at", 33)
    counts = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("c"))  # one row for each partition
    before = counts.select("part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("c").over(Window.partitionBy()).alias("total"))
    ranked = dealt.withColumn("part", part).join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1))
    shard = F.expr(f"(rank * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", "h", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write documents as one folder for each shard, rows in curve order, so that files carry narrow ranges of each dimension.

    The shard takes the name ``shard``; repeated rows go where the first of them goes.
    """
    placed = hilbert_shards(docs, **options).groupBy("doc_id", "text_crc32").agg(F.min(F.struct("shard", "slot")).alias("__at")).withColumnsRenamed({"doc_id": "__id", "text_crc32": "__crc"})
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    out = docs.join(placed, F.col("doc_id").eqNullSafe(F.col("__id")) & (crc == F.col("__crc"))).drop("__id", "__crc").withColumn("shard", F.col("__at.shard"))
    out.repartitionByRange("shard", "__at").sortWithinPartitions("shard", "__at").drop("__at").write.partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: eight shards, all documents."""
    return hilbert_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
