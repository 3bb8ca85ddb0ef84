"""From alignment records to counting units, and read-level summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import has_flags
from .contacts import settled
from .intervals import TILE, interval_union, overlap_join

# SAM flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 1, 2, 4, 8, 16, 256, 512, 1024, 2048


def excluded_flags(paired: bool, drop_duplicates: bool) -> int:
    return UNMAPPED + SECONDARY + QC_FAIL + SUPPLEMENTARY + MATE_UNMAPPED * paired + DUPLICATE * drop_duplicates


def filter_alignments(df: DataFrame, min_mapq: int, paired: bool = True, drop_duplicates: bool = True, mitochondrial: str = "chrM") -> DataFrame:
    """Records of good quality on nuclear chromosomes; pairs must be proper."""
    good = has_flags("flag", PROPER * paired, excluded_flags(paired, drop_duplicates))
    return df.where(good & (F.col("mapq") >= min_mapq) & (F.col("chrom") != mitochondrial))


def short_fragments(df: DataFrame, below: int = 150) -> DataFrame:
    """Records with 0 < |tlen| < ``below``."""
    return df.where((F.col("tlen") != 0) & (F.abs("tlen") < below))


def mark_duplicates(df: DataFrame, keys: tuple[str, ...], order: tuple) -> DataFrame:
    """``duplicate`` is true for all but the first row, by ``order``, of each key."""
    return df.withColumn("duplicate", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) > 1)


def _summed(cigar: Column, operations: str) -> Column:
    numbers = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{operations}]"), F.lit(1))
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def unclipped_five_prime(pos: Column, cigar: Column, reverse: Column) -> Column:
    """Where a read's 5' end would stand if its clipped bases were aligned (from 1); ``pos`` is the leftmost aligned base."""
    lead, trail = (F.regexp_extract(cigar, p, 1) for p in (r"^((?:\d+[SH])+)", r"((?:\d+[SH])+)$"))
    return F.when(reverse, pos - 1 + _summed(cigar, "MDN=X") + _summed(trail, "SH")).otherwise(pos - _summed(lead, "SH"))


def mark_template_duplicates(records: DataFrame, by: tuple[str, ...] = ("library",), read: str = "read") -> DataFrame:
    """``records`` with ``duplicate``, by whole templates: pairs against pairs, single reads against both.

    Records need ``by``, the read name, flag, chrom, pos (from 1), cigar and
    quality (summed over good bases).  Two pairs are copies if both unclipped
    5' ends and strands agree; the one of the highest summed quality stays (of
    equals, the one whose name comes first).  A read whose mate is not mapped
    is a copy if a pair has an end in its place and strand, or a better such
    read.  Only primary mapped records of good quality are compared; the mark
    of a template is that of all its mapped records, secondary and
    supplementary ones too.  Ends of equal place are taken together with
    partial aggregates, so a pile of copies is no single task's.  Templates
    are written once, to the checkpoint folder, since five steps read them.
    """
    keys = [*by, read]
    bit = lambda b: F.col("flag").bitwiseAND(b) != 0
    primary = records.where(~bit(UNMAPPED + SECONDARY + SUPPLEMENTARY + QC_FAIL))
    end = F.struct("chrom", unclipped_five_prime(F.col("pos"), F.col("cigar"), bit(REVERSE)).alias("at"), bit(REVERSE).alias("reverse"))
    templates = settled(primary.withColumn("end", end).groupBy(*keys).agg(F.min("end").alias("lo"), F.max("end").alias("hi"), F.count("*").alias("n"), F.sum("quality").alias("quality")))

    def best(rows: DataFrame, place: list[str]) -> DataFrame:
        # The highest quality, then the first name, nulls last, in one aggregate.
        order = F.struct(F.col("quality").isNull().alias("none"), (-F.col("quality")).alias("least"), F.col(read).isNull().alias("unnamed"), read)
        return rows.groupBy(*by, *place).agg(F.min(order).getField(read).alias("kept"))

    pairs, singles = templates.where("n > 1"), templates.where("n = 1")
    marked = pairs.join(best(pairs, ["lo", "hi"]), [*by, "lo", "hi"]).select(*keys, (~F.col(read).eqNullSafe(F.col("kept"))).alias("duplicate"))
    taken = pairs.select(*by, F.explode(F.array("lo", "hi")).alias("lo")).distinct().withColumn("taken", F.lit(True))
    alone = singles.join(best(singles, ["lo"]), [*by, "lo"]).join(taken, [*by, "lo"], "left")
    marked = marked.unionByName(alone.select(*keys, (~F.col(read).eqNullSafe(F.col("kept")) | F.col("taken").isNotNull()).alias("duplicate")))
    out = records.join(marked, keys, "left")
    return out.withColumn("duplicate", F.coalesce(F.col("duplicate") & ~bit(UNMAPPED), F.lit(False)))


def insertions(df: DataFrame, plus: int = 0, minus: int = 0) -> DataFrame:
    """One-base units at the 5' end: start on +, end-1 on -, shifted by ``plus`` and ``minus`` first."""
    at = F.when(F.col("strand") == "+", F.col("start") + plus).otherwise(F.col("end") - 1 + minus)
    return df.withColumns({"start": at, "end": at + 1})


def fragments(df: DataFrame) -> DataFrame:
    """Fragments of pairs, from the leftmost mate (tlen > 0, pos one-based)."""
    return df.where("tlen > 0").withColumn("start", F.col("pos") - 1).withColumn("end", F.col("pos") - 1 + F.col("tlen"))


def extend_reads(df: DataFrame, length: int, sizes: DataFrame) -> DataFrame:
    """Reads extended from their 5' end to ``length``, cut to the chromosome; fails on a longer read."""
    x = df.join(F.broadcast(sizes.select("chrom", "size")), "chrom")
    too_long = F.raise_error(F.lit("a read is longer than the fragment length")).cast("long")
    start = F.when(F.col("end") - F.col("start") > length, too_long).when(F.col("strand") == "+", F.col("start")).otherwise(F.greatest(F.col("end") - length, F.lit(0)))
    end = F.when(F.col("strand") == "+", F.least(F.col("start") + length, F.col("size"))).otherwise(F.col("end"))
    return x.withColumn("__s", start).withColumn("end", end).withColumn("start", F.col("__s")).drop("__s", "size")


def histogram(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, value).agg(F.count("*").alias("n"))


def fragment_summary(hist: DataFrame, value: str = "length", by: tuple[str, ...] = ()) -> DataFrame:
    """Total, lower median, share below 150 and share in 180..250 of a histogram (value, n)."""
    order = Window.partitionBy(*by).orderBy(value)
    x = hist.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    middle = F.min(F.when(F.col("upto") >= F.expr("(total + 1) div 2"), F.col(value)))
    return x.groupBy(*by).agg(
        F.sum("n").alias("fragments"), middle.alias("median_length"),
        (F.sum(F.when(F.col(value) < 150, F.col("n")).otherwise(0)) / F.sum("n")).alias("fraction_below_150"),
        (F.sum(F.when(F.col(value).between(180, 250), F.col("n")).otherwise(0)) / F.sum("n")).alias("fraction_180_250"),
    )


def frip(units: DataFrame, peaks: DataFrame, by: tuple[str, ...] = ("library",), width: int = 1024) -> DataFrame:
    """Units that overlap at least one peak, of all units.

    A unit counts at the first run of the peaks' union that it meets, so it
    counts once, and units need no id.
    """
    runs = interval_union(peaks).withColumn("tile", F.floor(F.col("start") / TILE))
    ends = runs.groupBy("chrom", "tile").agg(F.max("end").alias("last"))  # runs lie apart, so the furthest end is the last run's
    carried = ends.select("chrom", "tile", F.lag("last").over(Window.partitionBy("chrom").orderBy("tile")).alias("carried"))
    own = F.lag("end").over(Window.partitionBy("chrom", "tile").orderBy("start"))
    runs = runs.join(carried, ["chrom", "tile"]).withColumn("before", F.coalesce(own, "carried"))
    hits = overlap_join(units.select(*by, "chrom", "start", "end"), runs.select("chrom", "start", "end", "before"), width).where("b_before is null or b_before <= start")
    inside = hits.groupBy(*by).agg(F.count("*").alias("frip_numerator"))
    total = units.groupBy(*by).agg(F.count("*").alias("frip_denominator"))
    out = total.join(inside, list(by), "left").withColumn("frip_numerator", F.coalesce("frip_numerator", F.lit(0)))
    return out.withColumn("frip", F.col("frip_numerator") / F.col("frip_denominator"))


def flagstat(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Record counts by flag bit."""
    bit = lambda b: F.col("flag").bitwiseAND(b) == b
    return df.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(~bit(UNMAPPED)).alias("mapped"), F.count_if(bit(DUPLICATE)).alias("duplicates"), F.count_if(bit(PAIRED)).alias("paired"),
        F.count_if(bit(PAIRED) & bit(PROPER) & ~bit(UNMAPPED)).alias("properly_paired"), F.count_if(bit(SECONDARY)).alias("secondary"), F.count_if(bit(SUPPLEMENTARY)).alias("supplementary"),
    )


def idxstats(df: DataFrame, sizes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mapped and unmapped records of every chromosome of ``sizes`` (chrom, size), zeros included, and of those it does not name (size null)."""
    unmapped = F.col("flag").bitwiseAND(UNMAPPED) == UNMAPPED
    found = df.groupBy(*by, "chrom").agg(F.count_if(~unmapped).alias("mapped"), F.count_if(unmapped).alias("unmapped"))
    grid = sizes.select("chrom", "size").crossJoin(df.select(*by).distinct()) if by else sizes.select("chrom", "size")  # chromosomes x libraries is the result
    out = grid.join(found, [*by, "chrom"], "full")
    return out.select(*by, "chrom", "size", F.coalesce("mapped", F.lit(0)).alias("mapped"), F.coalesce("unmapped", F.lit(0)).alias("unmapped"))


def tss_enrichment(profile: DataFrame, by: tuple[str, ...] = (), center: int = 50, flank: int = 100, reach: int = 2000) -> DataFrame:
    """Largest bin within ``center`` bp over the mean of the outermost ``flank`` bp, from (offset, value); null if that is 0."""
    inner = F.max(F.when(F.abs("offset") <= center, F.col("value")))
    outer = F.avg(F.when(F.abs("offset") >= reach - flank, F.col("value")))
    return profile.groupBy(*by).agg(inner.alias("peak"), outer.alias("background")).withColumn("tss_enrichment", F.when(F.col("background") > 0, F.col("peak") / F.col("background")))


def assign_chunks(df: DataFrame, size: int, index: str = "record", by: tuple[str, ...] = ()) -> DataFrame:
    """Deterministic chunks of ``size`` records in file order; mates with the same record number share a chunk."""
    return df.withColumn("chunk", F.expr(f"{index} div {size}"))


def pool_units(units: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Replicates together: units at the same place are one row with a count."""
    return units.groupBy(*by, "chrom", "start", "end").agg(F.count("*").alias("units"))


def validate_fastq(lines: DataFrame) -> DataFrame:
    """(record, violation) for the lines of a file: (line, text), line from 0.

    A record is four lines: @ header, sequence, + separator, as many quality
    characters as bases.
    """
    four = lines.withColumn("record", F.expr("line div 4")).withColumn("k", F.expr("line % 4"))
    at = lambda i: F.max(F.when(F.col("k") == i, F.col("text")))
    rows = four.groupBy("record").agg(F.count("*").alias("n"), *[at(i).alias(f"t{i}") for i in range(4)])
    checks = [
        ("incomplete_record", F.col("n") < 4), ("bad_header", ~F.startswith("t0", F.lit("@"))), ("bad_separator", ~F.startswith("t2", F.lit("+"))),
        ("bad_sequence", ~F.rlike("t1", F.lit("^[ACGTNacgtn.]+$"))), ("length_mismatch", F.length("t1") != F.length("t3")),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks]), lambda x: x.isNotNull())
    return rows.select("record", F.explode(found).alias("violation"))
