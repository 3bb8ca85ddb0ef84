"""Table rules around the science: typed defaults, manifests, decisions, checks, review and report tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F


def typed_defaults(df: DataFrame, types: Mapping[str, str], defaults: Mapping[str, object], by: str | None = None, by_value: Mapping[str, Mapping[str, object]] | None = None) -> DataFrame:
    """Text columns as types: blanks are null, then the default of the row's ``by`` value, then the general one."""
    out = df
    for name, kind in types.items():
        value = F.expr(f"try_cast(nullif(trim(`{name}`), '') as {kind})")
        options: list[Column] = [value]
        of = {k: v[name] for k, v in (by_value or {}).items() if name in v}
        if of and by:
            options.append(F.create_map(*[F.lit(x) for pair in of.items() for x in pair])[F.col(by)].cast(kind))
        if name in defaults:
            options.append(F.lit(defaults[name]).cast(kind))
        out = out.withColumn(name, F.coalesce(*options))
    return out


def type_violations(df: DataFrame, types: Mapping[str, str], key: str) -> DataFrame:
    """(key, column, value) where a text that is not blank does not parse."""
    bad = [F.when((F.trim(F.col(c)) != "") & F.expr(f"try_cast(`{c}` as {k})").isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))) for c, k in types.items()]
    return df.select(key, F.explode(F.filter(F.array(*bad), lambda x: x.isNotNull())).alias("v")).select(key, "v.*")


def distinct_first_seen(df: DataFrame, value: str, sequence: str) -> DataFrame:
    """Distinct values with the first position of each."""
    return df.groupBy(value).agg(F.min(sequence).alias("first_seen"))


def inconsistent_groups(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """Groups in which a column that should be constant is not: key and the columns' distinct counts."""
    counts = df.groupBy(key).agg(*[F.countDistinct(c).alias(f"{c}_n") for c in columns])
    return counts.where(" or ".join(f"{c}_n > 1" for c in columns))


def zip_explode(df: DataFrame, columns: tuple[str, ...], separator: str = ";") -> DataFrame:
    """Parallel lists in text columns as rows, with their position."""
    lists = F.arrays_zip(*[F.split(F.col(c), separator).alias(c) for c in columns])
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.posexplode(lists).alias("position", "z")).select(*rest, "position", "z.*")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], value: str, rank: Column, order: str = "priority") -> DataFrame:
    """Rows of both tables, one for each key: the one of the highest rank, the new one on ties (never a downgrade)."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1))).withColumn(order, rank)
    return both.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc(), F.col("__new").desc(), value))).where("__k = 1").drop("__k", "__new")


def decisions(manifest: DataFrame, decided: DataFrame, key: str, allowed: tuple[str, ...]) -> DataFrame:
    """Manifest rows with their decision and a problem: missing, repeated, unknown key or unknown value (null: none)."""
    votes = decided.groupBy(key).agg(F.count("*").alias("n"), F.max("decision").alias("decision"))
    x = manifest.select(key, F.lit(True).alias("listed")).join(votes, key, "full")
    problem = F.when(F.col("listed").isNull(), "unknown_key").when(F.col("n").isNull(), "missing_decision").when(F.col("n") > 1, "repeated_decision").when(~F.col("decision").isin(*allowed), "unknown_decision")
    return x.select(key, "decision", problem.alias("problem"))


def missing_keys(needed: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys that are needed and not known."""
    return needed.select(key).distinct().join(known.select(key), key, "left_anti")


def union_disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of both; fails on a key that stands twice."""
    both = a.unionByName(b).withColumn("__n", F.count("*").over(Window.partitionBy(key)))
    return both.where(F.when(F.col("__n") == 1, True).otherwise(F.raise_error(F.lit("a key is in both tables")).cast("boolean"))).drop("__n")


def eligibility(samples: DataFrame, minimum: int, role: str = "treatment") -> DataFrame:
    """Per (assay, context): libraries of the role, their sorted list, and whether they are enough."""
    x = samples.where(F.col("role") == role).groupBy("assay", "context").agg(F.countDistinct("library").alias("libraries"), F.array_join(F.array_sort(F.collect_set("library")), ",").alias("library_ids"))
    return x.withColumn("eligible", F.col("libraries") >= minimum)


def digest_rows(df: DataFrame, by: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """A digest of each group's rows that does not depend on their order: SHA-256 over the sorted row digests."""
    row = F.sha2(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)
    return df.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), "\n"), 256).alias("digest"), F.count("*").alias("rows"))


def parse_log(df: DataFrame, patterns: Mapping[str, str], text: str = "text") -> DataFrame:
    """Numbers that regular expressions find in whole log texts; null where one does not match."""
    return df.select(*[c for c in df.columns if c != text], *[F.expr("1").alias("_")], *[F.expr("try_cast(nullif(regexp_extract(`" + text + "`, '" + p.replace("\\", "\\\\").replace("'", "\\'") + "', 1), '') as double)").alias(n) for n, p in patterns.items()]).drop("_")


def qc_review(manifest: DataFrame, metrics: DataFrame, histograms: DataFrame, profiles: DataFrame, key: str = "library") -> DataFrame:
    """Manifest rows with metrics (needed) and, where there are any, fragment and profile summaries."""
    return manifest.join(metrics, key).join(histograms, key, "left").join(profiles, key, "left")


def class_pivot(catalog: DataFrame, classes: list[str], by: str = "context", column: str = "regulatory_class") -> DataFrame:
    """Counts by class as columns, and their sum."""
    wide = catalog.groupBy(by).pivot(column, classes).count().na.fill(0)
    return wide.withColumn("total", sum((F.col(f"`{c}`") for c in classes), F.lit(0)))


def static_violations(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """Keys whose rows disagree in a column, with the column's name."""
    x = df.groupBy(key).agg(*[(F.min(c) != F.max(c)).alias(c) for c in columns])
    found = F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in columns]), lambda v: v.isNotNull())
    return x.select(key, F.explode(found).alias("column"))


def compare_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Every key of either table with ``where``: both, left or right; the tables hold the same set if all are both."""
    x, y = (t.select(key).distinct().withColumn(n, F.lit(True)) for t, n in ((a, "x"), (b, "y")))
    where = F.when(F.col("x") & F.col("y"), "both").when(F.col("x"), "left").otherwise("right")
    return x.join(y, key, "full").na.fill(False, ["x", "y"]).select(key, where.alias("where"))


def require_same_keys(a: DataFrame, b: DataFrame, key: str, message: str) -> DataFrame:
    """The keys that both tables hold; fails with ``message`` on a key that only one has."""
    return compare_keys(a, b, key).where(F.when(F.col("where") == "both", True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))).select(key)


def top_rows(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of a total order, as a report shows them; each task passes on at most ``n``."""
    return df.orderBy(*order).limit(n)


def medians(df: DataFrame, by: tuple[str, ...], values: tuple[str, ...]) -> DataFrame:
    """Count and, for each value, its median over the rows that have one."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.percentile(v, 0.5).alias(f"median_{v}") for v in values])


def active_class_counts(summary: DataFrame, contexts: list[str], classes: list[str]) -> DataFrame:
    """Elements of the high component by context and class, zeros included, from summary counts."""
    high = summary.where("mixture_component = 'high'").groupBy("context", "regulatory_class").agg(F.sum("element_n").alias("element_n"))
    grid = summary.sparkSession.createDataFrame([(c, k) for c in contexts for k in classes], "context string, regulatory_class string")
    return grid.join(high, ["context", "regulatory_class"], "left").withColumn("element_n", F.coalesce("element_n", F.lit(0)))


def report_warnings(mixtures: DataFrame, excluded: DataFrame, accepted: DataFrame, qc: DataFrame) -> DataFrame:
    """(kind, warning): contexts whose mixture failed its guards, rejected libraries, and accepted ones without metrics.

    ``mixtures``: context, mixture_supported, support_reason; ``excluded``:
    library, reason; ``accepted`` and ``qc``: library.
    """
    failed = mixtures.where("not mixture_supported").select(F.lit("mixture").alias("kind"), F.concat_ws(": ", "context", "support_reason").alias("warning"))
    rejected = excluded.select(F.lit("rejected").alias("kind"), F.concat(F.col("library"), F.lit(" rejected: "), F.coalesce("reason", F.lit("no reason recorded"))).alias("warning"))
    missing = missing_keys(accepted, qc, "library").select(F.lit("metrics").alias("kind"), F.concat(F.lit("no metrics for "), "library").alias("warning"))
    return failed.unionByName(rejected).unionByName(missing)


def qc_metrics(manifest: DataFrame, flagstat: DataFrame, frip: DataFrame, peaks: DataFrame) -> DataFrame:
    """One row for each sample of the manifest (sample, assay, layout, role): alignment counts, FRiP and peak number, null where there are none."""
    out = manifest.join(flagstat.select("sample", "total_alignments", "mapped_alignments", "properly_paired"), "sample", "left")
    out = out.join(frip.select("sample", "frip_numerator", "frip_denominator", "frip"), "sample", "left")
    return out.join(peaks.groupBy("sample").agg(F.count("*").alias("peak_count")), "sample", "left")
