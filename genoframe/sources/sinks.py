"""Writers: ordered tables, tracks, and metrics and provenance beside them."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import tempfile
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import bed9_color, bed9_score


def write_text_if_changed(path: str | Path, content: bytes | str) -> bool:
    """Replace a file in one step, and only if its content changes; returns whether it did."""
    data = content.encode() if isinstance(content, str) else content
    path = Path(path)
    if path.exists() and path.read_bytes() == data:
        return False
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    with os.fdopen(handle, "wb") as f:
        f.write(data)
    os.replace(name, path)
    return True


def write_gzip(path: str | Path, lines: Iterable[str]) -> bool:
    """A gzip file whose bytes depend on the lines alone (no name, no time); for exports that one machine reads."""
    return write_text_if_changed(path, gzip.compress("".join(lines).encode(), mtime=0))


def export_tsv(df: DataFrame, path: str, order: list[str | Column]) -> None:
    """A gzipped, headed TSV folder in a total order; each part is a run of the order, so it does not pass through one task."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "gzip").csv(path, sep="\t", header=True)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """The native form: Parquet, committed as a whole."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _line(*columns: Column) -> Column:
    return F.concat_ws("\t", *[c.cast("string") for c in columns]).alias("value")


def bed6(df: DataFrame) -> DataFrame:
    """Lines of a six-column BED from chrom, start, end, name."""
    return df.select(_line(F.col("chrom"), F.col("start"), F.col("end"), F.col("name"), F.lit(0), F.lit(".")))


def bed9(df: DataFrame) -> DataFrame:
    """Lines of a nine-column BED from a catalog row: id, chrom, start, end, regulatory_class, distance, posterior, component, supported, blacklist_overlap."""
    state = F.when(F.col("component") == "not_applicable", F.col("component")).otherwise(F.concat("component", F.lit("_mixture")))
    shown = F.coalesce(F.when(F.col("posterior").isNotNull(), F.format_string("%.5e", "posterior")).try_cast("double").cast("string"), F.lit("NA"))
    name = F.concat_ws(
        "|", F.col("id").cast("string"), F.col("regulatory_class"), F.concat(F.lit("tss_distance="), F.coalesce(F.col("distance").cast("string"), F.lit("NA"))), F.concat(F.lit("posterior_high="), shown), state,
        F.when(F.col("supported"), "supported").otherwise("warning"), F.when(F.col("blacklist_overlap") > 0, "blacklist_overlap").otherwise("blacklist_clear"),
    )
    return df.select(_line(F.col("chrom"), F.col("start"), F.col("end"), name, bed9_score("posterior"), F.lit("."), F.col("start"), F.col("end"), bed9_color("regulatory_class")))


def bed12(df: DataFrame) -> DataFrame:
    """Consensus peaks: six BED columns, then context, support_n, replicate_n, support_fraction, libraries, method."""
    return df.select(_line(*[F.col(c) for c in ("chrom", "start", "end", "name", "score", "strand", "context", "support_n", "replicate_n")], F.format_string("%.5e", "support_fraction").try_cast("double"), F.col("supporting_libraries"), F.col("peak_method")))


def bedgraph(df: DataFrame) -> DataFrame:
    return df.select(_line(*[F.col(c) for c in ("chrom", "start", "end", "value")]))


def content_digest(df: DataFrame, order: list[str]) -> str:
    """SHA-256 of a table's rows, whatever their order and files: the digests of its rows, summed by their sorted blocks.

    Blocks are the rows whose digest shares two leading digits, so at most 256 partial digests meet.
    """
    row = F.sha2(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in order]), 256)
    rows = df.select(row.alias("r")).groupBy("r").agg(F.count("*").alias("n")).withColumn("b", F.substring("r", 1, 2))
    # Sums of digest pieces do not depend on the order, so no block has to be held.
    pieces = [F.sum(F.pmod(F.conv(F.substring("r", 1 + 8 * i, 8), 16, 10).cast("long") * F.pmod(F.col("n"), F.lit(1 << 20)), F.lit(1 << 31))).alias(f"p{i}") for i in range(8)]
    parts = sorted(tuple(r) for r in rows.groupBy("b").agg(F.sum("n").alias("n"), *pieces).collect())
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def write_metrics(path: str | Path, df: DataFrame, measures: Mapping[str, Column], provenance: Mapping[str, object] | None = None) -> dict:
    """One aggregation of the table as JSON, with provenance, beside it."""
    row = df.agg(*[m.alias(n) for n, m in measures.items()]).first().asDict()
    write_text_if_changed(path, json.dumps({"metrics": row, "provenance": dict(provenance or {})}, indent=1, sort_keys=True, default=str) + "\n")
    return row


def igv_session(tracks: list[Mapping[str, str]], genome: str) -> str:
    """A browser session that lists tracks (name, path, color)."""
    from xml.sax.saxutils import quoteattr

    resources = "".join(f"  <Resource path={quoteattr(t['path'])}/>\n" for t in tracks)
    shown = "".join(f"  <Track id={quoteattr(t['path'])} name={quoteattr(t['name'])} color={quoteattr(t.get('color', '0,0,178'))}/>\n" for t in tracks)
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<Session genome={quoteattr(genome)} version="8">\n <Resources>\n{resources} </Resources>\n <Panel name="DataPanel">\n{shown} </Panel>\n</Session>\n'


# Colours and names of the tracks of a context, in order.
MASTER_TRACK = ("Master DHS registry", "106,27,154")
CONTEXT_TRACKS = (
    ("atac", "mean ATAC 150-bp Tn5 pileup (background-TMM)", "31,120,180"),
    ("qpois", "pooled ATAC qpois signal", "117,112,179"),
    ("h3k27ac", "mean H3K27ac signal (background-TMM)", "221,126,32"),
    ("members", "context DHSs", "0,145,130"),
    ("elements", "candidate cCREs (posterior-scored)", "202,61,52"),
)


def atlas_session(master: str, contexts: Mapping[str, Mapping[str, str]], genome: str) -> str:
    """A session of the registry and, for each context in order, its five tracks; ``contexts``: context -> kind -> path.

    Fails if a context lacks a kind.
    """
    kinds = {kind for kind, _, _ in CONTEXT_TRACKS}
    for context, paths in contexts.items():
        if set(paths) != kinds:
            raise ValueError(f"{context}: tracks must be {sorted(kinds)}")
    name, color = MASTER_TRACK
    tracks = [{"name": name, "path": master, "color": color}]
    tracks += [{"name": f"{c.upper()} | {label}", "path": contexts[c][kind], "color": rgb} for c in sorted(contexts) for kind, label, rgb in CONTEXT_TRACKS]
    return igv_session(tracks, genome)


def write_matrix(pixels: DataFrame, weights: DataFrame, path: str) -> None:
    """A balanced matrix as two tables under one path: pixels (context, chrom, bin1, bin2, count) and bins (context, chrom, bin, weight)."""
    write_table(pixels.select("context", "chrom", "bin1", "bin2", "count"), f"{path}/pixels", ("context",))
    write_table(weights.select("context", "chrom", "bin", "weight"), f"{path}/bins", ("context",))


def stacked_svg(rows: list[tuple[str, Mapping[str, float]]], colors: Mapping[str, str], title: str, width: int = 640) -> str:
    """Bars of parts, for a small table of (name, part -> value); ``colors``: part -> r,g,b."""
    from xml.sax.saxutils import escape

    top = max([sum(parts.values()) for _, parts in rows], default=0) or 1
    out = []
    for i, (name, parts) in enumerate(rows):
        at = 160.0
        out.append(f'<text x="4" y="{40 + 22 * i}" font-size="12">{escape(name)}</text>')
        for part, rgb in colors.items():
            w = (width - 240) * parts.get(part, 0) / top
            out.append(f'<rect x="{at:.1f}" y="{28 + 22 * i}" width="{w:.1f}" height="16" fill="rgb({rgb})"><title>{escape(part)}: {parts.get(part, 0):g}</title></rect>')
            at += w
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{50 + 22 * len(rows)}"><text x="4" y="16" font-size="14">{escape(title)}</text>{"".join(out)}</svg>'


def mixture_svg(bins: list[tuple[float, float, int]], curves: list[tuple[float, float, float]], title: str, width: int = 640, height: int = 240) -> str:
    """A histogram (left, right, count) as densities, with the two component curves (x, low, high)."""
    from xml.sax.saxutils import escape

    n = sum(c for *_, c in bins) or 1
    bars = [(a, b, c / n / (b - a)) for a, b, c in bins if b > a]
    lo, hi = min([a for a, *_ in bars], default=0.0), max([b for _, b, _ in bars], default=1.0)
    top = max([h for *_, h in bars] + [v for _, *vs in curves for v in vs], default=0) or 1
    x = lambda v: 20 + (width - 40) * (v - lo) / ((hi - lo) or 1)
    y = lambda v: height - 20 - (height - 60) * v / top
    rects = "".join(f'<rect x="{x(a):.1f}" y="{y(h):.1f}" width="{x(b) - x(a):.1f}" height="{height - 20 - y(h):.1f}" fill="#cccccc"/>' for a, b, h in bars)
    lines = "".join(f'<polyline fill="none" stroke="{color}" points="{" ".join(f"{x(c[0]):.1f},{y(c[k]):.1f}" for c in curves)}"/>' for k, color in ((1, "#4575b4"), (2, "#d73027")) if curves)
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><text x="4" y="16" font-size="14">{escape(title)}</text>{rects}{lines}</svg>'


def bar_svg(rows: list[tuple[str, float]], title: str, width: int = 640) -> str:
    """Bars for a small table."""
    from xml.sax.saxutils import escape

    top = max([v for _, v in rows], default=0) or 1
    bars = "".join(f'<text x="4" y="{40 + 22 * i}" font-size="12">{escape(n)}</text><rect x="160" y="{28 + 22 * i}" width="{(width - 240) * v / top:.1f}" height="16" fill="#4575b4"/><text x="{166 + (width - 240) * v / top:.1f}" y="{40 + 22 * i}" font-size="12">{v:g}</text>' for i, (n, v) in enumerate(rows))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{50 + 22 * len(rows)}"><text x="4" y="16" font-size="14">{escape(title)}</text>{bars}</svg>'


def report_html(title: str, sections: Mapping[str, str | list[tuple]]) -> str:
    """A page of small tables (lists of rows, the first the header) and ready-made fragments."""
    from html import escape

    parts = []
    for name, body in sections.items():
        if not isinstance(body, str):
            head, *rest = body
            cells = lambda row, tag: "".join(f"<{tag}>{escape(str(c))}</{tag}>" for c in row)
            body = f"<table><tr>{cells(head, 'th')}</tr>" + "".join(f"<tr>{cells(r, 'td')}</tr>" for r in rest) + "</table>"
        parts.append(f"<h2>{escape(name)}</h2>{body}")
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>{''.join(parts)}</body></html>"
