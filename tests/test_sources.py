"""Readers of alignment, unit and matrix text, log parsers, report files, sessions and figures."""

import hashlib
import xml.etree.ElementTree as ET

import pytest
from genoframe.operators import catalog as ct, links as lk
from genoframe.sources import logs, readers, sinks


def test_alignments(spark, tmp_path):
    lines = ["@HD\tVN:1.6", "r1\t99\tchr1\t101\t30\t10M2I5M3D5S\t=\t200\t140\tACGT\tIIII", "r1\t147\tchr1\t200\t0\t5S20M100N20M\t=\t101\t-140\tACGT\tIIII", "r2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI"]
    (tmp_path / "lib1.sam").write_text("\n".join(lines) + "\n")
    got = {(r.read, r.flag): r for r in readers.alignments(spark, str(tmp_path / "lib1.sam")).collect()}
    one, two = got["r1", 99], got["r1", 147]
    assert (one.library, one.pos, one.bases, one.end, one.strand, one.tlen) == ("lib1", 101, 18, 118, "+", 140) and (two.bases, two.strand) == (140, "-") and got["r2", 4].bases == 0


def test_units_are_checked(spark, tmp_path):
    sizes = spark.createDataFrame([("chr2", 100, 1), ("chr1", 200, 2)], "chrom string, size long, rank int")

    def read(rows, total):
        (tmp_path / "u.bed").write_text("#c\n" + "".join(f"{c}\t{s}\t{e}\n" for c, s, e in rows))
        return readers.assay_units(spark, str(tmp_path / "u.bed"), sizes, total).count()

    good = [("chr2", 5, 10), ("chr2", 5, 11), ("chr1", 0, 3)]
    assert read(good, 3) == 3
    for rows, total, said in ((good[::-1], 3, "not sorted"), (good, 4, "another number"), ([("chr3", 1, 2)], 1, "invalid"), ([("chr1", 2, 2)], 1, "invalid"), ([("chr1", 2, 201)], 1, "invalid")):
        with pytest.raises(Exception, match=said):
            read(rows, total)


def test_matrix_text(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("1\t1000\t2000\t1\t0\t1000\t5\n1\t0\t1000\t2\t0\t1000\t9\nchr2\t3000\t4000\tchr2\t7000\t8000\t2.5\n")
    got = sorted(tuple(r) for r in readers.pixels(spark, str(tmp_path / "m.tsv"), 1000).collect())
    assert got == [("chr1", 0, 1, 5.0), ("chr2", 3, 7, 2.5)]


def test_published_tables(spark, tmp_path):
    for name, fields in (("edges", lk.EDGE_FIELDS), ("genes", lk.GENE_FIELDS), ("nodes", lk.NODE_FIELDS), ("catalog", ct.CATALOG_FIELDS)):
        path = tmp_path / f"{name}.tsv"
        path.write_text("\t".join(fields) + "\n" + "\t".join("1" for _ in fields) + "\n")
        assert readers.published(spark, str(path), name).collect()[0][0] in ("1", 1)
    bad = tmp_path / "bad.tsv"
    bad.write_text("\t".join(["wrong", *lk.EDGE_FIELDS[1:]]) + "\n" + "\t".join("1" for _ in lk.EDGE_FIELDS) + "\n")
    with pytest.raises(Exception):
        readers.published(spark, str(bad), "edges").collect()
    kinds = dict(readers.published(spark, str(tmp_path / "edges.tsv"), "edges").dtypes)
    assert (kinds["distance_bp"], kinds["contact_weight"], kinds["promoter_active"], kinds["contact_status"]) == ("bigint", "double", "int", "string")


def test_logs(spark):
    flag = "120 + 0 in total (QC-passed reads + QC-failed reads)\n0 + 0 secondary\n110 + 0 mapped (91.67% : N/A)\n"
    row = logs.flagstat_log(spark.createDataFrame([("a", flag)], "sample string, text string")).first()
    assert tuple(row) == ("a", 120, 110, None)
    said = "10 reads; of these:\n  10 (100.00%) were unpaired; of these:\n    2 (20.00%) aligned 0 times\n    5 (50.00%) aligned exactly 1 time\n    {n} (30.00%) aligned >1 times\n80.00% overall alignment rate\n"
    chunks = spark.createDataFrame([("a", said.format(n=3)), ("a", said.format(n=3))], "sample string, text string")
    out = logs.aligner_log(chunks, paired=False)
    assert tuple(out.first()) == ("a", 10, 2, 5, 3, 80.0) and tuple(logs.chunk_totals(out, ("sample",)).first()) == ("a", 20, 4, 10, 6, 2, 80.0)
    with pytest.raises(Exception, match="add up"):
        logs.aligner_log(spark.createDataFrame([("a", said.format(n=4))], "sample string, text string"), paired=False).collect()
    line = "f.bam\t1000\t185,200\t0.2\t50\t0.1\t1500\t0.05\t1.25\t0.9\t1\n"
    assert tuple(logs.cross_correlation(spark.createDataFrame([("a", line)], "sample string, text string")).first()) == ("a", 1000, "185,200", 1.25, 0.9, 1, 185)
    with pytest.raises(Exception, match="not a cross"):
        logs.cross_correlation(spark.createDataFrame([("a", "x\ty\n")], "sample string, text string")).collect()
    values = [1.0] * 400
    values[200] = 7.0
    text = "bin labels\t\t-2.0Kb\nname\tset\t" + "\t".join(map(str, values)) + "\n"
    assert logs.profile_enrichment(spark.createDataFrame([("a", text), ("b", "no numbers here\n")], "sample string, text string").orderBy("sample")).collect()[0].tss_enrichment == 7.0


def test_report_sources(spark, tmp_path):
    for name in ("qc/metrics.json", "qc/tss/a.profile.png", "qc/tss/deep/b.profile.png", "qc/other.txt", "qc/reads.bam", "provenance/manifests/x.tsv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    got = {r.kind: r.sha256 for r in logs.report_sources(spark, [str(tmp_path), str(tmp_path) + "/"]).collect()}
    assert got == {k: hashlib.sha256(n.encode()).hexdigest() for k, n in (("qc_metrics", "qc/metrics.json"), ("tss_profile", "qc/tss/a.profile.png"), ("manifest", "provenance/manifests/x.tsv"))}
    opened = {f.rsplit("/", 1)[-1] for f in logs.report_sources(spark, [str(tmp_path)]).inputFiles()}
    assert "metrics.json" in opened and not opened & {"reads.bam", "other.txt"}


def test_session_and_figures(spark, tmp_path):
    contexts = {c: {k: f"{c}/{k}" for k, *_ in sinks.CONTEXT_TRACKS} for c in ("b", "a")}
    tracks = ET.fromstring(sinks.atlas_session("master.bed", contexts, "dm6")).findall(".//Track")
    assert len(tracks) == 1 + 5 * 2 and tracks[1].get("name").startswith("A | mean ATAC") and tracks[0].get("color") == "106,27,154"
    with pytest.raises(ValueError, match="tracks must be"):
        sinks.atlas_session("m", {"a": {"atac": "x"}}, "dm6")
    assert len(ET.fromstring(sinks.stacked_svg([("x", {"p": 1, "q": 3}), ("y", {})], {"p": "1,2,3", "q": "4,5,6"}, "t")).findall("{*}rect")) == 4
    svg = ET.fromstring(sinks.mixture_svg([(0.0, 1.0, 3), (1.0, 2.0, 1)], [(0.0, 0.1, 0.2), (2.0, 0.2, 0.1)], "a < b"))
    assert len(svg.findall("{*}rect")) == 2 and len(svg.findall("{*}polyline")) == 2
    px = spark.createDataFrame([("a", "chr1", 0, 2, 5)], "context string, chrom string, bin1 long, bin2 long, count long")
    sinks.write_matrix(px, spark.createDataFrame([("a", "chr1", 0, 0.5), ("a", "chr1", 2, None)], "context string, chrom string, bin long, weight double"), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m/pixels")).count() == 1 and spark.read.parquet(str(tmp_path / "m/bins")).count() == 2
