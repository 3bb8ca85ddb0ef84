import gzip
import hashlib
import json

import pytest
from genoframe.operators import intervals as iv, reads as rd, tables as tb
from genoframe.plans import stages as st
from genoframe.sources import readers, sinks
from genoframe.streaming import counts
from pyspark.sql import functions as F

IV = "chrom string, start long, end long"


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_units(spark):
    x = spark.createDataFrame([("c", 10, 60, "+"), ("c", 200, 250, "-"), ("c", 950, 990, "+"), ("c", 0, 50, "-")], f"{IV}, strand string")
    size = spark.createDataFrame([("c", 1000)], "chrom string, size long")
    assert rows(rd.extend_reads(x, 150, size), "start", "end") == [(0, 50), (10, 160), (100, 250), (950, 1000)]
    with pytest.raises(Exception, match="longer"):
        rd.extend_reads(x, 20, size).collect()
    assert rows(rd.insertions(x), "start", "end") == [(10, 11), (49, 50), (249, 250), (950, 951)]
    f = spark.createDataFrame([(1, 101, 80), (2, 300, -80), (3, 5, 0)], "k int, pos long, tlen int")
    assert rows(rd.fragments(f), "k", "start", "end") == [(1, 100, 180)] and rows(rd.short_fragments(f), "k") == [(1,), (2,)]


def test_alignment_filters(spark):
    x = spark.createDataFrame([(1, "c", 3, 30), (2, "c", 3 + 1024, 30), (3, "chrM", 3, 30), (4, "c", 1, 30), (5, "c", 3, 5), (6, "c", 3 + 256, 30), (7, "c", 3 + 8, 30)], "k int, chrom string, flag int, mapq int")
    assert rows(rd.filter_alignments(x, 20), "k") == [(1,)] and rows(rd.filter_alignments(x, 20, drop_duplicates=False), "k") == [(1,), (2,)]
    s = rd.flagstat(x).first()
    assert (s.total, s.mapped, s.duplicates, s.secondary, s.properly_paired) == (7, 7, 1, 1, 6)


def test_summaries(spark):
    h = spark.createDataFrame([(100, 3), (200, 1)], "length int, n long")
    assert tuple(rd.fragment_summary(h).first()) == (4, 100, 0.75, 0.25)
    p = spark.createDataFrame([(i * 10 - 2000, 4.0 if i == 199 else 1.0) for i in range(400)], "offset int, value double")
    assert rd.tss_enrichment(p).first().tss_enrichment == 4.0
    assert rd.tss_enrichment(p.withColumn("value", F.lit(0.0))).first().tss_enrichment is None
    u = spark.createDataFrame([("l", "c", 0, 100), ("l", "c", 0, 100), ("l", "c", 500, 510), ("m", "d", 0, 5)], f"library string, {IV}")
    peaks = spark.createDataFrame([("c", 0, 10), ("c", 5, 20), ("c", 50, 60)], IV)
    assert {r.library: (r.frip_numerator, r.frip_denominator) for r in rd.frip(u, peaks).collect()} == {"l": (2, 3), "m": (0, 1)}


def test_fastq(spark, tmp_path):
    good, bad = "@a\nACGT\n+\nIIII\n", "a\nACXT\n-\nIII\n@c\nAC\n"
    (tmp_path / "x.fastq").write_text(good + bad)
    lines = readers.fastq_lines(spark, str(tmp_path / "x.fastq"))
    assert [r.line for r in lines.orderBy("line").collect()] == list(range(10))
    assert rows(rd.validate_fastq(lines)) == [(1, "bad_header"), (1, "bad_separator"), (1, "bad_sequence"), (1, "length_mismatch"), (2, "incomplete_record")]


def test_readers(spark, tmp_path):
    w = lambda n, t: (tmp_path / n).write_text(t) and str(tmp_path / n)
    t = readers.delimited(spark, w("s.tsv", "﻿id\tcontext \n a \t b\n\t\nc\td\n"))
    assert t.columns == ["id", "context"] and rows(t)[-2:] == [("a", "b"), ("c", "d")]
    with pytest.raises(ValueError, match="repeated"):
        readers.delimited(spark, w("d.csv", "a,a\n1,2\n"))
    assert rows(readers.chrom_sizes(spark, w("z", "chr2\t10\nchr1\t5\n"))) == [("chr1", 5, 2), ("chr2", 10, 1)]
    b = readers.bed(spark, w("b.bed", "track x\n#c\nchr1\t1\t5\nchr1\t2\t9\tn\t2000\t-\n"))
    assert rows(b, "chrom", "start", "end", "name", "score", "strand") == [("chr1", 1, 5, "chr1_1_5", 0, "."), ("chr1", 2, 9, "n", 1000, "-")]
    assert rows(readers.bedgraph(spark, w("g.bg", "chr1\t0\t5\t1.5\n"))) == [("chr1", 0, 5, 1.5)]
    g = readers.gtf_transcripts(spark, w("a.gtf", '1\ts\ttranscript\t1001\t1300\t.\t+\t.\tgene_id "g"; transcript_id "t";\n1\ts\texon\t1\t2\t.\t+\t.\tgene_id "g";\n'))
    assert rows(g, "chrom", "start", "end", "gene_name", "transcript_id") == [("chr1", 1000, 1300, "g", "t")]
    with gzip.open(tmp_path / "e.tsv.gz", "wt") as f:
        f.write("id\tvalue\nx\t2\n")
    assert rows(readers.exact_table(spark, str(tmp_path / "e.tsv.gz"), "id string, value long")) == [("x", 2)]


def test_table_rules(spark):
    x = spark.createDataFrame([("a", " 5 ", "atac"), ("b", "", "atac"), ("c", None, "h3"), ("d", "x", "other")], "id string, n string, assay string")
    assert rows(tb.typed_defaults(x, {"n": "int"}, {"n": 1}, "assay", {"atac": {"n": 7}}), "id", "n") == [("a", 5), ("b", 7), ("c", 1), ("d", 1)]
    assert rows(tb.type_violations(x, {"n": "int"}, "id")) == [("d", "n", "x")]
    old = spark.createDataFrame([("k1", "complete"), ("k2", "pending")], "k string, s string")
    new = spark.createDataFrame([("k1", "pending"), ("k2", "complete"), ("k3", "pending")], "k string, s string")
    rank = F.when(F.col("s") == "complete", 2).otherwise(1)
    assert rows(tb.upsert(old, new, ["k"], "s", rank), "k", "s") == [("k1", "complete"), ("k2", "complete"), ("k3", "pending")]
    m = spark.createDataFrame([("a",), ("b",), ("c",), ("e",)], "k string")
    v = spark.createDataFrame([("a", "approve"), ("b", "approve"), ("b", "reject"), ("d", "approve"), ("e", "maybe")], "k string, decision string")
    assert {r.k: r.problem for r in tb.decisions(m, v, "k", ("approve", "reject")).collect()} == {"a": None, "b": "repeated_decision", "c": "missing_decision", "d": "unknown_key", "e": "unknown_decision"}
    with pytest.raises(Exception, match="both tables"):
        tb.union_disjoint(old, new, "k").collect()
    z = spark.createDataFrame([("r", "u1;u2", "m1;m2")], "k string, u string, m string")
    assert rows(tb.zip_explode(z, ("u", "m"))) == [("r", 0, "u1", "m1"), ("r", 1, "u2", "m2")]
    log = spark.createDataFrame([("l1", "x\n12.5% overall\nreads; of these: it's 7"), ("l2", "none")], "k string, text string")
    assert rows(tb.parse_log(log, {"rate": r"([0-9.]+)% overall", "n": r"it's (\d+)"})) == [("l1", 12.5, 7.0), ("l2", None, None)]


def test_digests_do_not_depend_on_order(spark):
    x = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.col("id") * 2).alias("v"))
    one = sinks.content_digest(x, ["id", "v"])
    assert one == sinks.content_digest(x.repartition(7).orderBy(F.col("id").desc()), ["id", "v"])
    assert one != sinks.content_digest(x.where("id <> 5"), ["id", "v"]) and one != sinks.content_digest(x.union(x.where("id = 5")), ["id", "v"])


def test_sinks(spark, tmp_path):
    p = tmp_path / "a" / "m.json"
    assert sinks.write_text_if_changed(p, "x") and not sinks.write_text_if_changed(p, "x") and sinks.write_text_if_changed(p, "y")
    sinks.write_gzip(tmp_path / "z.gz", ["a\n"])
    first = (tmp_path / "z.gz").read_bytes()
    sinks.write_gzip(tmp_path / "y.gz", ["a\n"])
    assert first == (tmp_path / "y.gz").read_bytes() and gzip.decompress(first) == b"a\n"
    c = spark.createDataFrame([("DHS0000001", "chr1", 5, 9, "distal_enhancer_like", 1250, 0.25, "low", False, 1)], "id string, chrom string, start long, end long, regulatory_class string, distance long, posterior double, component string, supported boolean, blacklist_overlap int")
    assert sinks.bed9(c).first()[0] == "chr1\t5\t9\tDHS0000001|distal_enhancer_like|tss_distance=1250|posterior_high=0.25|low_mixture|warning|blacklist_overlap\t250\t.\t5\t9\t69,117,180"
    assert "NA" in sinks.bed9(c.withColumn("posterior", F.lit(None).cast("double"))).first()[0]
    assert sinks.bed6(c.withColumnRenamed("id", "name")).first()[0] == "chr1\t5\t9\tDHS0000001\t0\t."
    sinks.export_tsv(spark.range(50), str(tmp_path / "t"), ["id"])
    assert spark.read.csv(str(tmp_path / "t"), sep="\t", header=True).count() == 50
    got = sinks.write_metrics(tmp_path / "m.json", spark.range(5), {"n": F.count("*")}, {"tool": "x"})
    assert got == {"n": 5} and json.loads((tmp_path / "m.json").read_text())["provenance"] == {"tool": "x"}
    assert "<Resource path=\"a&amp;b\"/>" in sinks.igv_session([{"name": "n", "path": "a&b"}], "dm6")
    assert "<td>&lt;</td>" in sinks.report_html("t", {"s": [("h",), ("<",)]}) and sinks.bar_svg([("a", 2.0)], "t").startswith("<svg")


def test_stages(spark, tmp_path):
    made = []

    def stage(name):
        def run(spark, inputs, config):
            made.append(name)
            base = inputs["master"] if name != "master" else spark.range(10)
            return {name: base.withColumn(name, F.lit(config["k"]))}

        return run

    functions = {n: stage(n) for n in ("master", "catalog", "links")}
    runner = st.StageRunner(spark, str(tmp_path), {"k": 1}, functions)
    runner.run("master", "catalog")
    assert made == ["master", "catalog"]
    out = st.StageRunner(spark, str(tmp_path), {"k": 1, "generated_at_utc": "now"}, functions).run("links", "report")
    assert made[-1] == "links" and out["links"].count() == 10
    with pytest.raises(st.CheckpointError, match="another configuration"):
        st.StageRunner(spark, str(tmp_path), {"k": 2}, functions).run("links", "links")
    spark.range(11).withColumn("master", F.lit(1)).write.mode("overwrite").parquet(f"{tmp_path}/master/master")
    with pytest.raises(st.CheckpointError, match="has changed"):
        st.StageRunner(spark, str(tmp_path), {"k": 1}, functions).run("links", "links")
    with pytest.raises(ValueError):
        st.select_stages("links", "master")
    with pytest.raises(ValueError):
        st.select_stages("nope", "master")
    f = tmp_path / "f"
    f.write_text("x")
    m = st.manifest({"f": f})
    assert m[0][2] == hashlib.sha256(b"x").hexdigest()
    st.verify_manifest(m)
    f.write_text("y")
    with pytest.raises(st.CheckpointError):
        st.verify_manifest(m)


def test_stream(spark, tmp_path):
    shape = "unit_id long, chrom string, start long, end long, library string, assay string, context string, strand string"
    unit = lambda i, s: (i, "c", s, s + 10, "l", "atac", "x", "+")
    e = spark.createDataFrame([(1, "c", 0, 50), (2, "c", 60, 90)], f"id long, {IV}")
    inbox = str(tmp_path / "in")
    for part in ([unit(1, 5), unit(2, 45)], [unit(3, 61)], [unit(4, 200)]):
        spark.createDataFrame(part, shape).write.mode("append").parquet(inbox)
        counts.maintain_counts(counts.unit_stream(spark, inbox), e, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r.id: r.raw_count for r in counts.read_counts(spark, str(tmp_path / "out")).collect()}
    assert got == {1: 2, 2: 1} == {r.id: r.raw_count for r in iv.count_overlaps(e, spark.read.parquet(inbox)).collect()}


def test_template_duplicates(spark):
    from genoframe.operators.reads import mark_template_duplicates, unclipped_five_prime

    rows = [
        # Two pairs with the same unclipped ends; the first has the better quality.
        ("a", 0x41, 100, "50M", 30), ("a", 0x91, 300, "50M", 30), ("b", 0x41, 105, "5S45M", 20), ("b", 0x91, 300, "45M5S", 30),
        ("b", 0x141, 900, "50M", 30),  # a secondary record has its template's mark
        ("c", 0x41, 100, "50M", 99), ("c", 0x91, 301, "50M", 99),  # another end
        ("d", 0x51, 100, "50M", 99), ("d", 0x91, 300, "50M", 99),  # another strand
        ("e", 0x49, 101, "1S50M", 99), ("e", 0x85, 101, "*", 0),  # a single read in the place of a pair's end; its mate is not mapped
        ("f", 0x0, 500, "50M", 10), ("g", 0x0, 503, "3H47M", 10), ("h", 0x0, 500, "50M", 40), ("i", 0x10, 451, "50M", 40), ("j", 0x10, 461, "30M2D8M", 1),
        ("k", 0x200, 500, "50M", 99),  # of bad quality: not compared
    ]
    df = spark.createDataFrame([("l", "chr1", *r) for r in rows], "library string, chrom string, read string, flag int, pos long, cigar string, quality long")
    got = {(r.read, r.flag): r.duplicate for r in mark_template_duplicates(df).collect()}
    assert {k for k, v in got.items() if v} == {("b", 0x41), ("b", 0x91), ("b", 0x141), ("e", 0x49), ("f", 0x0), ("g", 0x0), ("j", 0x10)} and len(got) == len(rows)
    other = df.union(df.withColumn("library", F.lit("m")))
    assert mark_template_duplicates(other).where("duplicate").count() == 14
    at = df.select(unclipped_five_prime(F.col("pos"), F.col("cigar"), F.col("flag").bitwiseAND(16) != 0).alias("x")).collect()
    assert [r.x for r in at][-4:-1] == [500, 500, 500]


def test_templates_are_made_once(spark):
    """Templates are made once: the plan of the marks reads records once, however many steps read the templates."""
    from genoframe.operators.reads import mark_template_duplicates

    shape = "library string, chrom string, read string, flag int, pos long, cigar string, quality long"
    # Of pairs of the same ends the best quality stays, a null one comes last, and of equal ones the first name.
    rows = [("l", "c", r, f, p, "9M", q) for r, q in (("b", 7), ("a", 7), ("d", 8), ("c", 8), ("e", None)) for f, p in ((0x41, 100), (0x91, 300))]
    df = spark.createDataFrame(rows, shape)
    marked = mark_template_duplicates(df)
    assert {r.read for r in marked.where("not duplicate").collect()} == {"c"}
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [library") == 1 + 5
    assert "regexp" not in marked._jdf.queryExecution().optimizedPlan().toString()
