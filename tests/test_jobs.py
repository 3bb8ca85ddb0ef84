"""The jobs over growing input, run again, stopped half-way, and from the command line."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from genoframe.operators.quantify import library_signal as whole_signal
from jobs import document_review, library_signal
from jobs.common import config, mapped

REPO = Path(__file__).resolve().parent.parent
UNITS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_linestatus string"


@pytest.fixture
def units(spark):
    """Line items over 30 elements; those of each call come in a file of their own."""

    def add(folder, start, n, status="F", supplier=None):
        rows = [(i, i * 7 % 90, supplier if supplier is not None else i % 8, i % 3, float(i % 50), status) for i in range(start, start + n)]
        spark.createDataFrame(rows, UNITS).coalesce(1).write.mode("append").parquet(folder)

    return add


@pytest.fixture
def elements(spark, tmp_path):
    path = str(tmp_path / "elements")
    spark.createDataFrame([(i, i % 40) for i in range(90)], "p_partkey long, p_size int").write.parquet(path)
    return path


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or sorted(df.columns)).collect()), key=str)


def wanted(spark, folder, elements):
    """The signal of all units at once."""
    s = config("library_signal")
    u = mapped(spark.read.parquet(folder), s["units"]).dropna()
    return rows(whole_signal(mapped(spark.read.parquet(elements), s["elements"]), u, 256).select("id", "library", "raw_count", "total_units", "cpm_per_kb", "assay", "context"))


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_signal_follows_growing_units(spark, units, elements, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("units", "out", "checkpoint"))
    settings = config("library_signal") | {"files_per_batch": 1}
    run = lambda: rows(library_signal.run(spark, folder, elements, out, checkpoint, settings))
    units(folder, 0, 400)
    units(folder, 400, 300, status="O")
    assert run() == wanted(spark, folder, elements)
    before = files(f"{out}/signal")
    assert run() == wanted(spark, folder, elements) and files(f"{out}/signal") == before  # nothing new, nothing written
    units(folder, 1000, 200, supplier=3)  # one assay and context gain units
    assert run() == wanted(spark, folder, elements)
    after = files(f"{out}/signal")
    kept = {p for p in before if "assay=h3k27ac/context=F" not in str(p)}
    assert kept and all(after.get(p) == before[p] for p in kept)
    assert not any(p in after for p in before if p not in kept)
    assert len(list(Path(f"{out}/counts").glob("batch=*"))) == 3


def test_signal_is_made_good_after_a_stop(spark, units, elements, tmp_path, monkeypatch):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("units", "out", "checkpoint"))
    settings = config("library_signal")
    units(folder, 0, 300)
    library_signal.run(spark, folder, elements, out, checkpoint, settings)
    units(folder, 300, 300)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:  # after the counts, before the signal
        m.setattr(library_signal, "signal_of_counts", stop)
        with pytest.raises(RuntimeError):
            library_signal.run(spark, folder, elements, out, checkpoint, settings)
    assert rows(library_signal.run(spark, folder, elements, out, checkpoint, settings)) == wanted(spark, folder, elements)
    with monkeypatch.context() as m:  # inside a batch: the stream takes its files again
        units(folder, 900, 100, status="O")
        m.setattr(library_signal, "count_overlaps", stop)
        with pytest.raises(Exception, match="stopped"):
            library_signal.run(spark, folder, elements, out, checkpoint, settings)
    assert rows(library_signal.run(spark, folder, elements, out, checkpoint, settings)) == wanted(spark, folder, elements)


def test_signal_refuses_other_elements_and_skips_nulls(spark, units, elements, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("units", "out", "checkpoint"))
    settings = config("library_signal")
    spark.createDataFrame([], UNITS).write.parquet(folder)
    assert library_signal.run(spark, folder, elements, out, checkpoint, settings).count() == 0
    units(folder, 0, 50)
    spark.createDataFrame([(1, 2, 3, 1, None, "F"), (1, None, 3, 1, 5.0, "F"), (1, 2, 3, 1, 5.0, None)], UNITS).write.mode("append").parquet(folder)
    assert rows(library_signal.run(spark, folder, elements, out, checkpoint, settings)) == wanted(spark, folder, elements)
    other = str(tmp_path / "other")
    spark.createDataFrame([(1, 1)], "p_partkey long, p_size int").write.parquet(other)
    with pytest.raises(ValueError, match="elements"):
        library_signal.run(spark, folder, other, out, checkpoint, settings)


TEXTS = "doc_id long, text string, lang string, source string, n_chars long"
VOTES = "doc_id long, quality long, toxic long"


def text(i, words=30):
    return " ".join(f"w{i % 17}_{k}" for k in range(words))


@pytest.fixture
def delivery(spark, tmp_path):
    folder, votes, out = (str(tmp_path / n) for n in ("documents", "labels", "out"))

    def add(new, decisions=()):
        spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in new], TEXTS).write.mode("append").parquet(folder)
        spark.createDataFrame(list(decisions), VOTES).write.mode("append").parquet(votes)

    def run():
        return {r.id: r for r in document_review.run(spark, folder, votes, out, config("document_review")).collect()}

    return add, run, out


def test_review_takes_only_what_is_new(spark, delivery):
    add, run, out = delivery
    add([(i, text(i), f"src{i % 3}") for i in range(40)], [(0, 1, 0), (1, 1, 1), (2, 1, 0), (2, 0, 0), (99, 1, 0)])
    first = run()
    assert len(first) == 40 and first[20].duplicate_of == 3 and first[0].duplicate_of is None
    assert [(first[i].decision, first[i].problem) for i in (0, 1, 3)] == [("accept", None), ("reject", None), (None, "missing_decision")] and first[2].problem == "repeated_decision"
    before = files(f"{out}/manifest")
    assert run() == first and files(f"{out}/manifest") == before
    add([(40, text(0), "src9"), (41, None, "src0"), (42, "", "src0"), (43, "two words", "src1"), (5, "late", "src1"), (None, "nameless", "src1")], [(3, 0, 0)])
    second = run()
    assert set(second) == set(range(44)) and files(f"{out}/manifest").items() >= before.items()
    assert second[40].duplicate_of == 0 and second[3].decision == "reject"
    assert [second[i].warnings for i in (40, 41, 42, 43)] == ["", "no text", "empty", "short"]
    marks = spark.read.parquet(f"{out}/marks").orderBy("intake").collect()
    assert [(m.intake, m.mark, m.rows) for m in marks] == [(0, 39, 40), (1, 43, 4)]
    summary = spark.read.parquet(f"{out}/summary")
    assert summary.agg(F.sum("n"), F.sum("duplicates")).first() == (44, sum(r.duplicate_of is not None for r in second.values()))


def test_review_after_a_stop_before_the_mark(spark, delivery, monkeypatch):
    add, run, out = delivery
    add([(i, text(i), "src") for i in range(10)])
    run()
    add([(i, text(i), "src") for i in range(10, 20)])
    real = document_review._registered

    def half(texts, settings):
        return real(texts.where("id < 15"), settings)

    with monkeypatch.context() as m:  # part of the intake is there, and no mark for it
        m.setattr(document_review, "_registered", half)
        m.setattr(type(spark), "createDataFrame", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            run()
    assert set(run()) == set(range(20))
    assert spark.read.parquet(f"{out}/marks").count() == 2


def test_review_of_odd_texts(spark, delivery):
    add, run, _ = delivery
    add([])
    assert run() == {}
    add([(1, "a b", "s"), (1, "a b", "s"), (1, "c d", "s"), (2, "x" * 100_000, None)])
    got = run()
    assert set(got) == {1, 2} and got[1].warnings == "short;repeated id" and got[2].source is None


def test_command_line(spark, units, elements, tmp_path):
    units(str(tmp_path / "units"), 0, 100)
    own = tmp_path / "own.json"
    own.write_text('{"bin_width": 512}')
    paths = {"units": tmp_path / "units", "elements": elements, "out": tmp_path / "out", "checkpoint": tmp_path / "checkpoint", "config": own}
    command = [sys.executable, "-m", "jobs.library_signal", *[x for k, v in paths.items() for x in (f"--{k}", str(v))]]
    done = subprocess.run(command, cwd=REPO, capture_output=True, text=True, timeout=300, env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert "100 units read" in done.stderr and "wrote assay=" in done.stderr
    assert rows(spark.read.parquet(str(tmp_path / "out/signal")).select("id", "library", "raw_count", "total_units", "cpm_per_kb", "assay", "context")) == wanted(spark, str(tmp_path / "units"), elements)
