"""Personal data against plain patterns, planted proposals, and the parts of the model."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from genoframe.llm import pii
from genoframe.llm.native import running

BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(d):
    return sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def strict(text):
    out = []
    for k, p in enumerate(BASE):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = (True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")), 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def card(rng, n=16):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(body + c for c in "0123456789" if luhn(body + c))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    bits = ["a", "Été", "x.y", "..", "@", "1", "22", "+", "-", " ", " ", "(", ")", "255", "256", ".", "\n", "é@b.c", "😀", "_", "0.0.0.0"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for i in range(200):
        c = card(rng)
        texts.append(
            f"ßé the mail{i}@host{i % 7}.example.com of {i % 250}.7.8.9 and {c} or {c[:4]} {c[4:8]} {c[8:12]} {c[12:]}, {c[:-1]}{(int(c[-1]) + 1) % 10} call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}, 999.1.1.1"
        )
    texts += [None, "", "a" * 50_000, "1" * 50_000, "a." * 20_000 + "@b.c", "a@b" + ".c" * 20_000, "+1" + " 2" * 20_000, "1.2.3.4 " * 700, "x@y.zz " * 700]
    return list(enumerate(texts))


def test_base_spans_equal_plain_patterns(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x")).withColumn("base", F.lit(1)).repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in pii.query(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = strict(text)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (i, text and text[:100])
        for name in pii.KINDS:
            assert got[i][f"n_{name}"] == want.count(f"{name}:")
        assert set(filter(None, want.split(","))) <= set(got[i].spans.split(","))


PLANTED = [
    ("write to jane.doe [at] example [dot] org today", "jane.doe [at] example [dot] org", "email"),
    ("or bob at mail dot com then", "bob at mail dot com", "email"),
    ("our host 10.20.30[.]40", None, None),
    ("the host 81[.]2[.]69[.]142 is up", "81[.]2[.]69[.]142", "ip"),
    ("call (415) 555-2671 now", "(415) 555-2671", "phone"),
    ("tel 415-555-2671.", "415-555-2671", "phone"),
    ("card 4539.5787.6362.1486 was used", "4539.5787.6362.1486", "card"),
    ("paid 12 4539578763621486 then", "4539578763621486", "card"),
]
CLEAN = ["order no. 415 555 2671", "version 1.2.3 of the book", "he was at home and she sat at work", "it cost 1234 and then 5678", "build 4539.5787.6362.1487", "see you at ten", "the 12 of 34 in 56", 'token = "9f86d081884c7d659a2f"']


def test_proposals_are_added_and_clean_texts_left(spark, rows):
    texts = [t for _, t in rows[400:600]] + [p for p, *_ in PLANTED] + CLEAN
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(df).collect()}
    for i, (text, span, kind) in enumerate(PLANTED, 200):
        found = [(text[s.start : s.end], pii.KINDS[s.kind]) for s in got[i]]
        assert found == ([(span, kind)] if span else []), text
    for i, text in enumerate(CLEAN, 200 + len(PLANTED)):
        assert got[i] == [], text


def test_proposals_keep_apart_from_base(spark):
    text = "call (415) 555-2671@mail.com and 4539.5787.6362.1486@x.org or (415) 555-2671"
    got = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    spans = sorted((s.start, s.end) for s in got.spans)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and len(got.base) == 2


def test_labelers_are_weighed(spark):
    """A labeler that votes at random is believed less than those that agree."""
    rng = random.Random(2)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.5
        votes = [(1 if truth else -1) if rng.random() < 0.9 else (-1 if truth else 1) for _ in range(5)] + [rng.choice([-1, 1])]
        code = pii.PHONE * 4 * 9
        for v in votes:
            code = code * 3 + v + 1
        counts[code] = counts.get(code, 0) + 1
    model = pii.fit(counts)
    sure = [model.reliability[pii.PHONE, j, 1] - model.reliability[pii.PHONE, j, 0] for j in range(6)]
    assert min(sure[:5]) > 0.6 and abs(sure[5]) < 0.2
    best, worst = (max(counts, key=lambda c, s=s: s * sum(pii._decode(c)[4][:5])) for s in (1, -1))
    assert model.logit(best) > 1 and model.logit(worst) < -1
    df = spark.createDataFrame([(c,) for c in counts], "code int").select("code", pii._score(model, F.col("code")).alias("z"))
    assert all(abs(r.z - model.logit(r.code)) < 1e-9 for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
def test_running(spark, n):
    values = [(7 * i) % 11 - 3 for i in range(n)]
    df = spark.createDataFrame([(values,)], "x array<long>")
    got = df.select(running(F.col("x"), F.lit(0).cast("long"), lambda a, b: a + b).alias("s"), running(F.col("x"), F.lit(-9).cast("long"), lambda a, b: F.greatest(a, b)).alias("m")).first()
    assert got.s == [sum(values[: i + 1]) for i in range(n)] and got.m == [max(values[: i + 1]) for i in range(n)]


def test_odd_tables(spark, odd, empty):
    assert pii.find_personal_data(empty).count() == 0
    got = pii.find_personal_data(odd).collect()
    assert len(got) == odd.count() and all(r.spans == [] for r in got)
