r"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides; Spark functions only.

Strict patterns (email, ip, card, phone) find the base spans, which always
stay.  Wider patterns propose what the strict ones miss: addresses spelled
with "at" and "dot", defanged or long IPs, card numbers inside runs of digits
that fail as a whole or with other separators, national phone numbers.  All
of them, strict matches that fail their check included, are candidates.  Six
labelers vote on each (for, against or no vote): the strict pattern, the
checksum or structure, gazetteers (top domains, card issuers, country codes,
reserved addresses), cue words before it, its edges, and the variety of its
digits.  Expectation-maximisation over the counts of vote patterns of the
whole corpus estimates how reliable each labeler is for each kind, without any
labels.  The posteriors train a logistic classifier of the candidate's form,
edges and votes, which accepts or refuses the wider proposals.

Vote patterns and features make a code of bounded range (``CODES``), so what
the driver fits on are counts by code, however large the corpus.  A text is
read once: its candidates, without the text, are written to the working
folder, and all later steps read those.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .native import let, running
from .work import Work

# The kinds, in the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The strict patterns.  Lookbehinds and possessive quantifiers only keep them from being tried twice on one run.
STRICT = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: Texts without these have no strict match of the kind.
CLUES = ("@", "[0-9][.][0-9]", "[0-9]", "[+][0-9]")

_DOT = r"(?: ?[\[({]dot[\])}] ?| dot |\[\.\])"
#: What the strict patterns miss, tried from left to right.
WIDE = "|".join(
    (
        rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[({{](?i:at)[\])}}] ?[A-Za-z0-9-]++(?:(?:{_DOT}|\.)[A-Za-z0-9-]++)++| at [A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++|@[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++)",
        r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])",
        r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9A-Za-z])",
        r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:([ ./_-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}|[ ./_-][0-9]{6}[ ./_-][0-9]{5}))(?![0-9])",
        r"(?<![0-9A-Za-z+().-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])",
    )
)
WIDE_CLUE = r"[0-9]{2}[\])}]?[ ./_-]{1,2}[0-9]{3}|[0-9]{14}|[\[({](?i:at)[\])}]|(?i:dot)|\[\.\]|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"

# Gazetteers and cue words.
TOP_DOMAINS = "com org net edu gov mil int info biz io dev app ai co uk us ca au de fr es it nl be ch at pl pt se no dk fi ie cz ru ua jp cn kr in br mx ar za eu".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6(?:011|4|5|2|0|[37]))"
COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[23589][0-9]{2})"
RESERVED = r"^(?:0+|127|22[4-9]|2[3-5][0-9])(?:[.]|\[\.\])"
CUES = (
    r"(?i)\b(?:e-?mail|mail|mailto|contact|contacto|kontakt|courriel|correo|write to|reach)\b",
    r"(?i)\b(?:ip|ipv4|ipv6|host|server|address|adresse|dirección|client|from|login)\b",
    r"(?i)\b(?:card|credit|debit|visa|mastercard|amex|karte|carte|tarjeta|cc|pan)\b",
    r"(?i)\b(?:phone|tel|telefon|téléphone|teléfono|call|mobile|cell|fax|ring|whatsapp|sms)\b",
)
AGAINST = r"(?i)\b(?:version|ver|v|build|release|order|invoice|isbn|issn|serial|ref|no|nr|sku|item|id|hash|token|password|section|chapter)[ .:#=]*$"

_LABELERS = ("pattern", "structure", "gazetteer", "cue", "edges", "variety")
_FORMS = 4
#: Different codes at most: kinds, forms, characters before and after, votes.
CODES = len(KINDS) * _FORMS * 3 * 3 * 3 ** len(_LABELERS)

_CANDIDATE = "array<struct<start: long, kind: int, end: long, code: int>>"


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits ends in its check digit."""

    def add(total: Column, i: Column) -> Column:
        twice = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _octets(s: Column) -> Column:
    """Whether all numbers of a dotted string are at most 255."""
    number = F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0))
    return F.forall(number, lambda p: let(F.ltrim(p, F.lit("0")), lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255"))))


def _is_valid(kind: int, s: Column) -> Column:
    """The check of a strict match; a match that fails it is dropped."""
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        return _octets(s)
    if kind == CARD:
        return let(_digits(s), lambda d: F.length(d).between(14, 19) & _luhn(d))
    return F.length(_digits(s)).between(10, 15)


def _code(kind: Column, form: Column, strict: Column, s: Column, before: Column, after: Column) -> Column:
    """Kind, form, edges and votes of a candidate as one number; ``strict``: 1, -1 or 0 if no strict pattern found it."""
    top = F.lower(F.regexp_extract(s, "([A-Za-z0-9-]+)$", 1))
    digits = _digits(s)
    edge = lambda c: F.when(c.rlike("[A-Za-z0-9_]"), 2).when(c.rlike("^[ \t\n\r]?$"), 0).otherwise(1)
    by_kind = lambda *columns: F.when(kind == EMAIL, columns[0]).when(kind == IP, columns[1]).when(kind == CARD, columns[2]).otherwise(columns[3])
    structure = by_kind(
        _vote(top.rlike("^[a-z]{2,}$"), ~top.rlike("^[a-z]{2,}$")), F.when(s.contains(":"), 1).otherwise(_vote(_octets(s), ~_octets(s))),
        F.when(~F.length(digits).between(13, 19), -1).otherwise(F.when(_luhn(digits), 1).otherwise(-1)), _vote(s.startswith("+") & F.length(digits).between(10, 15), ~F.length(digits).between(7, 15)),
    )
    gazetteer = by_kind(
        _vote(top.isin(TOP_DOMAINS), F.length(top) < 2), _vote(~s.rlike(RESERVED), s.rlike(RESERVED)),
        _vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS)), F.when(s.startswith("+"), _vote(s.rlike(COUNTRY_CODES), ~s.rlike(COUNTRY_CODES))).otherwise(_vote(F.lit(False), digits.rlike("^00|^[01]{3}"))),
    )
    cue = F.when(before.rlike(AGAINST), -1).otherwise(by_kind(*[_vote(before.rlike(c), F.lit(False)) for c in CUES]))
    distinct = F.length(F.regexp_replace(digits, r"(.)(?=.*\1)", ""))
    variety = by_kind(_vote(s.rlike("^[^@ ]*[A-Za-z]"), F.lit(False)), _vote(distinct > 1, distinct <= 1), _vote(distinct > 3, distinct < 3), _vote(distinct > 3, distinct < 3))
    left, right = edge(F.right(before, F.lit(1))), edge(F.left(after, F.lit(1)))
    edges = F.when((left == 2) | (right == 2), -1).otherwise(1)
    code = kind
    for value, levels in ((form, _FORMS), (left, 3), (right, 3), *((v + 1, 3) for v in (strict, structure, gazetteer, cue, edges, variety))):
        code = code * levels + value
    return code.cast("int")


def _decode(code: int) -> tuple[int, int, int, int, tuple[int, ...]]:
    """(kind, form, character before, after, votes) of a code."""
    votes = []
    for _ in _LABELERS:
        code, v = divmod(code, 3)
        votes.append(v - 1)
    code, right = divmod(code, 3)
    code, left = divmod(code, 3)
    return code // _FORMS, code % _FORMS, left, right, tuple(reversed(votes))


def _located(text: Column, pattern: str, found: Column) -> Column:
    """(s, start, before, after) of each match in ``found``: all matches of ``pattern`` in the text; places are code points."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.struct(F.length(g).cast("long").alias("n"), F.right(g, F.lit(32)).alias("before"), F.left(g, F.lit(1)).alias("after")))

    def place(m: Column, g: Column) -> Column:
        steps = F.transform(m, lambda s, i: F.get(g, i)["n"] + F.when(i > 0, F.length(F.get(m, i - 1))).otherwise(0))
        starts = running(steps, F.lit(0).cast("long"), lambda a, b: a + b)
        return let(starts, lambda at: F.transform(m, lambda s, i: F.struct(s.alias("s"), F.get(at, i).alias("start"), F.get(g, i)["before"].alias("before"), F.get(g, i + 1)["after"].alias("after"))))

    return let(found, lambda m: let(gaps, lambda g: place(m, g)))


def candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``base`` (valid strict spans, sorted), ``failed`` (codes of failed strict matches) and ``wide`` (proposals apart from base spans)."""
    none = F.array().cast("array<struct<s: string, start: long, before: string, after: string>>")
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select(*keep, text.alias("text"))
    every = [*zip(STRICT, CLUES, strict=True), (WIDE, WIDE_CLUE)]
    found = docs.select("*", *[F.when(F.col("text").contains(clue) if clue == "@" else F.col("text").rlike(clue), F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"__m{k}") for k, (p, clue) in enumerate(every)])
    found = found.select(*keep, *[F.when(F.size(f"__m{k}") > 0, _located(F.col("text"), p, F.col(f"__m{k}"))).otherwise(none).alias(f"__f{k}") for k, (p, _) in enumerate(every)])

    def strict(kind: int) -> Column:
        k, form = F.lit(kind), F.lit(0)

        def row(c: Column) -> Column:
            s = F.left(c["s"], F.lit(64))
            return let(
                _is_valid(kind, c["s"]),
                lambda ok: F.struct(c["start"].alias("start"), k.alias("kind"), (c["start"] + F.length(c["s"])).alias("end"), _code(k, form, F.when(ok, 1).otherwise(-1), s, c["before"], c["after"]).alias("code"), ok.alias("ok")),
            )

        return F.transform(f"__f{kind}", row)

    def wide(c: Column) -> Column:
        s = c["s"]
        digits = F.length(_digits(s))
        email, long_ip, dotted = s.rlike("@|(?i:at)[\\])}]| at "), s.contains(":"), s.contains("[.]")
        kind = F.when(email, EMAIL).when(long_ip | dotted, IP).when(digits > 12, CARD).otherwise(PHONE)
        form = F.when(email, F.when(s.rlike("[\\[({@]"), 1).otherwise(2)).when(long_ip, 2).when(dotted, 1).when(s.rlike("[./_]"), 1).when(s.rlike("[ (-]"), 2).otherwise(3)
        return F.struct(c["start"].alias("start"), kind.alias("kind"), (c["start"] + F.length(s)).alias("end"), _code(kind, form, F.lit(0), F.left(s, F.lit(64)), c["before"], c["after"]).alias("code"))

    rows = found.select(*keep, F.flatten(F.array(*[strict(k) for k in range(4)])).alias("__strict"), F.transform("__f4", wide).alias("wide"))
    plain = lambda c: F.struct(*[c[n].alias(n) for n in ("start", "kind", "end", "code")])
    base = F.array_sort(F.transform(F.filter("__strict", lambda c: c["ok"]), plain)).cast(_CANDIDATE)
    rows = rows.select(*keep, base.alias("base"), F.transform(F.filter("__strict", lambda c: ~c["ok"]), lambda c: c["code"]).alias("failed"), F.col("wide").cast(_CANDIDATE).alias("wide"))
    return rows.withColumn("wide", _apart(F.col("base"), F.col("wide")))


@dataclass
class Model:
    """What the corpus taught: how likely a labeler that votes votes for, by kind, labeler and truth; and the classifier's weights."""

    reliability: dict[tuple[int, int, int], float]
    weights: dict[tuple, float]

    @staticmethod
    def features(code: int) -> list[tuple]:
        kind, form, left, right, votes = _decode(code)
        return [("kind", kind), ("form", kind, form), ("left", left), ("right", right), *(("vote", j, v) for j, v in enumerate(votes) if j and v)]

    def logit(self, code: int) -> float:
        return sum(self.weights.get(f, 0.0) for f in self.features(code))


# How likely each labeler, where it votes, is believed to vote for: on what is no personal data, and on what is.
_BELIEF = ((0.03, 0.97), (0.03, 0.97), (0.50, 0.92), (0.09, 0.91), (0.55, 0.95), (0.50, 0.97))
#: The believed share of personal data among strict matches and among proposals.
_SHARE = (0.5, 0.1)
#: What these beliefs weigh beside the corpus.
BELIEVED = 0.1


def fit(counts: dict[int, int], rounds: int = 100, steps: int = 600) -> Model:
    """EM on the counts of codes, then a logistic regression on its posteriors; both on at most ``CODES`` numbers."""
    codes = sorted(counts)
    seen = [(_decode(c)[0], _decode(c)[4], counts[c]) for c in codes]
    forms = {c: (_decode(c)[0], _decode(c)[1]) for c in codes}
    believed: dict[tuple, float] = defaultdict(lambda: 1.0)
    for (kind, votes, n), c in zip(seen, codes, strict=True):
        believed[forms[c]] += BELIEVED * n
        for j, v in enumerate(votes):
            believed[kind, j, "votes"] += BELIEVED * n * (v != 0)
    pairs = [(k, j, y) for k in range(len(KINDS)) for j in range(len(_LABELERS)) for y in (0, 1)]
    reliability = {(k, j, y): _BELIEF[j][y] for k, j, y in pairs}
    share = {f: _SHARE[f[1] > 0] for f in forms.values()}
    truth: list[float] = []
    for _ in range(rounds):
        new = []
        for (kind, votes, _), c in zip(seen, codes, strict=True):
            odds = math.log(share[forms[c]] / (1 - share[forms[c]]))
            for j, v in enumerate(votes):
                if v:
                    no, yes = reliability[kind, j, 0], reliability[kind, j, 1]
                    odds += math.log(yes / no) if v > 0 else math.log((1 - yes) / (1 - no))
            new.append(1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))))
        moved = max((abs(a - b) for a, b in zip(new, truth, strict=True)), default=0.0) if truth else 1.0
        truth = new
        if moved < 1e-9:
            break
        cast = {(k, j, y): [believed[k, j, "votes"] * p for p in (1 - _BELIEF[j][y], _BELIEF[j][y])] for k, j, y in pairs}
        held = {f: [believed[f] * p for p in (1 - _SHARE[f[1] > 0], _SHARE[f[1] > 0])] for f in share}
        for (kind, votes, n), c, p in zip(seen, codes, truth, strict=True):
            for y, q in ((0, 1 - p), (1, p)):
                held[forms[c]][y] += n * q
                for j, v in enumerate(votes):
                    if v:
                        cast[kind, j, y][v > 0] += n * q
        reliability = {key: row[1] / sum(row) for key, row in cast.items()}
        share = {f: row[1] / sum(row) for f, row in held.items()}
    # Codes weigh by the logarithm of their counts, so that the common ones do not drown the rare ones.
    rows = [(Model.features(c), p, math.log1p(counts[c])) for c, p in zip(codes, truth, strict=True)]
    total = sum(w for *_, w in rows) or 1.0
    model = Model(reliability, dict.fromkeys(sorted({f for fs, *_ in rows for f in fs}), 0.0))
    speed: dict[tuple, float] = dict.fromkeys(model.weights, 1e-9)
    for _ in range(steps):
        slope: dict[tuple, float] = defaultdict(float)
        for fs, p, w in rows:
            z = sum(model.weights[f] for f in fs)
            g = w / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p)
            for f in fs:
                slope[f] += g
        for f in model.weights:
            g = slope[f] + 1e-4 * model.weights[f]
            speed[f] += g * g
            model.weights[f] -= 0.3 * g / math.sqrt(speed[f])
    return model


def _score(model: Model, code: Column) -> Column:
    """The classifier's logit of a code, as a sum of looked-up weights."""
    levels = [len(KINDS), _FORMS, 3, 3, *[3] * len(_LABELERS)]
    below = list(itertools.accumulate(reversed(levels[1:]), lambda a, b: a * b, initial=1))[::-1]
    digit = [F.floor(code / b).cast("int") % n for b, n in zip(below, levels, strict=True)]

    def look(at: Column, names: list[tuple]) -> Column:
        return F.get(F.array(*[F.lit(float(model.weights.get(n, 0.0))) for n in names]), at)

    total = look(digit[0], [("kind", k) for k in range(4)]) + look(digit[0] * _FORMS + digit[1], [("form", k, f) for k in range(4) for f in range(_FORMS)])
    total = total + look(digit[2], [("left", x) for x in range(3)]) + look(digit[3], [("right", x) for x in range(3)])
    for j in range(1, len(_LABELERS)):
        total = total + look(digit[4 + j], [("vote", j, v) for v in (-1, 0, 1)])
    return total


def _apart(base: Column, wide: Column) -> Column:
    """The spans of ``wide`` (among themselves apart, by start) that share no place with one of ``base``."""
    mark = lambda loose: lambda c: F.struct(c["start"].alias("start"), F.lit(loose).alias("loose"), c["end"].alias("end"), c["kind"].alias("kind"), c["code"].alias("code"))
    both = F.array_sort(F.concat(F.transform(base, mark(False)), F.transform(wide, mark(True))))
    far = F.lit(2**62).cast("long")

    def of(x: Column) -> Column:
        upto = running(F.transform(x, lambda c: F.when(c["loose"], F.lit(-1).cast("long")).otherwise(c["end"])), F.lit(-1).cast("long"), lambda a, b: F.greatest(a, b))
        starts = F.transform(F.reverse(x), lambda c: F.when(c["loose"], far).otherwise(c["start"]))
        after = F.reverse(running(starts, far, lambda a, b: F.least(a, b)))
        free = lambda u, a: F.filter(x, lambda c, i: c["loose"] & (F.get(u, i) <= c["start"]) & (F.get(a, i) >= c["end"]))
        return let(upto, lambda u: let(after, lambda a: free(u, a)))

    plain = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["code"].alias("code"))
    return F.when(F.size(wide) > 0, F.transform(let(both, of), plain)).otherwise(wide)


def learn(found: DataFrame) -> Model:
    """A model of the candidates in ``found``; the driver sees a count for each code."""
    codes = F.concat(F.transform("base", lambda c: c["code"]), "failed", F.transform("wide", lambda c: c["code"]))
    rows = found.select(F.explode(codes).alias("code")).groupBy("code").count().collect()
    return fit({r["code"]: r["count"] for r in rows})


def _is(kind: int):
    return lambda k: k == kind


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"], c["end"])), ",")


def find_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Spans of personal data in every whole text.

    ``docs`` needs doc_id and text; other columns, whatever their names, are
    ignored.  Returns doc_id, ``base`` (the strict spans) and ``spans`` (those
    and the accepted proposals that lie apart from them), arrays of (start,
    kind, end, code) by start and kind; places are code points, ends exclusive.
    Null and empty texts have none.  Repeated rows each come back.  Without
    ``model`` one is learned from these documents; an empty table gives an
    empty result.
    """
    work = Work(docs.sparkSession, "pii")
    found = work.save(candidates(docs, ["doc_id"]), "candidates")
    model = model or learn(found)
    taken = F.filter("wide", lambda c: _score(model, c["code"]) >= 0)
    return found.select("doc_id", "base", F.array_sort(F.concat("base", taken)).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: all documents."""
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kinds = F.transform("base", lambda c: c["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
