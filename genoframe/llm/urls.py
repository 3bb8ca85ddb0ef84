"""URL filtering with redirect equivalence, in DataFrame functions only.

Rules decide the URLs they fit.  A block also reaches a URL's aliases: URLs
joined to it by redirects and canonical links, in either direction and over
any number of steps, through distributed connected components.  An explicit
allow comes first: it keeps its own URL, and a component that holds one passes
it, and no block, to the URLs that no rule fits.  Aliases are names of one
resource, and who allows it by one of its names has looked at it, so a rule
that is written for a site at large does not take it away by another name; a
URL that a block itself fits stays blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .graph import connected_components
from .work import Work

#: (host, path, verdict)
Rule = tuple[str, str, str]

#: The rules of the query.
RULES: tuple[Rule, ...] = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, or null; of equally long ones an allow."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), r[2] != "allow", r))
    out = None
    for h, p, verdict in ordered:
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


#: Entities in attribute values, by name or number; the ampersand last, so that nothing is decoded twice.
_ENTITIES = (("lt", 60, "<"), ("gt", 62, ">"), ("quot", 34, '"'), ("apos", 39, "'"), ("sol", 47, "/"), ("colon", 58, ":"), ("quest", 63, "?"), ("equals", 61, "="), ("amp", 38, "&"))


def decoded(value: Column) -> Column:
    """With the entities of ``_ENTITIES`` as characters."""
    for name, n, char in _ENTITIES:
        value = F.regexp_replace(value, F.lit(rf"(?i)&(?:{name}|#0*{n}|#x0*{n:x});"), F.lit(char))
    return value


def without_dots(path: Column) -> Column:
    """A path that starts with ``/``, its ``.`` and ``..`` segments carried out."""
    parts = F.split(F.substr(path, F.lit(2)), "/", -1)
    step = lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))


def resolved(base: Column, target: Column) -> Column:
    """``target`` as a whole URL, as seen from ``base`` (RFC 3986, 5.2); null for other schemes (mailto:) and a base without host.

    A target that is whole stays as it stands.
    """
    scheme, site = F.regexp_extract(base, r"(?s)^([^/?#]*:)//", 1), F.regexp_extract(base, r"(?s)^([^/?#]*://[^/?#]*)", 1)
    path, asked = path_of(base), F.regexp_extract(base, r"(?s)^[^?#]*(\?[^#]*)", 1)
    own, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    far_host, far_path = F.regexp_extract(own, r"(?s)^(//[^/]*)", 1), F.regexp_extract(own, r"(?s)^//[^/]*(.*)$", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    return (
        F.when(target.rlike(r"^[^/?#]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | (site == "") | (target == ""), F.lit(None))
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, far_host, F.when(far_path == "", F.lit("")).otherwise(without_dots(far_path)), rest))
        .when(F.startswith(target, F.lit("/")), F.concat(site, without_dots(own), rest))
        .when(F.startswith(target, F.lit("?")), F.concat(site, path, target))
        .when(F.startswith(target, F.lit("#")), F.concat(site, path, asked, target))
        .otherwise(F.concat(site, without_dots(F.concat(folder, own)), rest))
    )


def links_of(pages: DataFrame, relative: bool = False) -> DataFrame:
    """(source, target) from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` in html, entities decoded.

    A target may leave out the scheme (//host/path) or the host too (/path).  With ``relative``, those that are relative
    to the path or the query (near, ../x, ?p=1) count too, and all are seen from the first ``<base href>`` if there is one.
    """
    attribute = lambda tag, name: decoded(F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    canonical = F.transform(F.filter(F.regexp_extract_all("html", F.lit(r"(?is)(<link\b[^>]*>)")), lambda t: F.rlike(t, F.lit(r"""(?is)\brel\s*=\s*(?:"[^"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"""))), lambda t: attribute(t, "href"))
    refresh = F.transform(F.filter(F.regexp_extract_all("html", F.lit(r"(?is)(<meta\b[^>]*>)")), lambda t: F.rlike(t, F.lit(r"(?is)http-equiv\s*=\s*[\"']?\s*refresh\b"))), lambda t: attribute(t, "url"))
    base = F.regexp_extract("html", r"(?is)(<base\b[^>]*\bhref\s*=[^>]*>)", 1) if relative else F.lit("")
    found = pages.where("url is not null and html is not null").select(F.col("url").alias("source"), base.alias("base"), F.explode(F.concat(canonical, refresh)).alias("target"))
    if relative:
        found = found.withColumn("base", F.coalesce(resolved(F.col("source"), attribute(F.col("base"), "href")), "source"))
    else:
        found = found.withColumn("base", F.col("source")).where(F.startswith("target", F.lit("/")) | F.col("target").rlike(r"^[^/?#]*://"))
    return found.select("source", resolved(F.col("base"), F.col("target")).alias("target")).where("target is not null")


def filter_urls(pages: DataFrame, links: DataFrame, rules: Sequence[Rule] = RULES, default: str = "allow") -> DataFrame:
    """Judge every row of ``pages`` (page_id, url); ``links`` has source and target URLs.

    Returns page_id, url, host, path, rule, verdict.  URLs are nodes as they
    stand; links to URLs without a page count too, so a block on a redirect's
    middle step is passed on.  Rule null and verdict ``default`` where neither
    a rule nor an alias decides; a null url has an empty host and path, and no
    links.  Repeated pages are judged alike.
    """
    work = Work(pages.sparkSession, "urls")
    edges = links.where("source is not null and target is not null and source <> target").select("source", "target").distinct()
    parts = connected_components(edges, work, "source", "target")
    decided = best_rule(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
    # A component passes on an allow if it holds one, else a block.
    passed = parts.withColumn("v", decided).where("v is not null").groupBy("component").agg(F.min("v").alias("passed"))
    of_url = parts.join(passed, "component").select(F.col("node").alias("url"), "passed")
    rows = pages.select("page_id", "url").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    own = rows.withColumn("own", best_rule(F.col("host"), F.col("path"), rules))
    judged = own.join(of_url, "url", "left")
    return judged.select("page_id", "url", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", "passed", F.lit(default)).alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: all pages, with the links in their html."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages.select("page_id", "url"), links_of(pages, relative=True)).drop("url")


#: With a recursive closure over links to whole URLs; relative targets, entities and base elements are held against the tests.
SQL = r"""
WITH RECURSIVE t AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
x AS (SELECT url AS a, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1) AS b FROM t WHERE regexp_matches(tag, '(?is)^<link') AND regexp_matches(tag, '(?is)\brel\s*=\s*(?:"[^"]*\bcanonical\b|''[^'']*\bcanonical\b|canonical\b)')
      UNION SELECT url, regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1) FROM t WHERE regexp_matches(tag, '(?is)^<meta') AND regexp_matches(tag, '(?is)http-equiv\s*=\s*["'']?\s*refresh\b')),
e AS (SELECT a, b FROM x WHERE regexp_matches(b, '^[^/?#]*://') AND a <> b UNION SELECT b, a FROM x WHERE regexp_matches(b, '^[^/?#]*://') AND a <> b),
c(node, other) AS (SELECT DISTINCT a, a FROM e UNION SELECT c.node, e.b FROM c JOIN e ON e.a = c.other),
u AS (SELECT url FROM pages UNION SELECT a FROM e),
p AS (SELECT url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT * FROM (SELECT p.url, p.host, p.path, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.url ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
      FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) WHERE k = 1),
v AS (SELECT c.node, min(m.verdict) AS passed FROM c JOIN m ON m.url = c.other GROUP BY 1)
SELECT g.page_id, m.host, m.path, m.rule, coalesce(m.verdict, v.passed, 'allow') AS verdict FROM pages g JOIN m ON m.url IS NOT DISTINCT FROM g.url LEFT JOIN v ON v.node = g.url
"""
