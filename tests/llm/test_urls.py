from genoframe.llm import urls

RULES = (("bad.com", "/", "block"), ("ok.bad.com", "/", "allow"), ("good.org", "/a/", "allow"))


def judge(spark, pages, links, rules=RULES):
    p = spark.createDataFrame(pages, "page_id long, url string")
    l = spark.createDataFrame(links, "source string, target string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(p, l, rules).collect()}


def test_blocks_reach_aliases_and_allows_come_first(spark):
    pages = [(1, "http://BAD.com/x?q#f"), (2, "https://alias.net/1"), (3, "http://far.net/2"), (4, "http://ok.bad.com/y"), (5, "http://good.org/a/1"), (6, "http://mixed.net/"), (7, "http://clean.net/p"), (8, None), (9, "no scheme"), (10, "http://notbad.com"), (11, "x://h#a/b?c"), (12, "https://alias.net/1")]
    links = [("https://alias.net/1", "http://middle.net/"), ("http://middle.net/", "http://BAD.com/x?q#f"), ("http://far.net/2", "https://alias.net/1"), ("http://mixed.net/", "http://ok.bad.com/y"), ("http://mixed.net/", "http://deep.bad.com/z"), ("http://good.org/a/1", "http://BAD.com/x?q#f"), (None, "x"), ("http://clean.net/p", "http://clean.net/p")]
    got = judge(spark, pages, links[:5] + links[6:])
    assert got[1] == ("bad.com", "/x", "bad.com/", "block")
    assert [got[i][3] for i in (2, 3, 12)] == ["block"] * 3 and got[2][2] is None
    assert got[4][2:] == ("ok.bad.com/", "allow") and got[5][2:] == ("good.org/a/", "allow")
    assert got[6][2:] == (None, "allow")  # an explicit allow and a block among its aliases
    assert got[7][3] == "allow" and got[8] == ("", "", None, "allow") and got[9][:2] == ("", "") and got[10][2] is None and got[11][:2] == ("h", "")
    got = judge(spark, pages, links)  # now the component of page 1 holds an allow: it passes on no block, and keeps its own
    assert got[1][3] == "block" and got[5][3] == "allow" and got[2][3] == "allow"


def test_long_chains(spark):
    pages = [(i, f"http://s{i}.net/") for i in range(200)]
    links = [(f"http://s{i}.net/", f"http://s{i + 1}.net/") for i in range(199)] + [("http://s199.net/", "http://bad.com/end")]
    assert {v[3] for v in judge(spark, pages, links).values()} == {"block"}


def test_links_in_html(spark):
    html = """<html><head><LINK href='http://a.b/c' rel="canonical"><link rel=stylesheet href="http://no/x"><meta http-equiv="Refresh" content="0; URL=https://d.e/f?g=1"></head>"""
    rows = [(1, "http://u/", html), (2, "http://v/", None), (3, None, html), (4, "http://w/a?b", '<link rel="canonical" href="/relative"><link rel="canonical" href="//x.y/z"><link rel="canonical" href="near">')]
    got = {tuple(r) for r in urls.links_of(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {("http://u/", "http://a.b/c"), ("http://u/", "https://d.e/f?g=1"), ("http://w/a?b", "http://w/relative"), ("http://w/a?b", "http://x.y/z")}


def test_relative_links_and_entities(spark):
    canonical = lambda *hrefs: "".join(f'<link rel="canonical" href="{h}">' for h in hrefs)
    rows = [
        (1, "http://w/a/b?q=1#f", canonical("near.html", "../x", "?p=1&amp;r=2", "./y/./z/..", "../../../up", "#g", "mailto:a@b", "/k/../l?m=../n", "//h/o/../p", "http://e/?a=1&#038;b=&amp;lt;")),
        (2, "http://top", canonical("near") + '<meta http-equiv="refresh" content="0; url=?s=http://t/">'),
        (3, "http://w/a/", '<base href="/deep/er/">' + canonical("near")),
        (4, "no host", canonical("near?u=http://x/")),
    ]
    got = sorted(tuple(r) for r in urls.links_of(spark.createDataFrame(rows, "page_id long, url string, html string"), relative=True).collect())
    first = ["http://e/?a=1&b=&lt;", "http://h/p", "http://w/a/b?p=1&r=2", "http://w/a/b?q=1#g", "http://w/a/near.html", "http://w/a/y/", "http://w/l?m=../n", "http://w/up", "http://w/x"]
    assert got == sorted([("http://w/a/b?q=1#f", u) for u in first] + [("http://top", "http://top/near"), ("http://top", "http://top?s=http://t/"), ("http://w/a/", "http://w/deep/er/near")])


def test_a_block_reaches_relative_aliases_in_the_query(spark, tmp_path):
    rows = [(1, "http://u.net/a/1", '<link rel="canonical" href="2?x=1&amp;y=2">'), (2, "http://u.net/a/2?x=1&y=2", '<link rel="canonical" href="http://s.com/de/1">'), (3, "http://u.net/a/3", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: r.verdict for r in urls.query(spark, str(tmp_path)).collect()} == {1: "block", 2: "block", 3: "allow"}


def test_the_query_equals_its_sql_where_pages_have_aliases(spark, tmp_path):
    import duckdb

    link = lambda *urls: "".join(f'<link rel="nofollow canonical" href="{u}">' for u in urls)
    rows = [(i, f"http://s{i}.net/p", link(f"http://s{i // 2}.net/p") if i % 7 else "<meta http-equiv=refresh content='1;url=http://z.com/de/'>") for i in range(1, 60)]
    rows += [(100, "http://z.com/de/", link("http://y.com/x")), (101, "http://y.com/x", None), (102, "http://y.com/x", link("http://s3.net/p")), (103, "http://EXAMPLE.org/es/1", link("http://lone.net/")), (104, "http://lone.net/", ""), (105, None, link("http://lone.net/"))]
    rows += [(110, "http://q.org/", link("http://r.net/", "http://t.com/de/9")), (111, "http://r.net/", ""), (112, "http://t.com/de/9", "x" * 200_000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = urls.query(spark, str(tmp_path))
    got = sorted(tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(urls.SQL).fetchall())
    told = {g[0]: g[4] for g in got}
    assert told[101] == "block" and told[104] == "block" and told[111] == "allow" and told[112] == "block"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExternalRDD"))  # native


def test_repeated_pages_clashing_columns_and_long_urls(spark):
    long = "http://bad.com/" + "a/" * 20_000
    pages = spark.createDataFrame([(1, long, "x"), (1, long, "x"), (2, "http://w.net/", "y")], "page_id long, url string, verdict string")
    links = spark.createDataFrame([("http://w.net/", long, 1), ("http://w.net/", long, 2)], "source string, target string, component int")
    assert sorted(r.verdict for r in urls.filter_urls(pages, links, RULES).collect()) == ["block"] * 3


def test_empty(spark):
    assert judge(spark, [], []) == {}
    assert judge(spark, [(1, "http://bad.com/")], [], ())[1][2:] == (None, "allow")
