import random

from pyspark.sql import functions as F

from tripmart.llm import redirects as rd
from tripmart.llm.components import connected_components
from tripmart.llm.queries import URL_RULES


def roots(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def test_components_against_union_find(spark):
    rnd = random.Random(1)
    chain = [(i, i + 1) for i in range(1000, 1200)]
    star = [(2000, i) for i in range(2001, 2300)]
    pairs = [(rnd.randrange(500), rnd.randrange(500)) for _ in range(260)] + chain + star + [(7, 7), (9000, 9000), (3, 4), (3, 4)]
    edges = spark.createDataFrame([*pairs, (None, 3), (8000, None)], "x long, y long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == roots(pairs)
    assert connected_components(edges.limit(0)).count() == 0


def test_host_path_and_normal_form(spark):
    cases = {
        "HTTP://WWW.Example.COM/A/b.html?utm_source=x&q=1#t": ("www.example.com", "/A/b.html", "http://example.com/A/b?q=1"),
        "https://m.x.org": ("m.x.org", "", "http://x.org"), "http://x.org/index.html?ref=a": ("x.org", "/index.html", "http://x.org"),
        "http://x.org?u=http://y": ("x.org", "", "http://x.org?u=http://y"), "x.org/a": ("", "", None), "": ("", "", None),
        "://": ("", "", None), "a://É.org/#": ("É.org", "/", "http://É.org"), "s://h#f/p?x": ("h", "", "http://h")}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    for r in df.select("url", rd.host_of(F.col("url")).alias("h"), rd.path_of(F.col("url")).alias("p"),
                       rd.normal_form(F.col("url")).alias("n")).collect():
        assert (r.h, r.p, r.n) == cases[r.url], r.url


def test_blocks_reach_aliases_and_allows_come_first(spark):
    link = '<html><head><LINK  rel="canonical" class=x href="{}"></head>'
    refresh = '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "http://a.example.org/es/1", link.format("http://mirror.net/1")),     # blocked by a rule
        (2, "https://www.mirror.net/1.html", None),                               # alias of 1: no rule
        (3, "http://copy.net/x", refresh.format("//mirror.net/1")),               # alias by way of 2
        (4, "http://other.com/fr/1", link.format("http://copy.net/x")),           # allowed, so no block from here
        (5, "http://lone.net/", link.format("javascript:void(0)")), (6, None, link.format("http://mirror.net/1")), (7, "nothing", ""),
        (8, "http://z.net/a", link.format("/b")), (9, "http://z.net/b", link.format("http://example.org/en/1x")),
        (9, "http://z.net/b", None), (None, "http://z.net/b", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("node", "host", "path", "rule", "verdict", "component")})
    rules = rd.rule_table(spark, URL_RULES)

    def verdicts(rows):
        return {(r.id, r.rule, r.verdict) for r in rd.judge_pages(rows, rules).collect()}
    assert verdicts(df) == {
        (1, "example.org/es/", "block"), (2, None, "allow"), (3, None, "allow"), (4, "com/fr/", "allow"), (5, None, "allow"),
        (6, None, "allow"), (7, None, "allow"), (8, None, "block"), (9, None, "block"), (None, None, "block")}
    without_allow = verdicts(df.where("page_id is null or page_id != 4"))
    assert {(2, None, "block"), (3, None, "block")} <= without_allow
    assert rd.judge_pages(df, rules).count() == len(pages) and rd.judge_pages(df.limit(0), rules).count() == 0
    extra = spark.createDataFrame([("http://lone.net", "http://q.example.org/es/9"), (None, "http://x")], "src string, dst string")
    assert (5, None, "block") in {(r.id, r.rule, r.verdict) for r in rd.judge_pages(df, rules, edges=extra).collect()}


def test_longest_rule_wins(spark):
    rules = rd.rule_table(spark, [("block", "b.com/"), ("allow", "b.com/ok/"), ("allow", "same.com/"), ("block", "same.com/"), ("block", "com/no")])
    urls = ["http://x.b.com/ok/1", "http://b.com/ok", "http://ab.com/", "http://same.com/", "http://q.com/nono", "http://q.com"]
    got = {r.node: (r.rule, r.action) for r in rd.matched(spark.createDataFrame([(u,) for u in urls], "node string"), rules).collect()}
    assert got == {urls[0]: ("b.com/ok/", "allow"), urls[1]: ("b.com/", "block"), urls[3]: ("same.com/", "allow"), urls[4]: ("com/no", "block")}


def test_links_in_all_their_spellings(spark):
    html = {
        "<link href=http://t.net/a rel=canonical>": "http://t.net/a", "<LINK rel='canonical' HREF = ' http://t.net/b '/>": "http://t.net/b",
        "<meta content=\"0; URL='http://t.net/c'\" http-equiv=refresh>": "http://t.net/c",
        "<meta http-equiv='Refresh' content='5;url=http://t.net/d?x=1;y'>": "http://t.net/d?x=1;y",
        "<link rel=canonical href='d.html'>": "http://p.org/x/d", "<link rel=canonical href='./e?q=1'>": "http://p.org/x/e?q=1",
        "<link rel=canonical href='/f'>": "http://p.org/f", "<link rel=canonical href='../g'>": None, "<link rel=canonical href='#top'>": None,
        "<link rel=canonical href='mailto:a@b.c'>": None, "<meta name=x content='url=http://t.net/z'>": None}
    pages = spark.createDataFrame([("http://p.org/x/page.html", h) for h in html], "url string, html string")
    got = {r.b for r in rd.alias_edges(pages).collect()} - {"http://p.org/x/page"}
    assert got == {v for v in html.values() if v}
    bare = spark.createDataFrame([("http://p.org", "<link rel=canonical href='h'>")], "url string, html string")
    assert "http://p.org/h" in {r.b for r in rd.alias_edges(bare).collect()}


def test_the_rules_are_the_side_that_moves(spark):
    """Not the exploded urls: the rules are literals of known size."""
    urls = spark.range(1000).selectExpr("concat('http://h', id, '.example.org/es/') as node")
    plan = rd.matched(urls, rd.rule_table(spark, [*URL_RULES, ("block", "it's.com/\\x")]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
    assert rd.rule_table(spark, [("block", "it's.com/\\x")]).first()["rule"] == "it's.com/\\x" and rd.rule_table(spark, []).count() == 0
