"""URL filters over redirect equivalence.

Urls that lead to the same page are aliases: spellings that servers redirect
to one form (scheme, ``www.`` and ``m.``, fragment, tracking parameters,
closing slash, ``.html``), refresh redirects and canonical links in the page.
Aliases are the connected components of these edges.  Block rules reach the
aliases of a blocked url; an explicit allow comes first: a url that an allow
rule fits stays allowed, and a component with an allowed member does not hand
a block on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import let, materialize
from tripmart.llm.components import connected_components

TRACKING = "(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
CANONICAL_TAG = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*[\"']?\s*([^\"'<>\s]+)"
REFRESH_TAG = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?\s*([^\"'<>\s]+)"
#: Links that are completed neither from the page's host nor from its folder.
NOT_RELATIVE = r"(?i)^([a-z][a-z0-9+.-]*:|[#?])|(^|/)\.\.(/|$)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def normal_form(url: Column) -> Column:
    """The spelling that an url's aliases share; NULL without a host."""
    host = F.regexp_replace(host_of(url), "^(www|m)\\.", "")
    path = F.regexp_replace(path_of(url), "(/index)?(\\.html?)?/*$", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(_rest(url), "^[^?#]*\\?([^#]*)", 1), TRACKING, ""), "^&", "")
    return F.when(host_of(url) != "", F.concat(F.lit("http://"), host, path,
                                               F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def absolute(link: Column, base: Column) -> Column:
    """A link's url: absolute links as they are, ``//host`` and ``/path`` ones
    completed from the page's host, others from its folder; links with another
    scheme, to a place in the page or through a parent folder are NULL."""
    folder = F.regexp_replace(F.regexp_replace(path_of(base), "[^/]*$", ""), "^$", "/")
    return (F.when(link.rlike("(?i)^https?://"), link).when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(F.lit("http://"), host_of(base), link))
            .when(~link.rlike(NOT_RELATIVE), F.concat(F.lit("http://"), host_of(base), folder, F.regexp_replace(link, r"^(\./)+", ""))))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct (a, b): an url and its normal form, and the normal forms of a
    page and of what its canonical link or refresh names."""
    url, html = F.col("url"), F.col("html")
    named = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    spelled = named.select(url.alias("a"), normal_form(url).alias("b"))
    links = F.array(F.regexp_extract(F.regexp_extract(html, CANONICAL_TAG, 0), HREF, 1),
                    F.regexp_extract(F.regexp_extract(html, REFRESH_TAG, 0), REFRESH_URL, 1))
    linked = named.select(normal_form(url).alias("a"), "url", F.explode(links).alias("link")).where("link != ''") \
        .select("a", normal_form(absolute(F.trim("link"), url)).alias("b"))
    return spelled.unionByName(linked).dropna().distinct()


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, action, rule_host, rule_path) of (action, host and path) pairs."""
    rows = [(rule, action, rule.partition("/")[0].lower(), "/" + rule.partition("/")[2]) for action, rule in rules]
    columns = ["rule", "action", "rule_host", "rule_path"]
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(c) for c in columns])
    # A relation of literals: the planner knows its size, so it is the side that moves, not the urls.
    text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    body = ", ".join("(" + ", ".join(map(text, row)) + ")" for row in rows)
    return spark.sql(f"select * from (values {body}) as t({', '.join(columns)})")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(node, rule, action): the longest rule that fits each url of the column
    ``node``; of equal rules an allow.  Urls that no rule fits are missing.

    An url meets the rules of its host and of each domain above it by an equi-join.
    """
    above = let(F.split(host_of(F.col("node")), "\\."), lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p)), lambda i: F.array_join(F.slice(p, i, F.size(p)), ".")))
    met = urls.select("node", path_of(F.col("node")).alias("path"), F.explode(above).alias("rule_host")) \
        .join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("action") == "allow").alias("is_allow"), "rule", "action"))
    return met.groupBy("node").agg(best.alias("best")).select("node", "best.rule", "best.action")


def decide(edges: DataFrame, urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(node, rule, verdict) of every distinct url of ``urls`` (column ``node``).

    ``edges`` (a, b) join aliases; rules are also read for nodes that are only
    named by an edge.
    """
    edges = materialize(edges.select("a", "b"), "edges")
    alias = materialize(connected_components(edges, "alias"), "alias")
    nodes = urls.select("node").dropna().distinct()
    known = materialize(matched(nodes.unionByName(alias.select("node")).distinct(), rules), "ruled")
    groups = alias.join(known, "node").groupBy("component").agg(
        F.max((F.col("action") == "block").cast("int")).alias("blocked"), F.max((F.col("action") == "allow").cast("int")).alias("allowed"))
    inherited = alias.join(groups, "component").where("blocked = 1 and allowed = 0").select("node", F.lit(True).alias("inherited"))
    return (nodes.join(known, "node", "left").join(inherited, "node", "left")
            .select("node", "rule", F.coalesce("action", F.when(F.col("inherited"), F.lit("block")).otherwise("allow")).alias("verdict")))


def judge_pages(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``.

    A NULL url or one without ``://`` has an empty host and path, no rule and
    no aliases, so it is allowed; repeated urls and ids are judged alike, row
    by row; NULL ids and html are kept; other columns are not read; ``edges``
    (a, b) may add known redirects between urls.
    """
    found = alias_edges(pages, url_col, html_col)
    if edges is not None:
        own = edges.select(F.col(edges.columns[0]).alias("a"), F.col(edges.columns[1]).alias("b"))
        ends = own.select(F.explode(F.array("a", "b")).alias("a")).distinct()
        found = found.unionByName(own).unionByName(ends.select("a", normal_form(F.col("a")).alias("b"))).dropna().distinct()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("node"))
    verdicts = decide(found, rows, rules)
    return rows.join(verdicts, "node", "left").select(
        "id", host_of(F.coalesce("node", F.lit(""))).alias("host"), path_of(F.coalesce("node", F.lit(""))).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"))
