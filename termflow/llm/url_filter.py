"""URL filters with redirect equivalence, in DataFrame operations only.

Rules (verdict, host, path) fit their host and its subdomains when the url's
path starts with theirs; the longest wins (allow, when two of one length fit).
Pages that redirect or name a canonical link are joined with their target to
classes of equivalent urls by connected components. A url without a rule of
its own takes the class's decision: allow when any url of the class is
explicitly allowed, else block when any is blocked, else allow.

Edges come from ``<link rel="canonical" href>`` and
``<meta http-equiv="refresh" content="..;url=..">`` in the html, and from an
optional table of redirects (src, dst). A url's node is its host, path ("/"
when empty) and query; scheme and fragment do not tell nodes apart. Relative
targets are taken against the page's url.

Defined results: a null url or one without ``://`` has an empty host and path,
no node, no edges, and is allowed unless a rule fits; a link without a target
or to the page itself is no edge. Repeated rows are judged alike. Extra
columns pass through; those named like a result column are replaced.

Scale: rules are a short list in the plan. Only pages with a link take part in
the components, which are computed on a written edge table round by round; hub
targets are pre-aggregated. The page table is read for its links and for the
result, and html is never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Passed, connected_components, written

#: Fixed by the query's contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
RESULT = ("host", "path", "rule", "verdict")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^([^/?#]*)([^?#]*)(\?[^#]*)?"
_ATTRIBUTE = r"""(?is)[\s"'/]%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), _PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """host + path + query; null without ``://`` or host."""
    path = path_of(url)
    node = F.concat(host_of(url), F.when(path == "", "/").otherwise(path),
                    F.coalesce(F.regexp_extract(_rest(url), _PARTS, 3), F.lit("")))
    return F.when(host_of(url) != "", node)


def resolve(target: Column, url: Column) -> Column:
    """An absolute url for a link found on ``url``; null when there is none."""
    t = F.btrim(F.replace(target, F.lit("&amp;"), F.lit("&")), F.lit(" \t\n\r"))
    base = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (F.when(t.isNull() | (t == "") | t.startswith("#") | host_of(url).isin(""), None)
            .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
            .when(t.startswith("//"), F.concat(F.lit("http:"), t))
            .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
            .when(t.startswith("/"), F.concat(base, t))
            .when(t.startswith("?"), F.concat(base, path_of(url), t))
            .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), t)))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag; empty without one."""
    return reduce(F.concat, [F.regexp_extract(tag, _ATTRIBUTE % name, k) for k in (1, 2, 3)])


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) urls of the canonical and refresh links of the pages."""
    low = F.lower(F.col("html"))
    linked = pages.select("url", "html").where(
        F.col("url").isNotNull() & (low.contains("canonical") | low.contains("refresh")))
    tags = linked.select("url", F.explode(F.expr(
        r"regexp_extract_all(html, '(?is)<(?:link|meta)[\\s/][^>]*>', 0)")).alias("tag"))
    canonical = F.lower(F.substr("tag", F.lit(1), F.lit(5))) == "<link"
    relation = F.array_contains(F.split(F.lower(_attribute(F.col("tag"), "rel")), r"\s+"), "canonical")
    refresh = F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh"
    jump = F.regexp_extract(_attribute(F.col("tag"), "content"), r"""(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)
    target = F.when(canonical & relation, _attribute(F.col("tag"), "href")).when(~canonical & refresh, jump)
    # Written step by step: the expressions nest, and one plan would repeat each of them many times.
    named = written(tags.select("url", target.alias("target")).where("target <> ''"), "link-targets")
    return written(named.select(F.col("url").alias("src"), resolve(F.col("target"), F.col("url")).alias("dst"))
                   .where("dst is not null").distinct(), "link-urls")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; null when none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow"))
    name = verdict = F.lit(None).cast("string")
    for decision, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def filter_urls(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    own = Passed(pages, RESULT)
    edges = link_edges(own.frame.select(own.col("url").alias("url"), own.col("html").alias("html")))
    if redirects is not None:
        edges = edges.union(redirects.select(F.col("src").cast("string"), F.col("dst").cast("string")))
    edges = written(edges.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")), "links")
    classes = written(connected_components(edges), "classes")

    # A class decides by all its urls, also those that are only targets.
    slash = F.instr("node", "/")
    host, path = F.substr("node", F.lit(1), slash - 1), F.regexp_extract(F.substr("node", slash), r"^[^?]*", 0)
    _, verdict = rule_of(host, path, rules)
    decided = (classes.withColumn("v", verdict).groupBy("component")
               .agg(F.max((F.col("v") == "allow").cast("int")).alias("allowed"),
                    F.max((F.col("v") == "block").cast("int")).alias("blocked"))
               .where("coalesce(blocked, 0) = 1 and coalesce(allowed, 0) = 0").select("component"))
    blocked = written(classes.join(decided, "component", "left_semi").select("node"), "blocked")

    url = own.col("url")
    name, decision = rule_of(F.col("host"), F.col("path"), rules)
    judged = own.frame.select(*own.kept, host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("key"))
    joined = judged.join(blocked, F.col("key") == F.col("node"), "left")
    return joined.select(*own.kept, "host", "path", name.alias("rule"),
                         F.coalesce(decision, F.when(F.col("node").isNotNull(), "block"), F.lit("allow")).alias("verdict")
                         ).toDF(*own.names, *RESULT)


def judge_pages(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict)."""
    return filter_urls(pages.select("page_id", "url", "html"), rules).drop("url", "html")
