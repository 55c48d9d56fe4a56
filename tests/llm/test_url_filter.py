"""URL rules and propagation against plain Python, components against a walk,
and the odd cases."""
import random
import re

from llm_support import SF01
from pyspark.sql import functions as F
from termflow.llm import url_filter as uf
from termflow.llm.common import connected_components

SCHEMA = "page_id long, url string, html string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return low, re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def rule(host, path):
    fits = [(h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def test_rules_on_all_pages(spark):
    got = uf.judge_pages(spark.read.parquet(f"{SF01}/pages.parquet")).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    assert len(got) == len(urls) and {r.verdict for r in got} == {"allow", "block"}
    for r in got:
        name, verdict = rule(*parts(urls[r.page_id]))
        assert (r.host, r.path, r.rule) == (*parts(urls[r.page_id]), name)
        assert r.verdict == (verdict or "allow")


def test_odd_urls(spark):
    urls = [None, "", "nothing", "://", "http://", "HTTP://A.COM", "x://É.Net/es/a?b#c", "http://net/es/", "a://b?c/d",
            "http://com", "http://www.example.com/en/x", "http://x.example.com/en/", "http://example.com/EN/",
            "http://notexample.com/en/", "http://a.net/fr", "http://a.net/fr/#x://y", "http://h://net/es/"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(None, "http://a.net/es/", "x")] * 2, SCHEMA)
    got = uf.judge_pages(pages).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r.page_id is not None:
            name, verdict = rule(*parts(urls[r.page_id]))
            assert (r.host, r.path, r.rule, r.verdict) == (*parts(urls[r.page_id]), name, verdict or "allow"), r
    wide = uf.filter_urls(pages.withColumn("rule", F.lit(1)).withColumn("a.b", F.lit(1)).withColumn("node", F.lit(1)))
    assert wide.columns.count("rule") == 1 and "a.b" in wide.columns and wide.count() == len(got)
    assert uf.judge_pages(pages.limit(0)).count() == 0


def test_blocks_reach_aliases_and_allows_win(spark):
    canon = lambda u: f'<html><head><LINK  href="{u}" rel="nofollow Canonical"></head>'
    jump = lambda u: f"<meta content='0; URL={u}' http-equiv=Refresh>"
    rows = [(1, "http://a.org/x", canon("http://b.net/es/1")),        # alias of a blocked url
            (2, "http://c.org/y#f", jump("http://a.org/x")),          # alias of the alias
            (3, "https://a.org/x", ""),                               # the same node
            (4, "http://d.org/z", canon("https://e.org/z")),          # nothing blocked
            (5, "http://f.org/q", canon("http://www.example.com/en/1")),  # allowed target
            (6, "http://g.org/q", canon("http://f.org/q")),
            (7, "http://h.net/fr/1", canon("http://f.org/q")),        # own block stays
            (8, "http://i.org/a/b", canon("c?x=1&amp;y=2")),
            (9, "http://i.org/a/c?x=1&y=2", jump("/fr")),
            (10, "http://i.org/fr", canon("//h.net/fr/2")),
            (11, "http://j.org/", canon("")), (12, "http://k.org/1", canon("mailto:x@h.net/es/"))]
    got = {r.page_id: r.verdict for r in uf.judge_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block",
                   9: "block", 10: "block", 11: "allow", 12: "allow"}
    table = spark.createDataFrame([("http://j.org", "http://z.net/es/"), (None, "http://z.net/es/")], "src string, dst string")
    got = {r.page_id: r.verdict for r in uf.filter_urls(spark.createDataFrame(rows, SCHEMA), redirects=table).collect()}
    assert got[11] == "block" and got[12] == "allow"


def test_components_equal_a_walk(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(200)] + [(7, 7), (None, 3)]
    rng.shuffle(edges)
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        stack = [] if start in want else [start]
        while stack:
            v = stack.pop()
            if v not in want:
                want[v] = start
                stack += near[v]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_no_python_in_the_plan(spark):
    plan = uf.judge_pages(spark.read.parquet(f"{SF01}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
