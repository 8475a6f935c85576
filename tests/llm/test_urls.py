import random

from helpers import DATA, same
from pyspark.sql import functions as F

from pageloom.llm import queries
from pageloom.llm.components import connected_components
from pageloom.llm.queries import RULES
from pageloom.llm.url_rules import absolute, dereferenced, filter_urls


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string, component long")


def verdicts(spark, rows):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages(spark, [(i, u, h, "x", "y", 1) for i, (u, h) in enumerate(rows)]), RULES).collect()}


def test_rules(spark):  # page 2 fits no rule, but has the address of page 3
    got = verdicts(spark, [
        ("http://A.example.NET/en/x?q#f", None), ("https://example.net/fr", ""), ("http://net", None), ("http://net/", None), ("http://internet/", None), ("x://b.example.com/de/1", None), ("http://example.com/DE/1", None),
        ("http://w.org/fr/", None), (None, None), ("no scheme", None), ("http://?q", None), ("http://host#f/en/", None), ("a://b://c/d", None), ("http://w.org/frx\ny?z", None),
    ])
    assert got == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"), 1: ("example.net", "/fr", "net/", "block"), 2: ("net", "", None, "block"), 3: ("net", "/", "net/", "block"), 4: ("internet", "/", None, "allow"),
        5: ("b.example.com", "/de/1", "example.com/de/", "block"), 6: ("example.com", "/DE/1", None, "allow"), 7: ("w.org", "/fr/", "org/fr/", "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
        10: ("", "", None, "allow"), 11: ("host", "", None, "allow"), 12: ("b:", "//c/d", None, "allow"), 13: ("w.org", "/frx\ny", None, "allow"),
    }


def link(to):
    return f'<html><head><link rel="canonical" href="{to}"></head></html>'


def test_blocks_reach_aliases_and_allow_takes_precedence(spark):
    got = verdicts(spark, [
        ("http://a.com/1", link("http://b.com/2")), ("http://b.com/2", '<meta http-equiv="refresh" content="0; url=/3">'), ("http://b.com/3", link("https://example.com/de/9")), ("http://example.com/de/9", None),
        ("http://c.com/1", link("http://example.com/de/8")), ("http://example.com/de/8", None), ("http://c.com/2", link("http://c.com/1")), ("http://w.org/fr/1", link("http://c.com/2")),
        ("http://d.com/1", "<p>canonical refresh</p>"), ("https://d.com/1/", None),
    ])
    assert [got[i][3] for i in range(10)] == ["block", "block", "block", "block", "allow", "block", "allow", "allow", "allow", "allow"]


def test_targets_that_are_no_pages_are_judged(spark):
    got = verdicts(spark, [
        ("http://a.com/1", link("http://example.com/de/1")), ("http://b.com/1", '<meta http-equiv="refresh" content="0; url=/2">'), ("http://b.com/2", link("//c.net/")),
        ("http://d.com/1", link("http://e.net/1")), ("http://d.com/2", link("http://d.com/1")), ("http://d.com/3", link("http://d.com/2") + link("http://w.org/fr/9")),
        ("http://net", link("http://net/")), ("http://f.com/1", link("http://g.com/1")),
    ])
    assert [got[i][3] for i in range(8)] == ["block", "block", "block", "allow", "allow", "allow", "block", "allow"]


def test_character_references_in_targets(spark):
    got = verdicts(spark, [
        ("http://a.com/1", link("http://a.com/2?a=1&amp;b=2")), ("http://a.com/2?a=1&b=2", link("http://s.net/1")),
        ("http://b.com/1", link("http:&#47;/b.com/2?a=1&copy=2&#x26;c=3")), ("http://b.com/2?a=1&copy=2&c=3", link("http://s.net/2")),
    ])
    assert [got[i][3] for i in range(4)] == ["block"] * 4
    assert [dereferenced(x) for x in (None, "a&b", "&eacute;&eacute", "&ampx;&amp=&nosuch;", "it&#39;s", "&quot;http://x/&quot;")] == [None, "a&b", "éé", "&ampx;&amp=&nosuch;", "it's", '"http://x/"']


def test_ways_to_write_a_link(spark):
    block = "http://s.net/1"
    got = verdicts(spark, [
        ("http://a.com/x/1", f"<link title='a > b' rel='alternate canonical' href='{block}'>"), ("http://a.com/x/2", f"<link href={block} rel=canonical>"), ("http://a.com/x/y/3", link("../2")), ("http://a.com/x/4", link("./2")),
        ("http://a.com/x/5", f"""<meta content="0; URL='{block}'" http-equiv=Refresh>"""), ("http://a.com/x/6", link("?q=1")), ("http://a.com/x/6?q=1", link("&quot;http://s.net/2&quot;")),
        ("http://a.com/7", f"<link rel='not-canonical' href='{block}'>"), ("http://a.com/8", link("http://[bad")), ("http://a.com/9", "<link rel=canonical " * 20000),
    ])
    assert [got[i][3] for i in range(10)] == ["block"] * 7 + ["allow"] * 3
    assert absolute(None, None) is None and absolute("b", "http://x/a/c") == "http://x/a/b"


def test_redirects_as_a_table_and_hot_addresses(spark):
    hops = spark.createDataFrame([("http://a.com/1", "http://b.com/1"), ("http://b.com/1", "http://s.net/"), (None, "http://s.net/"), ("http://c.com/", None)], "from_url string, to_url string")
    rows = [(0, "http://a.com/1", None), (1, "http://b.com/1", None), (2, "http://c.com/", None)] + [(i, "http://a.com/1" if i % 2 else None, None) for i in range(3, 300)]
    got = {r.page_id: r.verdict for r in filter_urls(pages(spark, [(*r, "x", "y", 1) for r in rows]), RULES, redirects=hops).collect()}
    assert got == {i: "block" if i < 2 or (i > 2 and i % 2) else "allow" for i in range(300)}


def test_empty(spark):
    assert verdicts(spark, []) == {}


def test_query(spark, duck):
    same(queries.op3_url_filter(spark, DATA), duck, queries.ORACLE_SQL["op3_url_filter"])


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(200)] + [(7, 7), (3, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "s long, d long")
    got = {r.node: r.component for r in connected_components(df, "s", "d").collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(df.where(F.lit(False)), "s", "d").count() == 0
