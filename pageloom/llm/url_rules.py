"""URL filtering by rules, whose decisions reach the aliases of a page.

A rule (host, path prefix) fits the host and all its subdomains; of the rules that fit, the longest wins.  Pages that
redirect to each other or name a common canonical address are aliases: connected components over these edges carry a
block to the pages that no rule decides, unless an allow rule decides an address of the same component, which takes
precedence.  The targets of links are judged as well as the pages, whether they are pages themselves or not.
"""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass
from functools import reduce
from html.entities import html5
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, saved
from .components import connected_components


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse(url: Column) -> tuple[Column, Column]:
    """Host and path of an address; both empty where it is null or has no ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    found = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    host = F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def decide(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (the first named, of equals), as text, and its verdict; null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def address(url: Column) -> Column:
    """What stands for a page among edges: the address without its scheme, fragment, port 80 or 443, and last slash."""
    rest = F.regexp_extract(url, r"(?s)^\s*[A-Za-z][A-Za-z0-9+.-]*://([^#\s]*)", 1)
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(host, r":(80|443)$", "")
    after = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*(.*)$", 1), r"/$", "")
    return F.when(rest != "", F.concat(host, after))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value, in quotes or without; empty if there is none."""
    values = [F.regexp_extract(tag, rf"(?is)(?<![-\w]){name}\s*=\s*{v}", 1) for v in ('"([^"]*)"', "'([^']*)'", """([^"'\\s>]+)""")]
    return F.when(values[0] != "", values[0]).when(values[1] != "", values[1]).otherwise(values[2])


def link_targets(html: Column) -> Column:
    """Addresses in canonical links and immediate redirects of a page, as they are written."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?is)(<(?:link|meta)\s(?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+>)"""), F.lit(1))  # no < inside, so that a broken page is read once
    canonical = F.filter(tags, lambda t: t.rlike("(?i)^<link") & _attribute(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)"))
    refresh = F.filter(tags, lambda t: t.rlike("(?i)^<meta") & _attribute(t, "http-equiv").rlike(r"(?i)^\s*refresh\s*$"))
    hrefs = F.transform(canonical, lambda t: F.trim(_attribute(t, "href")))
    urls = F.transform(refresh, lambda t: F.trim(F.regexp_extract(_attribute(t, "content"), r"(?is)\burl\s*=\s*(.+)$", 1)))
    return F.filter(F.concat(hrefs, urls), lambda u: u != "")


_REFERENCE = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|([A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=]))))")


def dereferenced(target: str | None) -> str | None:
    """A target with its character references decoded as in attributes: a name counts as one if it ends with a
    semicolon, or is of the old ones and neither = nor a letter or digit follows."""
    if target is None or "&" not in target:
        return target
    return _REFERENCE.sub(lambda m: references.unescape(m[0]) if m[1] is None else html5.get(m[1], m[0]), target)


def absolute(target: str | None, url: str | None) -> str | None:
    """A target, its references decoded, against the page's own address: absolute, //host, /path, ?query, beside the page,
    with ./ and ../ taken out.  None where either is no address."""
    to = (dereferenced(target) or "").strip()
    to = to[1:].split(to[0])[0] if to[:1] in ("'", '"') else to
    try:
        return urljoin(url or "", to) or None
    except ValueError:
        return None


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule, component (null without an address), verdict: one row for each row of pages.

    redirects: (from_url, to_url), absolute addresses of redirects met while crawling; aliases as canonical links are.

    Null and malformed urls have empty host and path, fit no rule and have no aliases, so their verdict is the default.
    Null html has no edges; html and urls may be of any length.  A target counts with the decision on its absolute
    address, be it a row or not.  Rows with the same address are aliases of each other, whatever their ids; a third of
    all rows may share one address, since edges are distinct pairs of addresses and what rows are joined with is written
    before, so that hot partitions can be split.  Ties of rules go to the one named first.  An empty table gives an
    empty result; extra columns are not read.
    """
    url = F.col("_url")
    host, path = parse(url)
    base = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").cast("string").alias("_url"), *([F.col(f"`{html_col}`").cast("string").alias("_html")] if html_col else []))
    rule, verdict = decide(F.col("_host"), F.col("_path"), rules)
    judged = base.withColumns({"_host": host, "_path": path}).withColumns({"_rule": rule, "_own": verdict, "_address": address(url)})
    plain = judged.select("_id", "_url", "_host", "_path", "_rule", "_own", "_address", F.xxhash64("_address").alias("_node"))
    hops = []
    if html_col:
        linked = judged.where(F.col("_html").rlike("(?i)canonical|refresh") & F.col("_address").isNotNull())
        resolved = F.udf(absolute, "string", useArrow=True)
        hops.append(linked.select("_url", F.explode(link_targets(F.col("_html"))).alias("_to")).select(F.col("_url").alias("_from"), resolved("_to", "_url").alias("_to")))
    if redirects is not None:
        hops.append(redirects.select(F.col("from_url").cast("string").alias("_from"), F.col("to_url").cast("string").alias("_to")))
    component, ends = plain.withColumn("_component", F.col("_node")), None
    if hops:
        both = reduce(DataFrame.unionAll, hops)
        pairs = both.select(*[c for n in ("_from", "_to") for c in (address(F.col(n)).alias(n), decide(*parse(F.col(n)), rules)[1].alias(f"{n}_own"))])
        pairs = pairs.where("_from is not null and _to is not null").distinct()
        edges = saved(pairs.select("_from_own", "_to_own", F.xxhash64("_from").alias("_a"), F.xxhash64("_to").alias("_b")))
        if not edges.isEmpty():
            labels = connected_components(edges, "_a", "_b")
            component = plain.join(labels, F.col("_node") == F.col("node"), "left").withColumn("_component", F.coalesce("component", "_node"))
            named = edges.select(F.col("_a").alias("_n"), F.col("_from_own").alias("_own")).unionAll(edges.select("_b", "_to_own")).where("_own is not null").distinct()
            ends = named.join(labels, F.col("_n") == F.col("node"), "left").select(F.coalesce("component", "_n").alias("_component"), "_own")
    own = component.where("_own is not null and _address is not null").select("_component", "_own")
    decided = (own if ends is None else own.unionAll(ends)).groupBy(F.col("_component").alias("_c")).agg(F.min("_own").alias("_got"))  # allow < block: an allow takes precedence
    decided = saved(decided)
    if hops:
        forget(edges)
    kept = ["_id", "_url", "_host", "_path", "_rule", "_own"]
    found = component.where("_address is not null").join(decided, F.col("_component") == F.col("_c"), "left").select(*kept, "_component", "_got")
    nowhere = plain.where("_address is null").select(*kept, F.lit(None).cast("long").alias("_component"), F.lit(None).cast("string").alias("_got"))
    return found.unionAll(nowhere).select(
        F.col("_id").alias(id_col), F.col("_url").alias("url"), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_component").alias("component"),
        F.coalesce("_own", "_got", F.lit(default)).alias("verdict"),
    )
