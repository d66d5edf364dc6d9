"""URL filters: rules by host and path, and decisions that follow redirects.

A rule fits its host, all subdomains and every path that begins with its own; the longest fitting
rule decides. Addresses that redirect to one another or name each other as canonical are one
resource: their connected components carry a block from any address to its aliases that no rule
decides. An explicit allow has precedence: an address that a rule allows stays allowed, and
a component that holds one passes no block on.

Addresses are compared in a normal form without fragment and tracking parameters, as 128-bit digests,
so that searching components moves no texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebar.llm.graph import connected_components
from tidebar.session import materialize, scratch_dir

ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that only say where a visitor came from.
_TRACKING = "utm_[a-z]+|ref|fbclid|gclid|mc_cid|mc_eid"

#: A page that may name another address; tags with a `<` inside are not read as one.
_LINKED = r"(?i)<(link|meta)\b[^<>]*(canonical|refresh)"
_TAG = re.compile(r"<(?:(link|meta|base|script|style|textarea)\b([^<>]*)|!--)", re.I)
_ATTRIBUTE = re.compile(r"([a-z-]{1,20})\s{0,9}=\s{0,9}(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_REFRESH = re.compile(r"\s*[\d.]*\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"'\s]+)", re.I)
_ENDS = {n: re.compile(f"</{n}", re.I) for n in ("script", "style", "textarea")} | {"": re.compile("-->")}


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What follows the first `://` up to a `/`, `?`, `#` or the end, A-Z as a-z; else empty."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to a `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def normal_url(url: Column) -> Column:
    """An address without scheme, fragment and tracking parameters, its host in lower case.

    The scheme counts as https, an empty path as `/`. Null without `://`.
    """
    asked = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(f"(?i)^({_TRACKING})(=|$)"))
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    return F.when(
        F.instr(url, "://") > 0,
        F.concat(host_of(url), path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")),
    )


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, rule, verdict): the longest rule that fits the host and path of each `row` of `urls`.

    Rows that no rule fits are left out. Of equally long rules an allow comes first, then the
    smaller text. A rule is found by its domain and whole path: distinct hosts are joined to the
    path lengths that rules of theirs and their parent domains have, so no row or task holds
    the rules of a domain, and an address is tried once per domain and length.
    """
    known = rules.where("host is not null and path is not null and verdict is not null")
    known = known.select(lower_ascii(F.col("host")).alias("domain"), F.col("path").alias("start"), "verdict").distinct()
    deepest = known.agg(F.max(F.size(F.split("domain", r"\."))).alias("n")).first().n or 0
    labels = F.split("host", r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1)))),
        lambda n: F.array_join(F.slice(labels, -n, n), "."),
    )
    sizes = known.groupBy("domain").agg(F.collect_set(F.length("start")).alias("sizes"))
    hosts = urls.select("host").distinct().select("host", F.explode(names).alias("domain"))
    tries = hosts.join(sizes, "domain").groupBy("host")
    tries = tries.agg(F.collect_list(F.struct("domain", "sizes")).alias("tries"))
    # a table, so that the join can split the addresses of a host that very many have
    tries = materialize(tries, scratch_dir(urls.sparkSession, "hosts"))
    tried = F.expr(
        """flatten(transform(tries, t -> transform(filter(t.sizes, n -> n <= length(path)),
            n -> named_struct('domain', t.domain, 'start', left(path, n)))))"""
    )
    keys = urls.select("row", "host", "path").join(tries, "host").select("row", F.explode(tried).alias("try"))
    hits = keys.select("row", "try.*").join(known, ["domain", "start"])
    rule = F.concat("domain", "start")
    best = hits.groupBy("row").agg(F.min(F.struct((-F.length(rule)).alias("less"), "verdict", rule.alias("rule"))).alias("hit"))
    return best.select("row", "hit.rule", "hit.verdict")


def links_of(url: str, html: str) -> Iterator[str]:
    """Addresses that a page names as its canonical one or refreshes to, as absolute ones."""
    base, at = url, 0
    while found := _TAG.search(html, at):
        at, name = found.end(), (found[1] or "").lower()
        if name in _ENDS:
            end = _ENDS[name].search(html, at)
            if end is None:
                return
            at = end.end()
            continue
        values = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(found[2])}
        target = None
        if name == "base":
            base = _joined(url, values.get("href", "")) or url
        elif name == "link" and "canonical" in values.get("rel", "").lower().split():
            target = values.get("href")
        elif name == "meta" and values.get("http-equiv", "").lower() == "refresh":
            refresh = _REFRESH.match(values.get("content", ""))
            target = refresh and refresh[1]
        if target and (link := _joined(base, target)):
            yield link


def _joined(base: str, target: str) -> str | None:
    try:
        link = urljoin(base, target.strip())
    except ValueError:
        return None
    return link if "://" in link else None


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target) of the canonical and refresh links of pages' html, read whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                (url, link)
                for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for link in links_of(url, html)
            ]
            columns = [pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)]
            yield pa.record_batch(columns, names=["source", "target"])

    named = pages.select(F.col("url").cast("string"), F.col("html").cast("string"))
    named = named.where(F.col("url").isNotNull() & F.col("html").rlike(_LINKED))
    return named.mapInArrow(run, "source string, target string")


def _node(url: Column) -> Column:
    return F.md5(normal_url(url).cast("binary"))


def _parsed(urls: DataFrame, path: str) -> DataFrame:
    """The rows of `urls` numbered as `row`, with host, path and node instead of the url; a table."""
    url = F.col("url")
    parts = [host_of(url).alias("host"), path_of(url).alias("path"), _node(url).alias("node")]
    rest = [c for c in urls.columns if c != "url"]
    return materialize(urls.select(F.monotonically_increasing_id().alias("row"), *rest, *parts), path)


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of `pages` (page_id, url, html).

    `rules` has host, path and verdict, `links` source and target, redirects known besides the
    canonical and refresh links of the pages themselves. The verdict is that of the longest
    fitting rule. Without one it is `block` if the address's component holds an address that
    a rule blocks and none that a rule allows, else `allow`; both may also be the ends of links only.
    A null url, or one without `://`, has an empty host and path, fits no rule and has no aliases. Null html has no links;
    rules and links with nulls are left out. Repeated rows are kept, other columns ignored;
    empty tables give an empty result or decide nothing.
    """
    spark = pages.sparkSession
    known = page_links(pages)
    if links is not None:
        known = known.unionByName(links.select("source", "target"))
    edges = known.where("source is not null and target is not null").select(
        _node(F.col("source")).alias("a"), _node(F.col("target")).alias("b"), "source", "target"
    )
    edges = materialize(edges.where("a <> b"), scratch_dir(spark, "links"))
    roots = materialize(connected_components(edges), scratch_dir(spark, "roots"))

    # only ends of links have aliases; what rules say of them, by component
    ends = edges.select(F.explode(F.array("source", "target")).alias("url")).distinct()
    ends = _parsed(ends, scratch_dir(spark, "ends"))
    said = ends.join(fitting_rules(ends, rules), "row").select("node", "verdict").distinct()
    by_root = said.join(roots, "node").groupBy("root").agg(
        F.bool_or(F.col("verdict") == BLOCK).alias("blocked"), F.bool_or(F.col("verdict") == ALLOW).alias("allowed")
    )
    blocked = materialize(by_root.where("blocked and not allowed"), scratch_dir(spark, "blocked"))
    aliases = roots.join(blocked, "root", "left_semi").select("node", F.lit(BLOCK).alias("passed"))
    aliases = materialize(aliases, scratch_dir(spark, "aliases"))

    bare = _parsed(pages.select("page_id", F.col("url").cast("string").alias("url")), scratch_dir(spark, "urls"))
    out = bare.join(fitting_rules(bare, rules), "row", "left").join(aliases, "node", "left")
    verdict = F.coalesce("verdict", "passed", F.lit(ALLOW)).alias("verdict")
    return out.select("page_id", "host", "path", "rule", verdict)
