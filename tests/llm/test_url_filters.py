"""URL filters against plain Python: rules one by one, components by union of sets."""

import random
import re

from pyspark.sql import functions as F

from tidebar.llm.url_filters import judge, links_of, normal_url

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"), ("Evil.org", "", "block"), ("a.evil.org", "/x", "allow"),
    ("evil.org", "/a.evil", "allow"), ("tie.org", "/ab", "block"), ("b.tie.org", "/", "allow"),
    ("twice.org", "/", "allow"), ("twice.org", "/", "block"),
]
ODD = [(None, "/", "block"), ("x.org", None, "block"), ("y.org", "/", None)]
SCHEMA = "page_id long, url string, html string, host string, rule int, node string, row int"


def lower(text):
    return re.sub("[A-Z]", lambda c: c[0].lower(), text)


def parsed(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (lower(found[1]), found[2]) if found else ("", "")


def ruled(url):
    host, path = parsed(url)
    fits = [
        (-len(d + p), v, lower(d) + p)
        for d, p, v in RULES
        if (host == lower(d) or host.endswith("." + lower(d))) and path.startswith(p)
    ]
    return min(fits)[1:] if fits else (None, None)


def normal(url):
    if "://" not in (url or ""):
        return None
    host, path = parsed(url)
    asked = re.match(r"(?s)[^?#]*\?([^#]*)", url)
    kept = [p for p in (asked[1].split("&") if asked else []) if p and not re.match(r"(?i)(utm_[a-z]+|ref)(=|$)", p)]
    return host + (path or "/") + ("?" + "&".join(kept) if kept else "")


def expected(pages, links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    said = {}
    pairs = [(normal(a), normal(b), a, b) for a, b in links if normal(a) and normal(b)]
    for a, b, _, _ in pairs:
        root[max(top(a), top(b))] = min(top(a), top(b))
    for a, b, x, y in pairs:
        for end, url in ((a, x), (b, y)):
            said.setdefault(top(end), set()).add(ruled(url)[0])
    out = []
    for i, url in pages:
        verdict, rule = ruled(url)
        passed = "block" if normal(url) in root and {"block", "allow"} & said[top(normal(url))] == {"block"} else "allow"
        out.append((i, *parsed(url), rule, verdict or passed))
    return sorted(out, key=repr)


def check(spark, pages, links, html=None):
    rows = [(i, u, (html or {}).get(i), "h", 1, "n", 2) for i, u in pages]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    rules = spark.createDataFrame(RULES + ODD, "host string, path string, verdict string")
    known = spark.createDataFrame(links, "source string, target string") if links else None
    got = judge(df, rules, known)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    return rows, expected(pages, links or [])


def addresses(n):
    rng = random.Random(8)
    hosts = ["example.com", "www.example.com", "Example.COM", "m.x.net", "net", "a.evil.org", "evil.org", "good.org",
             "b.tie.org", "tie.org", "xtie.org", "notcom", "twice.org", "other.org", "third.org"]
    paths = ["", "/", "/en/", "/en/1", "/en", "/es/2", "/fr/", "/x/y", "/a.evil", "/ab", "/EN/1"]
    tails = ["", "#top", "?page=2&ref=x", "?utm_source=feed", "?a=b#c?d", "?&"]
    return [
        rng.choice(["http://", "https://"]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(tails) for _ in range(n)
    ]


def test_rules_and_links(spark):
    urls = addresses(300)
    rng = random.Random(9)
    links = [(rng.choice(urls), rng.choice(urls)) for _ in range(40)] + [(None, urls[0]), ("nothing", urls[1])]
    links += [("http://lost.org/1", "http://q.net/es/1"), ("http://lost.org/1", "https://lost.org/2#x")]
    pages = list(enumerate(urls)) + [(5, urls[5]), (400, None), (401, ""), (402, "no scheme"), (None, urls[1])]
    pages += [(403, "://"), (404, "http://x." + "a." * 5000 + "com/"), (405, "http://lost.org/2?ref=x"), (406, "a://b://c")]
    got, want = check(spark, pages, links)
    assert got == want
    assert ("lost.org", "/2", None, "block") in [r[1:] for r in got]
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_no_links_and_empty_tables(spark):
    pages = list(enumerate(addresses(50)))
    assert len(set(check(spark, pages, None)[0])) == 50
    got, want = check(spark, pages, None)
    assert got == want
    assert check(spark, [], None) == ([], [])
    none = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'' AS html")
    assert {r.verdict for r in judge(df, none).collect()} == {"allow"}


def test_links_of_pages(spark):
    pages = [(1, "http://one.org/a"), (2, "http://two.org/b"), (3, "http://m.x.net/es/1"), (4, "https://four.org/d/e")]
    html = {
        1: "<html><head><!-- <link rel=canonical href='http://good.com/'> --><LINK Rel='Canonical x' href=' //two.org/b?a=1&amp;utm_source=2 '>",
        2: "<script>'<link rel=canonical href=http://good.com/>'</script><meta http-equiv='Refresh' content=\"0; URL='/b?a=1'\">",
        3: "<link href=http://two.org/b rel=canonical>",
        4: "<base href='https://four.org/x/'><link rel=canonical href=e>",
    }
    links = [(u, t) for i, u in pages for t in links_of(u, html[i])]
    assert links == [
        ("http://one.org/a", "http://two.org/b?a=1&utm_source=2"), ("http://two.org/b", "http://two.org/b?a=1"),
        ("http://m.x.net/es/1", "http://two.org/b"), ("https://four.org/d/e", "https://four.org/x/e"),
    ]
    got, _ = check(spark, pages, None, html)
    assert [r[4] for r in got] == ["block", "block", "block", "allow"]


def test_links_of_odd_pages_take_little_time():
    for piece in ("<link ", "<meta a='", "<!--", "<script>", "<link rel=canonical href=", "a=", "<base href=http://["):
        assert len(list(links_of("http://x.org/", piece * 100_000))) >= 0


def test_normal_url(spark):
    urls = [(u,) for u in [*addresses(200), None, "x", "http://A.B?utm_a=1&x&ref", "http://a/?REF=1&preference=2"]]
    rows = spark.createDataFrame(urls, "url string").select("url", normal_url(F.col("url")).alias("n")).collect()
    assert all(r.n == normal(r.url) for r in rows)
