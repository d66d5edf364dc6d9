"""Ranked search against every pair of document and item scored in plain Python."""

import math
import random
import re
from collections import Counter

from tidebar.llm import lexical
from tidebar.llm.lexical import pieces_of, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, item_id string, rank int, term string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def expected(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    full = [sum(b.values()) for _, b in bags if b]
    n_docs, length = len(full), sum(full)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in {(i, t) for i, t in items if i is not None}:
        wanted.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, bag in wanted.items():
        scored = []
        for doc, own in bags:
            m = 25 + 75 * sum(own.values()) * n_docs // max(length, 1)
            score = 0
            for t, times in bag.items():
                if tf := own[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def check(spark, docs, items, k=10, **limits):
    left = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], SCHEMA).repartition(5)
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS doc_id", "1 AS rank")
    got = ranked(left, right, k, **limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == expected(docs, items, k)


def fixture():
    rng = random.Random(4)
    words = [f"W{i}" for i in range(40)] + ["É", "é", "ñandú", "x9", "人"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", "-", "\n", "\x00", " ", "_"]) for _ in range(n))

    docs = [(i, text(rng.randrange(1, 120))) for i in range(400)]
    docs += [(7, docs[7][1]), (None, text(30)), (900, None), (901, ""), (902, "-- !"), (903, "rare " * 5000)]
    docs += [(1000 + i, "twin words") for i in range(30)]
    items = [(i, text(rng.randrange(1, 25))) for i in range(25)]
    items += [(25, "Twin"), (26, None), (27, "absent"), (28, "w1 w1 w1 W2"), (28, "w3"), (1, items[1][1]), (None, "w1")]
    return docs, items


def test_fixture_with_edges(spark):
    check(spark, *fixture())


def test_many_blocks_of_items(spark):
    check(spark, *fixture(), block=4000, long=1000)


def test_items_too_large_for_an_index(spark):
    check(spark, *fixture(), block=4000, long=150)


def test_few_entries_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 50)
    check(spark, *fixture(), k=3)


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "WINDOW", 7)
    text = "ab abcdefghijklmnop ñññññññ q  " * 3 + "Zz"
    assert [t.decode() for some in pieces_of(text) for t in some] == terms(text)
    assert list(pieces_of("")) == []


def test_empty_tables(spark):
    docs, items = fixture()
    check(spark, [], items)
    check(spark, docs[:3], [])
