"""Hard negatives against every pair of rows scored in plain Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidebar.llm import hard_negatives as module
from tidebar.llm.hard_negatives import hard_negatives, slots_of

SCHEMA = "vec_id long, label string, vector array<long>, rank int, block string"

def expected(rows, positives, k, low, high):
    kept = {}
    for i, label, x in rows:
        if i is None or label is None or x is None or None in x:
            continue
        kept[i] = min(kept.get(i, (label, x)), (label, x))
    out = []
    for a, (label, x) in kept.items():
        if a % 5:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(x, y, strict=False)), i, own) for i, (own, y) in kept.items() if i != a
        )
        for s, i, _ in [r for r in scored if r[2] == label][:positives]:
            hits = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:k]
            out += [(a, i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(hits)]
    return sorted(out)


def check(spark, rows, positives=5, k=3, low=50, high=95):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = hard_negatives(df, F.col("vec_id") % 5 == 0, positives, k, low, high)
    assert got.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    want = expected(rows, positives, k, low, high)
    assert sorted(map(tuple, got.collect())) == want
    return want


def fixture(seed=3, n=300, labels="abcd", dims=4):
    rng = random.Random(seed)
    rows = [(i, rng.choice(labels), [rng.randrange(-9, 10) for _ in range(dims)]) for i in range(n)]
    rows += [(n, "a", [1, 2]), (n + 5, "only", [3, 3, 3, 3]), (None, "a", [1] * dims), (n + 1, None, [1] * dims)]
    rows += [(n + 2, "b", None), (n + 3, "b", [None, 1, 1, 1]), rows[0], (7, "zz", [9, 9, 9, 9]), (n + 10, "a", [])]
    return rows + [(n + 20 + i, "abcd"[i % 4], [5, 5, 5, 5]) for i in range(25)]


def test_fixture_with_edges(spark):
    assert len(check(spark, fixture())) > 200
    check(spark, fixture(), positives=2, k=1, low=80, high=99)


def test_many_tiles_and_strips(spark, monkeypatch):
    for name, size in (("BLOCK", 37), ("ANCHORS", 11), ("STRIP", 3)):
        monkeypatch.setattr(module, name, size)
    check(spark, fixture(seed=4))


def test_scores_beyond_doubles(spark):
    rng = random.Random(5)
    rows = [(i, "ab"[i % 2], [rng.randrange(10**7, 10**8) for _ in range(3)]) for i in range(60)]
    assert check(spark, rows)


def test_nothing_to_return(spark):
    check(spark, [])
    check(spark, [(1, "a", [1]), (2, "b", [1])])
    check(spark, [(5, "a", [1]), (10, "b", [1]), (15, "c", [2])])
    check(spark, [(5, "a", [1]), (6, "a", [-1]), (7, "b", [1])])


def test_slots_are_disjoint_and_ordered():
    scores = np.array([[12, 10, 9, 5, 4, 1]])
    assert slots_of(scores, np.array([[10, 5, 4]]), np.array([2])).tolist() == [[0, 1, 1, 2, 3, 0]]
