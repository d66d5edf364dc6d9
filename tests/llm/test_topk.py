"""Exact top-k against all inner products."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidebar.llm import topk
from tidebar.llm.topk import Best, bound, cover_tree, flat_tree, quantized, top_k, tree_of
from tidebar.session import materialize

PAIR = "vec_id long, vector array<long>"


def brute(queries, cands, k):
    width = max([len(v) for _, v in [*queries, *cands] if v is not None], default=0)
    pad = lambda v: [*v, *[0] * (width - len(v))]
    out, cands = [], {(i, tuple(pad(v))) for i, v in cands if i is not None and v is not None}
    for q in {q for q, v in queries if q is not None and v is not None}:
        for v in {tuple(pad(v)) for i, v in queries if i == q and v is not None}:
            hits = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in cands if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def run(spark, queries, cands, k=5):
    extra = [(i, v, 1, "x") for i, v in cands]
    c = spark.createDataFrame(extra, PAIR + ", score long, key string").repartition(3)
    q = spark.createDataFrame([(i, v, 1) for i, v in queries], "query_id long, vector array<long>, rank int")
    return sorted(map(tuple, top_k(q, c, k).collect()))


@pytest.fixture
def small(monkeypatch):
    for name, value in {"BLOCK": 40, "QUERY_BLOCK": 16, "SLICE": 2, "SAMPLE": 30, "LEAF": 4}.items():
        monkeypatch.setattr(topk, name, value)


def test_ties_copies_and_nulls(spark, small):
    rng = random.Random(3)
    base = [[rng.randrange(-6, 7) for _ in range(6)] for _ in range(60)]
    cands = [(i, rng.choice(base)) for i in range(300)]
    cands += [(1000 + i, [1, 2, 3, 0, 0, 0]) for i in range(80)]
    cands += [(None, base[0]), (7777, None), cands[5], cands[5], (2000, [1, 2]), (2001, []), (2002, [10**9] * 6)]
    queries = [c for c in cands if c[0] is not None and c[0] % 7 == 0]
    assert run(spark, queries, cands) == brute(queries, cands, 5)


def test_clusters_are_pruned_and_exact(spark, small):
    rng = np.random.default_rng(4)
    centers = rng.integers(-300, 300, (8, 5))
    x = (centers[rng.integers(0, 8, 400)] + rng.integers(-2, 3, (400, 5))).tolist()
    cands = list(enumerate(x))
    assert run(spark, cands[::9], cands) == brute(cands[::9], cands, 5)


def test_few_candidates_and_empty_tables(spark):
    cands = [(1, [1, 2]), (2, [3, 4])]
    assert run(spark, [(1, [1, 2])], cands) == [(1, 1, 2, 11)]
    assert run(spark, [(1, [1, 2])], []) == []
    assert run(spark, [], cands) == []
    assert run(spark, [(1, [1, 2])], [(1, [9, 9])]) == []


def test_trees_cover_and_bound(monkeypatch):
    monkeypatch.setattr(topk, "LEAF", 3)
    x = np.random.default_rng(5).normal(size=(200, 4))
    order, root = cover_tree(x)
    y = x[order]
    assert sorted(order) == list(range(200))
    nodes = [root]
    for node in nodes:
        nodes += node.children
        assert (np.linalg.norm(y[node.first : node.last] - node.center, axis=1) <= node.radius + 1e-9).all()
        if node.children:
            assert sum(c.last - c.first for c in node.children) == node.last - node.first
    for a in nodes[::7]:
        for b in nodes[::5]:
            assert (y[a.first : a.last] @ y[b.first : b.last].T).max() <= bound(a, b)


def test_quantized(spark):
    rows = [([0.5, -0.01],), ([float("nan")],), ([float("inf")],), ([1.0, None],), (None,), ([],)]
    df = spark.createDataFrame(rows, "v array<double>")
    got = [r[0] for r in df.select(quantized(df.v)).collect()]
    assert got == [[32, -1], None, None, None, None, []]


def packed(name, x, ids, sample=None, k=5):
    columns = {"block": [name] * len(x), "key": [f"v{i}" for i in ids], "vector": x}
    columns["ids"] = [[i, i + 10_000] for i in ids]
    table = topk._packed(len(x[0]), sample, k)(pa.table(columns))
    return table.append_column("query", pa.array([sample is not None]))


@pytest.mark.parametrize("large", [5, 3_000, 2**30])
def test_a_search_builds_no_tree_and_meets_no_small_nodes(monkeypatch, large):
    rng = np.random.default_rng(6)
    x = rng.integers(-large, large, (400, 6)).tolist()
    x[7], x[8] = x[5], [0] * 6
    blocks = [packed("a", x[:250], range(250)), packed("b", x[250:], range(250, 400))]
    blocks.append(packed("q", x[:90], range(90), np.array(x[:30])))
    monkeypatch.setattr(topk, "cover_tree", None)
    bounds = []
    monkeypatch.setattr(topk, "bound", lambda a, b: bounds.append(1) or bound(a, b))
    found = topk._search(6, 5)(pa.concat_tables(blocks, promote_options="default")).to_pylist()
    got = {f"v{i}": [] for i in range(90)}
    for r in found:
        assert r["ids"] == [r["least"], r["least"] + 10_000]
        got[r["key"]].append((-r["score"], r["least"]))
    for i in range(90):
        every = sorted((-sum(a * b for a, b in zip(x[i], y, strict=True)), j) for j, y in enumerate(x))
        assert got[f"v{i}"] == every[:5]
    assert len(bounds) <= 60


def test_flat_trees_are_the_same_trees(monkeypatch):
    monkeypatch.setattr(topk, "LEAF", 3)
    x = np.random.default_rng(7).normal(size=(150, 4))
    x[20:60] = x[3]
    order, root = cover_tree(x)

    def parts(node):
        own = (node.center.tolist(), node.radius, node.first, node.last)
        return own, [parts(c) for c in node.children]

    assert parts(tree_of(flat_tree(root, order), x[order])) == parts(root)


def test_hits_that_wait_are_ranked_as_one_by_one():
    rng = np.random.default_rng(8)
    least = np.iinfo(np.int64).min
    best, every = Best(3, np.full(4, least)), [[] for _ in range(4)]
    for at in range(0, 60, 6):
        scores, ids = rng.integers(-4, 4, (2, 6)), rng.permutation(6) + 100 * at
        first = int(rng.integers(0, 3))
        best.add(first, scores.astype(rng.choice(["f4", "f8", "i8"])), ids, ids + 1)
        for q, row in enumerate(scores):
            every[first + q] += [(-int(s), int(i)) for s, i in zip(row, ids, strict=True)]
    query, score, ident, at = best.settle()
    got = [[(-int(s), int(i)) for q, s, i in zip(query, score, ident, strict=True) if q == n] for n in range(4)]
    best_3 = [sorted(e)[:3] for e in every]
    assert got == best_3
    assert (at == ident + 1).all()
    assert best.floor.tolist() == [-e[2][0] if len(e) == 3 else least for e in best_3]


def test_cells_are_split_without_dealing_vectors_out_by_cell(spark, small, monkeypatch):
    plans = []

    def kept(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, path)

    monkeypatch.setattr(topk, "materialize", kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(9)
        cands = [(i, [rng.randrange(-9, 10) for _ in range(3)]) for i in range(200)]
        assert run(spark, cands[::20], cands) == brute(cands[::20], cands, 5)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    blocks = [p for p in plans if "FlatMapGroupsInArrow" in p and "block" in p]
    assert blocks and not [p for p in blocks if "SortMergeJoin [cell" in p]


def test_blocks_ship_the_narrowest_integers():
    ends = [(0, 0, 1), (-128, 127, 1), (-129, 0, 2), (0, 128, 2), (0, 1 << 15, 4), (-(1 << 63), (1 << 63) - 1, 8)]
    for least, most, size in ends:
        x = np.array([[least, most, 1]])
        assert topk._narrow(x).itemsize == size and (topk._narrow(x) == x).all()
    (row,) = packed("a", [[-128, 127], [3, 4]], [1, 2]).to_pylist()
    assert len(row["data"]) == 4 and row["kind"] == "|i1"
