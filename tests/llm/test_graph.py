"""Components against a plain union of sets."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidebar.llm import graph
from tidebar.llm.graph import SALTS, _forests, _state, _with_least, connected_components


def test_random_edges(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)]
    root = list(range(300))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    want = {x: top(x) for a, b in edges if a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want


def test_star_whose_center_is_the_largest_node(spark):
    n = 100_000
    edges = spark.range(n).select(F.lit(n).cast("long").alias("a"), F.col("id").alias("b"))
    got = connected_components(edges)
    assert got.select("root").distinct().collect() == [(0,)]
    assert got.count() == n + 1


def test_neighbours_of_a_node_are_dealt_to_parts(spark):
    pairs = spark.range(10_000).select(F.lit(1).cast("long").alias("u"), F.col("id").alias("v"))
    spread = _with_least(pairs)
    assert spread.agg(F.min("m"), F.max("m"), F.count("*")).first() == (0, 0, 10_000)
    parts = pairs.groupBy(F.xxhash64("v").bitwiseAND(SALTS - 1)).count()
    assert parts.count() == SALTS
    assert parts.agg(F.max("count")).first()[0] < 2 * 10_000 / SALTS


def test_no_broadcast_of_parts_is_left_in_executors(spark, capsys):
    pairs = spark.range(1_000).select((F.col("id") % 7).alias("u"), F.col("id").alias("v"))
    spread = _with_least(pairs)
    assert spread.where("m <> u").count() == 0
    spread.explain()
    joins = [x for x in capsys.readouterr().out.splitlines() if "Join [u#" in x and ", part#" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)


def test_text_nodes_and_no_edges(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "d"), (None, "x")], "a string, b string")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "a"}
    assert connected_components(edges.limit(0)).collect() == []


def plain(edges):
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {x: top(x) for x in root}


@pytest.mark.parametrize("text", [False, True])
def test_a_task_joins_its_edges(monkeypatch, text):
    rng = random.Random(2)
    edges = [tuple(sorted(rng.sample(range(400), 2), reverse=True)) for _ in range(300)]
    if text:
        edges = [tuple(sorted((f"é{a}", f"é{b}"), reverse=True)) for a, b in edges]
    batches = [pa.record_batch(dict(zip("uv", map(list, zip(*edges[i : i + 7])), strict=True))) for i in range(0, 300, 7)]
    got = [r for b in _forests(iter(batches)) for r in b.to_pylist()]
    want = plain(edges)
    assert {r["u"]: r["v"] for r in got} == {x: y for x, y in want.items() if x != y}
    assert len({r["u"] for r in got}) == len(got)
    monkeypatch.setattr(graph, "AT_ONCE", 50)
    parts = [(r["u"], r["v"]) for b in _forests(iter(batches)) for r in b.to_pylist()]
    assert len(parts) > len(got) and plain(parts) == want


def test_edges_that_meet_in_a_task_need_no_round(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "_with_least", lambda x: rounds.append(1) or _with_least(x))
    edges = spark.range(500).select(F.col("id").alias("a"), (F.col("id") * 7919 % 509).alias("b"))
    got = connected_components(edges)
    want = plain([(i, i * 7919 % 509) for i in range(500) if i != i * 7919 % 509])
    assert {r.node: r.root for r in got.collect()} == want
    assert not rounds


@pytest.mark.parametrize("at_once", [1 << 19, 60])
def test_edges_of_many_tasks(spark, monkeypatch, at_once):
    monkeypatch.setattr(graph, "AT_ONCE", at_once)
    rounds = []
    monkeypatch.setattr(graph, "_with_least", lambda x: rounds.append(1) or _with_least(x))
    rng = random.Random(3)
    edges = [(rng.randrange(500), rng.randrange(500)) for _ in range(450)]
    edges += [(i, i + 1) for i in range(1_000, 1_100)] + [(2_000, i) for i in range(1_900, 2_000)]
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.node: r.root for r in got} == plain([e for e in edges if e[0] != e[1]])
    assert len(got) == len({r.node for r in got})
    assert bool(rounds) == (at_once == 60)


@pytest.mark.parametrize(
    "edges, want",
    [
        ([(2, 1), (3, 1)], (True, False, 2)),
        ([(2, 1), (2, 1)], (True, True, 2)),
        ([(3, 1), (3, 2)], (False, True, 2)),
        ([(2, 1), (3, 2)], (False, False, 2)),
    ],
)
def test_state(spark, edges, want):
    assert _state(spark.createDataFrame(edges, "u long, v long")) == want
