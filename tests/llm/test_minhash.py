"""Near duplicates against all pairs compared in plain Python."""

import random

from pyspark.sql import functions as F

from tidebar.llm.graph import connected_components
from tidebar.llm.minhash import _paired, near_duplicates
from tidebar.session import materialize, scratch_dir

SCHEMA = "doc_id long, text string, grp string, node long, members long"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in root}


def check(spark, rows, percent=85):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    got = near_duplicates(df, percent).collect()
    want = components(rows, percent)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id), r
        assert r.kept == (r.doc_id == r.component_id)
    assert sorted((r.n_shingles for r in got)) == sorted(len(shingles(t)) for _, t in rows)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_fixture_with_edges(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.randrange(3, 200))] for _ in range(30)]
    rows, k = [(None, "a b c d e f"), (7_000, None), (7_001, ""), (7_002, " \n\t")], 0
    for words in base:
        for n in (0, 0, 1, 1, 2, 3, 5):
            rows.append((k, edited(rng, words, n)))
            k += 1
    rows += [(k, "One two"), (k + 1, "one\u000btwo"), (k + 2, "two one"), (k + 3, "é È"), (k + 4, "é è")]
    rows += [(0, rows[4][1]), (3, edited(rng, base[-1], 0)), (k + 9, "x" * 3_000_000)]
    check(spark, rows)
    check(spark, rows, 80)


def test_large_group_of_near_copies(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    check(spark, [(i, edited(rng, words, rng.randrange(8))) for i in range(700)])


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges.union(edges).union(spark.sql("select 9L, null")))
    assert got.select("root").distinct().collect() == [(0,)]
    assert got.count() == 201


def test_rows_of_blocks_do_not_pass_the_driver(spark, capsys):
    """2,000 unlinked classes of a group have 64,000 rows in blocks, but some kilobytes of members."""
    n = 2_000
    sets = spark.range(n).selectExpr(
        "id node", "0L grp", f"{n}L members", "sequence(id, id + 199) shingles", "array(id) signs"
    )
    sets = materialize(sets, scratch_dir(spark, "sets"))
    members = sets.select("node", "grp", "members", F.col("node").alias("comp"))
    members = materialize(members.coalesce(1), scratch_dir(spark, "members"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        paired = _paired(members, sets)
        sides = paired.groupBy("left").count().collect()
        capsys.readouterr()
        paired.explain()
    finally:
        spark.conf.set(name, before)
    assert {r.left: r["count"] for r in sides} == {True: 16 * (n - 1), False: 16 * n}
    joins = [x for x in capsys.readouterr().out.splitlines() if "Join [node#" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
