"""Benchmark passages against the edit distance by its definition."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidebar.llm import decontaminate
from tidebar.llm.decontaminate import find_items, myers, normal, pieces, without_items


def sellers(pattern, text, most):
    """Least distance of the pattern to any stretch of text, and its first end."""
    row = list(range(len(pattern) + 1))
    best = None
    for end, char in enumerate(text, 1):
        last, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            last, row[i] = row[i], min(last + (p != char), row[i] + 1, row[i - 1] + 1)
        if row[-1] <= most and (best is None or row[-1] < best[0]):
            best = row[-1], end
    return best


@settings(max_examples=300, deadline=None)
@given(st.text("ab c", min_size=1, max_size=80), st.text("ab c", max_size=60), st.integers(0, 9))
def test_myers_is_the_definition(pattern, text, most):
    masks = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    got, want = myers(masks, len(pattern), text, most), sellers(pattern, text, most)
    assert got == want


def test_pieces_cover():
    for n in range(1, 40):
        cut = pieces("x" * n, int(n * 0.1))
        assert "".join(p for _, p in cut) == "x" * n and all(p for _, p in cut)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        i = rng.randrange(len(text))
        text[i : i + rng.randrange(2)] = rng.choice(["", "q", "zz"])
    return "".join(text)


@pytest.mark.parametrize("block", [4_000_000, 500])
def test_all_near_passages_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    rng = random.Random(7)
    words = [f"{rng.choice('abcdefg')}{rng.randrange(60)}" for _ in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(40)]
    items += [(90, None), (91, "!!"), (None, "a1 b2"), (92, items[0][1].upper()), (93, "ok")]
    docs = [(i, " ".join(rng.choices(words, k=120))) for i in range(30)]
    for n in range(60):
        text = rng.choice(items[:40])[1]
        own = edited(rng, text, rng.randrange(1 + len(text) // 8))
        docs.append((100 + n, " ".join(rng.choices(words, k=30)) + ",\n" + own + ". " + " ".join(rng.choices(words, k=30))))
    docs += [(None, items[3][1]), (500, None), (501, ""), (502, "OK"), (502, "OK"), (503, "oks")]
    want = []
    for key, text in docs:
        for item, passage in items:
            p, t = normal(passage), normal(text)
            if item is not None and p and t and (hit := sellers(p, t, int(len(p) * 0.1))):
                want.append((key, item, *hit))
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, `a.b` string").repartition(3)
    b = spark.createDataFrame(items, "item_id int, text string")
    assert sorted(map(tuple, find_items(d, b).collect()), key=repr) == sorted(want, key=repr)
    dirty = {w[0] for w in want}
    kept = without_items(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in dirty)
    assert find_items(d.limit(0), b).collect() == [] and find_items(d, b.limit(0)).collect() == []
    assert without_items(d, b.limit(0)).count() == len(docs)


def test_a_tenth_of_an_item_may_differ(spark):
    rng = random.Random(3)
    for size in (81, 233):
        item = "".join(rng.choice("abcdefgh") for _ in range(size - 2))
        most = size // 10
        docs = []
        for n in (most, most + 1):
            text = list(item)
            for i in range(n):
                text[1 + i * (size - 3) // n] = "z"
            docs.append((n, "before it " + "".join(text) + " after it"))
        d = spark.createDataFrame(docs, "doc_id int, text string")
        b = spark.createDataFrame([(1, item)], "item_id int, text string")
        assert [(r.doc_id, r.distance) for r in find_items(d, b).collect()] == [(most, most)]
        assert [r.doc_id for r in without_items(d, b).collect()] == [most + 1]
