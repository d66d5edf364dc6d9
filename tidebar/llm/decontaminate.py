"""Benchmark passages in documents, up to a share of edits: pieces, exact hits, Myers distance.

A test item of n characters may differ in k = n * `RATIO` of them. Cut into k + m pieces, m
pieces at least stand unchanged in any such copy, and the starts that they imply lie within k
of each other. All pieces are found in one pass over a text, and a stretch that m pieces imply
together is verified by bit-parallel edit distance. Items and texts are compared as lower-case
words with single spaces.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebar.llm.frames import map_batches, place

RATIO = 0.1
#: Characters of test items that tasks hold at once; larger benchmarks go in several passes.
BLOCK_CHARS = 4_000_000

_WORD = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    """Lower-case words, each between spaces; a text without words is empty."""
    words = _WORD.findall((text or "").lower())
    return f" {' '.join(words)} " if words else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(place, text) of errors + 1 pieces whose lengths differ by one at most."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(masks: dict[str, int], length: int, text: str, most: int) -> tuple[int, int] | None:
    """(least distance, its first end) of a pattern within `text`, None if over `most`.

    masks: for each character the bits of its places in the pattern.
    """
    top = 1 << (length - 1)
    every = (1 << length) - 1
    up, down, score = every, 0, length
    best = None
    for end, char in enumerate(text, 1):
        equal = masks.get(char, 0)
        low = equal | down
        same = (((equal & up) + up) ^ up) | equal
        plus = down | (every & ~(same | up))
        minus = up & same
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & every, (minus << 1) & every
        up, down = minus | (every & ~(low | plus)), plus & low
        if score <= most and (best is None or score < best[0]):
            best = score, end
    return best


def intact(errors: int) -> int:
    """How many pieces must stand unchanged: two, unless an item is too short for more pieces."""
    return 1 if errors < 3 else 2


def agreeing(found: list[tuple[int, int]], most: int, need: int) -> list[int]:
    """The starts, in order, that `need` pieces imply within `most` of each other.

    found: (start, place of the piece in the item) of each hit.
    """
    found = sorted(found)
    if need == 1:
        return [start for start, _ in found]
    out = []
    count: dict[int, int] = defaultdict(int)
    first = done = 0
    for last, (start, place) in enumerate(found):
        count[place] += 1
        while found[first][0] < start - most:
            old = found[first][1]
            count[old] -= 1
            if not count[old]:
                del count[old]
            first += 1
        if len(count) >= need:
            out += [s for s, _ in found[max(first, done) : last + 1]]
            done = last + 1
    return out


class Items:
    """Test items ready for search. items: (id, normal text) pairs."""

    def __init__(self, items: list[tuple[int, str]], ratio: float) -> None:
        import ahocorasick

        same = defaultdict(list)
        for key, text in items:
            if text:
                same[text].append(key)
        self.texts = sorted(same)
        self.keys = [sorted(same[t]) for t in self.texts]
        self.errors = [int(len(t) * ratio) for t in self.texts]
        self.need = [intact(k) for k in self.errors]
        self.masks: list[dict[str, int]] = []
        where = defaultdict(list)
        for n, text in enumerate(self.texts):
            mask: dict[str, int] = defaultdict(int)
            for i, char in enumerate(text):
                mask[char] |= 1 << i
            self.masks.append(dict(mask))
            for place, piece in pieces(text, self.errors[n] + self.need[n] - 1):
                where[piece].append((n, place))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, least distance, end of its first place) of each item in a normal text."""
        if not text or not self.texts:
            return []
        starts = defaultdict(list)
        for end, (size, at) in self.automaton.iter(text):
            for n, place in at:
                starts[n].append((end + 1 - size - place, place))
        out = []
        for n, found in starts.items():
            if len(found) < self.need[n]:
                continue
            slack, length, best = self.errors[n], len(self.texts[n]), None
            spans: list[list[int]] = []
            for start in agreeing(found, slack, self.need[n]):
                a, b = max(0, start - slack), min(len(text), start + length + slack)
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
            for a, b in spans:
                got = myers(self.masks[n], length, text[a:b], slack)
                if got and (best is None or got[0] < best[0]):
                    best = got[0], a + got[1]
            if best:
                out += [(key, *best) for key in self.keys[n]]
        return sorted(out)


@lru_cache(maxsize=2)
def _prepared(items: tuple[tuple[int, str], ...], ratio: float) -> Items:
    return Items(list(items), ratio)


def _blocks(benchmark: DataFrame) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items' ids and normal texts, about BLOCK_CHARS at once, in a fixed order."""
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    for block in range(n):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == block).collect()
        yield tuple(sorted({(row.item_id, normal(row.text)) for row in own}))


def find_items(docs: DataFrame, benchmark: DataFrame, ratio: float = RATIO) -> DataFrame:
    """doc_id, item_id, distance, end: each test item that a document holds.

    One row per row of `docs` and item with an edit distance of at most `ratio` times the
    item's length to some stretch of the document, whole words with single spaces on either
    side. `distance` is the least, `end` where the first such stretch ends, both in
    characters of that form. Items without words, with a null id or text, and texts that are
    null or without words match nothing; items of equal words are each reported; other
    columns are ignored. Each item block is one pass over the documents, without a shuffle.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, item_id long, distance long, end long"
    found = spark.createDataFrame([], schema)
    for block in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = _prepared(block, ratio)
            for batch in batches:
                rows, hits = [], []
                for i, text in enumerate(batch.column(1)):
                    own = items.search(normal(text.as_py()))
                    rows += [i] * len(own)
                    hits += own
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(rows, pa.int32())),
                        *(pa.array([h[k] for h in hits], pa.int64()) for k in range(3)),
                    ],
                    names=["doc_id", "item_id", "distance", "end"],
                )

        found = found.unionByName(texts.mapInArrow(run, schema))
    return found


def without_items(docs: DataFrame, benchmark: DataFrame, ratio: float = RATIO) -> DataFrame:
    """The rows of `docs`, all columns, that hold no test item in the sense of `find_items`."""
    at = place(docs, "text")
    for block in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = _prepared(block, ratio)
            for batch in batches:
                texts = batch.column(at)
                clean = [not items.search(normal(t.as_py())) for t in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = map_batches(docs, run)
    return docs
