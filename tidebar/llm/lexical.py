"""Ranked lexical search, reversed: documents stream through an inverted index of the items.

The few items are indexed instead of the many documents. One pass over the documents counts the
index's terms in each whole text and writes them as a small table, from which the statistics of
all documents follow. A second pass scores each document of that table against the items that
share a term with it, and keeps a bounded heap per item and task; the heaps are merged at the end.

An index holds a block of items of at most about `BLOCK` bytes, measured before anything is sent
to tasks; more items take more passes. Items too large for that go by shuffles (`_joined`).

With N documents that have a term, L terms in them and n in one, df documents with a term and tf
occurrences, all in 64-bit integers but the logarithm:

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))      m = 100 - B + (B n N) div L
    score = sum over the item's terms of w ((10^9 tf) div (1000 tf + 8 m))
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.session import drop_path, materialize, scratch_dir

#: Bytes of an index, about, and those beyond which an item is not indexed but joined.
BLOCK, LONG = 32 << 20, 8 << 20
#: Bytes that an entry of the index counts besides its term's.
ENTRY = 100
#: Bytes of a text that are cut into terms together; entries of the index that are met together.
WINDOW, CELLS = 1 << 20, 1 << 20
B = 75

#: What a term consists of: digits, Latin letters and all beyond ASCII.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(
    c if c >= 0x80 or chr(c).isalnum() and not chr(c).isupper() else ord(chr(c).lower()) if chr(c).isupper() else 32
    for c in range(256)
)


def _terms(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(low, F.lit(_TERM), F.lit(0))


def pieces_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time, in UTF-8."""
    rest = text.encode().translate(_FOLD)
    at = 0
    while at < len(rest):
        end = at + WINDOW
        if end < len(rest):
            cut = rest.rfind(b" ", at, end)
            end = cut if cut > at else rest.find(b" ", end)
            end = len(rest) if end < 0 else end
        yield rest[at:end].split()
        at = end


def _entries(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of distinct items; a term's bytes count in `size`."""
    texts = items.where("item_id is not null").select("item_id", "text").distinct()
    terms = texts.select("item_id", F.explode(_terms(F.col("text"))).alias("term"))
    entries = terms.groupBy("item_id", "term").agg(F.count("*").alias("times"))
    return entries.withColumn("size", F.octet_length("term") + F.lit(ENTRY))


def _counted(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms of each row counted, those of the index by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            sizes, ends, found, times = [], [0], [], []
            for text in batch.column(1):
                n, counts = 0, Counter()
                for some in pieces_of(text.as_py() or ""):
                    n += len(some)
                    counts.update(map(number.get, some))
                counts.pop(None, None)
                sizes.append(n)
                found += counts.keys()
                times += counts.values()
                ends.append(len(found))
            ends = pa.array(ends, pa.int32())
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(times, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _weight(n_docs: int) -> Column:
    return F.floor(1000 * F.ln((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1)))


def best_of(item: np.ndarray, score: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best of each item: higher scores first, then smaller documents."""
    order = np.lexsort((doc, -score, item))
    own = item[order]
    first = np.searchsorted(own, own, side="left")
    return order[np.arange(len(own)) - first < k]


def _sums(row, item, value, n_rows: int, n_items: int):
    """(row, item, sum) of each pair that occurs, in no order."""
    if n_rows * n_items <= 4 * len(row):
        cells = np.zeros((n_rows, n_items), np.int64)
        np.add.at(cells, (row, item), value)
        row, item = np.nonzero(cells)
        return row, item, cells[row, item]
    keys, place = np.unique(row * n_items + item, return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, place, value)
    return keys // n_items, keys % n_items, sums


def _heaps(n_items: int, starts, owners, times, weights, n_docs: int, length: int, k: int):
    """Scores a task's documents against the index and yields its heaps at the end."""
    every = np.diff(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, score, doc = (np.empty(0, np.int64) for _ in range(3))
        floor = np.ones(n_items, np.int64)
        for batch in batches:
            ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            terms = batch.column(2).flatten().to_numpy().astype(np.int64)
            tfs = batch.column(3).flatten().to_numpy()
            ends = batch.column(2).offsets.to_numpy()
            ends = ends - ends[0]
            load = np.concatenate(([0], np.cumsum(every[terms])))[ends]
            m = 100 - B + (B * n * n_docs) // length
            first = 0
            while first < len(ids):
                last = int(np.searchsorted(load, load[first] + CELLS, side="right")) - 1
                last = min(max(last, first + 1), len(ids))
                term, tf = (x[ends[first] : ends[last]] for x in (terms, tfs))
                row = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[first + row]))
                # each term stands once for every entry that it has in the index
                each = every[term]
                place = np.arange(each.sum()) + np.repeat(starts[term] - np.cumsum(each) + each, each)
                r, i, s = _sums(
                    np.repeat(row, each), owners[place], np.repeat(value, each) * times[place], last - first, n_items
                )
                good = s >= floor[i]
                if good.any():
                    item = np.concatenate((item, i[good]))
                    score = np.concatenate((score, s[good]))
                    doc = np.concatenate((doc, ids[first + r[good]]))
                    keep = best_of(item, score, doc, k)
                    item, score, doc = item[keep], score[keep], doc[keep]
                    full = np.flatnonzero(np.bincount(item, minlength=n_items) == k)
                    floor[full] = score[np.searchsorted(item, full, side="right") - 1]
                first = last
        yield pa.record_batch(
            [pa.array(item, pa.int32()), pa.array(doc), pa.array(score)], names=["item", "doc_id", "score"]
        )

    return run


def _indexed(docs: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(item_id, doc_id, score) of the k best of each item of a block, whose size is bounded."""
    spark = docs.sparkSession
    rows = entries.select("item_id", "term", "times").toArrow()
    terms = np.array([t.encode() for t in rows.column("term").to_pylist()], object)
    names, number = np.unique(terms, return_inverse=True)
    ids, owner = np.unique(np.asarray(rows.column("item_id").to_pylist(), object), return_inverse=True)
    order = np.lexsort((owner, number))
    starts = np.searchsorted(number[order], np.arange(len(names) + 1))
    owners, times = owner[order], rows.column("times").to_numpy()[order]

    path = scratch_dir(spark, "counts")
    shared = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})
    counted = materialize(_counted(docs, shared), path)
    shared.destroy()
    n_docs, length = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = np.zeros(len(names), np.int64)
    weighed = frequency.select("term", _weight(n_docs).alias("w")).toArrow()
    weights[weighed.column("term").to_numpy()] = weighed.column("w").to_numpy()
    run = _heaps(len(ids), starts, owners, times, weights, n_docs, max(length, 1), k)
    found = counted.where("doc_id is not null").mapInArrow(run, "item int, doc_id long, score long")
    found = materialize(_merged(found, "item", k), scratch_dir(spark, "heaps"))
    drop_path(spark, path)
    kind = dict(entries.dtypes)["item_id"]
    named = spark.createDataFrame([(i, x) for i, x in enumerate(ids.tolist())], f"item int, item_id {kind}")
    return found.join(named, "item").select("item_id", "doc_id", "score")


def _joined(docs: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """The same for items of any size, by joins on the term and a sum per item and document."""
    spark = docs.sparkSession
    row = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        _terms(F.col("text")).alias("all"),
    )
    row = materialize(row, scratch_dir(spark, "terms"))
    n_docs, length = row.where("size(all) > 0").agg(F.count("*"), F.sum(F.size("all"))).first()
    wanted = materialize(entries.select("item_id", "term", "times"), scratch_dir(spark, "entries"))
    terms = row.select("row", "doc_id", F.size("all").cast("long").alias("n"), F.explode("all").alias("term"))
    counts = terms.groupBy("row", "doc_id", "n", "term").agg(F.count("*").alias("tf"))
    counts = counts.join(wanted.select("term").distinct(), "term", "left_semi")
    counts = materialize(counts, scratch_dir(spark, "counts"))
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    weighed = wanted.join(df, "term").withColumn("w", _weight(n_docs))
    weighed = materialize(weighed.select("item_id", "term", "times", "w"), scratch_dir(spark, "weights"))
    value = F.expr(
        f"times * w * ((1000000000 * tf) div (1000 * tf + 8 * ({100 - B} + ({B} * n * {n_docs}) div {max(length or 0, 1)})))"
    )
    known = counts.where("doc_id is not null").join(weighed, "term")
    score = known.groupBy("item_id", "row", "doc_id").agg(F.sum(value).alias("score"))
    return _merged(score.where("score > 0"), "item_id", k).select("item_id", "doc_id", "score")


def _merged(found: DataFrame, item: str, k: int) -> DataFrame:
    order = Window.partitionBy(item).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK, long: int = LONG) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0.

    Terms are runs of digits, Latin letters and all characters beyond ASCII, of whole texts, A-Z as
    a-z. Equal scores go to the smaller doc_id. Items without terms, or whose terms no document
    has, give no rows. Rows of `docs` that share an id are documents of their own, those with a
    null id only count in the statistics, and a null text has no terms. Of `items`, equal rows
    count once, several texts of one id make one item with the terms of all, and null ids take
    no part. Other columns are ignored; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    entries = materialize(_entries(items), scratch_dir(spark, "items"))
    sizes = entries.groupBy("item_id").agg(F.sum("size").alias("bytes"))
    sizes = materialize(sizes, scratch_dir(spark, "sizes"))
    small = sizes.where(F.col("bytes") <= long)
    total = small.agg(F.sum("bytes")).first()[0] or 0
    parts = -(-total // block)
    number = F.pmod(F.xxhash64(F.col("item_id").cast("string"), F.lit(5)), F.lit(max(parts, 1)))
    found = []
    if parts:
        placed = entries.join(small, "item_id").withColumn("part", number)
        placed = materialize(placed.select("item_id", "term", "times", "size", "part"), scratch_dir(spark, "blocks"))
        for part in range(parts):
            own = placed.where(F.col("part") == part)
            most = own.agg(F.sum("size")).first()[0]
            if most and most <= 2 * block + long:
                found.append(_indexed(docs, own, k))
            elif most:
                found.append(_joined(docs, own, k))
    large = entries.join(sizes.where(F.col("bytes") > long), "item_id", "left_semi")
    if not large.isEmpty():
        found.append(_joined(docs, large, k))
    if not found:
        kind = dict(items.dtypes)["item_id"]
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return _merged(out, "item_id", k).select("item_id", "rank", "doc_id", "score")
