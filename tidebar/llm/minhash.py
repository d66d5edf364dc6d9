"""Near duplicates by b-bit MinHash with banding; every link is confirmed on full sets.

Candidates share a band of `ROWS` of `BANDS * ROWS` minima. At a similarity of 0.85 a pair
misses every band with a chance of 2e-8, at 0.8 of 3e-6. Copies of one set are one class
from the start, so they meet nowhere. A band's bucket yields only a star from its smallest
member; components of these stars are the groups within which pairs are examined:

* a group of up to `BLOCK` classes in one task;
* of a larger one first the stars are confirmed. Classes outside the group's largest
  component so found then meet all others, in blocks of `BLOCK` by `BLOCK`. Pairs of one
  component are skipped, since they cannot change the result.

Within a task the four low bits kept of each minimum give an estimate, corrected for chance
agreement, that clears away pairs over `MARGIN` (6 standard deviations) below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebar.llm.graph import connected_components
from tidebar.llm.shingles import SLICE, constants, minima, mix, packed, sets_of, text_slices
from tidebar.session import materialize, scratch_dir

WIDTH = 5
BANDS, ROWS = 24, 4
BLOCK = 128
MARGIN = 0.25
_COLUMNS = 4096

_U = np.uint64


def _long_lists(rows: np.ndarray, empty: np.ndarray) -> pa.ListArray:
    """A list per row of a matrix; an empty list where `empty` says so."""
    width = rows.shape[1] if rows.size else 0
    ends = np.concatenate(([0], np.cumsum(np.where(empty, 0, width)))).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1).view(np.int64)))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold = constants(5, ROWS)
    for batch in batches:
        ids = batch.column(0)
        for row, buf, starts in text_slices(batch, "text"):
            sets = sets_of(buf, starts, WIDTH)
            size = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            none = size == 0
            digest = np.zeros((2, len(sets)), _U)
            keys = np.empty((0, BANDS), _U)
            if full:
                every = np.concatenate(full)
                at = np.cumsum([0, *(len(s) for s in full[:-1])])
                for i in (0, 1):
                    salted = mix(every ^ constants(6 + i, 1)[0])
                    digest[i, ~none] = mix(np.add.reduceat(salted, at) + size[~none].view(_U))
                mins = minima(full, BANDS * ROWS).reshape(BANDS, ROWS, len(full))
                number = np.arange(BANDS, dtype=_U)[:, None]
                keys = mix((mins * fold[None, :, None]).sum(1, dtype=_U) + number).T
                keys = np.ascontiguousarray(keys)
            yield pa.record_batch(
                [
                    ids.slice(row, len(sets)),
                    pa.array(size),
                    pa.array(digest[0].view(np.int64)),
                    pa.array(digest[1].view(np.int64)),
                    _long_lists(keys, none),
                ],
                names=["doc_id", "n_shingles", "h1", "h2", "bands"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, buf, starts in text_slices(batch, "text", SLICE // 2):
            sets = sets_of(buf, starts, WIDTH)
            keep = [i for i, s in enumerate(sets) if len(s)]
            if not keep:
                continue
            full = [sets[i] for i in keep]
            signs = packed(minima(full, BANDS * ROWS))
            ends = np.concatenate(([0], np.cumsum([len(s) for s in full]))).astype(np.int32)
            rest = batch.slice(row, len(sets)).take(pa.array(keep))
            yield pa.record_batch(
                [
                    *(rest.column(i) for i in range(3)),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(full).view(np.int64))),
                    _long_lists(signs, np.zeros(len(full), bool)),
                ],
                names=["node", "grp", "members", "shingles", "signs"],
            )


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures, all of `a` with all of `b`, without chance hits."""
    differ = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        x = a[:, i, None].view(_U) ^ b[None, :, i].view(_U)
        x = x | (x >> _U(1))
        x = (x | (x >> _U(2))) & _U(0x1111111111111111)
        differ += np.bitwise_count(x)
    chance = 1 / 16
    return (1 - differ / (16 * a.shape[1]) - chance) / (1 - chance)


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all `left` with all `right` sets, by matrix products."""
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, at, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen > 1
    rank = np.cumsum(shared) - 1
    keep = shared[at]
    who, at = who[keep], rank[at[keep]]
    order = np.argsort(at, kind="stable")
    who, at = who[order], at[order]
    out = np.zeros((len(left), len(right)))
    for low in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(at, (low, low + _COLUMNS))
        m = np.zeros((len(sets), _COLUMNS), np.float32)
        m[who[a:b], at[a:b] - low] = 1
        out += m[left] @ m[right].T
    return np.rint(out).astype(np.int64)


def _links(nodes, comps, sets, signs, left, right, percent) -> list[tuple[int, int]]:
    """Confirmed pairs of a left and a right row that join two components, enough of them."""
    size = np.array([len(s) for s in sets])
    near = estimate(signs[left], signs[right]) >= percent / 100 - MARGIN
    small = np.minimum(size[left][:, None], size[right][None, :])
    large = np.maximum(size[left][:, None], size[right][None, :])
    near &= (100 * small >= percent * large) & (comps[left][:, None] != comps[right][None, :])
    if not near.any():
        return []
    ll, rr = left[near.any(1)], right[near.any(0)]
    near = near[near.any(1)][:, near.any(0)]
    own = np.unique(np.concatenate((ll, rr)))
    common = _common([sets[i] for i in own], np.searchsorted(own, ll), np.searchsorted(own, rr))
    union = size[ll][:, None] + size[rr][None, :] - common
    parent: dict = {}

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(near & (100 * common >= percent * union)), strict=True):
        a, b = top(comps[ll[i]]), top(comps[rr[j]])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(nodes[ll[i]]), int(nodes[rr[j]])))
    return out


def _group(table: pa.Table, percent: int) -> pa.Table:
    """Links among the rows of a group or, where rows have sides, of one side with the other."""
    nodes = table.column("node").to_numpy()
    names = table.column_names
    comps = table.column("comp").to_numpy() if "comp" in names else nodes
    lists = table.column("shingles").combine_chunks()
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    sets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    signs = table.column("signs").combine_chunks().flatten().to_numpy().reshape(len(nodes), -1)
    rows = np.arange(len(nodes))
    left = right = rows
    if "left" in names:
        side = table.column("left").to_numpy(zero_copy_only=False).astype(bool)
        left, right = rows[side], rows[~side]
    found = []
    if len(left) and len(right):
        found = _links(nodes, comps, sets, signs, left, right, percent)
    return pa.table({k: pa.array([x[i] for x in found], pa.int64()) for i, k in enumerate("ab")})


def _paired(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of blocks (grp, i, j) in which classes outside a group's largest component meet all others."""
    sizes = members.groupBy("grp", "comp").agg(F.count("*").alias("n"))
    best = sizes.groupBy("grp").agg(
        F.max(F.struct("n", "comp"))["comp"].alias("main"),
        (F.sum("n") - F.max("n")).alias("others"),
    )
    placed = members.join(best.where("others > 0"), "grp").withColumns(
        {
            "n_all": F.ceil(F.col("members") / BLOCK),
            "n_left": F.ceil(F.col("others") / BLOCK),
            "all_block": F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)),
            "left_block": F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("others") / BLOCK)),
        }
    )
    left = placed.where("comp <> main").select(
        "node", "grp", "comp", F.lit(True).alias("left"), F.col("left_block").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("j"),
    )
    right = placed.select(
        "node", "grp", "comp", F.lit(False).alias("left"),
        F.explode(F.sequence(F.lit(0), F.col("n_left") - 1)).alias("i"),
        F.col("all_block").alias("j"),
    )
    # a node has a row per block it meets, which Spark does not foresee from the few bytes of `members`:
    # it would send all rows through the driver, and they grow with the square of a group
    pairs = left.unionByName(right).hint("merge")
    return pairs.join(sets.select("node", "shingles", "signs"), "node")


def _large_groups(sets: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within groups of over `BLOCK` classes."""
    spark = sets.sparkSession
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    close = 100 * common >= percent * (F.size("x") + F.size("y") - common)
    direct = stars.join(one, "a").join(two, "b").where(close).select("a", "b")
    direct = materialize(direct, scratch_dir(spark, "direct"))
    comps = connected_components(direct).withColumnRenamed("root", "comp")
    members = sets.select("node", "grp", "members").distinct().join(comps, "node", "left")
    members = members.withColumn("comp", F.coalesce("comp", "node"))
    members = materialize(members, scratch_dir(spark, "members"))
    blocks = _paired(members, sets)
    found = blocks.groupBy("grp", "i", "j").applyInArrow(
        lambda t: _group(t, percent), "a long, b long"
    )
    return direct.unionByName(found)


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Two documents are linked if `100 * |intersection| >= percent * |union|` of their shingle
    sets; `component_id` is the smallest doc_id reachable over links, and `kept` says that it
    is the document's own. A null text counts as empty; empty sets are linked with nothing.
    Rows that share a doc_id are one document with several texts. A null doc_id is linked
    with nothing, has a null component_id and is kept. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    signed = texts.mapInArrow(
        _signatures, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"
    )
    signed = materialize(signed, scratch_dir(spark, "signed"))
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    classes = materialize(classes, scratch_dir(spark, "classes"))
    banded = linked.join(classes, ["h1", "h2"]).where("doc_id = node")
    banded = banded.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    stars = banded.join(buckets.where("a < z"), "band").where("node > a")
    stars = stars.select("a", F.col("node").alias("b")).distinct()
    stars = materialize(stars, scratch_dir(spark, "stars"))

    groups = connected_components(stars).withColumnRenamed("root", "grp")
    members = groups.groupBy("grp").agg(F.count("*").alias("members"))
    groups = materialize(groups.join(members, "grp"), scratch_dir(spark, "groups"))
    found = texts.join(groups, F.col("doc_id") == F.col("node"))
    sets = found.select("node", "grp", "members", "text").mapInArrow(
        _full_sets,
        "node long, grp long, members long, shingles array<long>, signs array<long>",
    )
    sets = materialize(sets, scratch_dir(spark, "sets"))
    small = sets.where(F.col("members") <= BLOCK).select("node", "grp", "shingles", "signs")
    links = small.groupBy("grp").applyInArrow(lambda t: _group(t, percent), "a long, b long")
    large = F.col("members") > BLOCK
    if not groups.where(large).isEmpty():
        wide = groups.where(large).select(F.col("node").alias("b"))
        links = links.unionByName(
            _large_groups(sets.where(large), stars.join(wide, "b", "left_semi"), percent)
        )
    # a document with several texts joins their classes
    several = linked.join(classes, ["h1", "h2"]).where("doc_id > node").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b")
    )
    twice = linked.groupBy("doc_id").agg(F.min("h1").alias("p"), F.max("h1").alias("q"))
    twice = twice.where("p < q").select(F.col("doc_id").alias("b"))
    links = links.unionByName(several.join(twice, "b", "left_semi"))
    roots = connected_components(links)
    final = classes.join(roots, "node", "left").select(
        "h1", "h2", F.coalesce("root", "node").alias("component_id")
    )
    out = signed.join(final, ["h1", "h2"], "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(
            (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
        )
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
