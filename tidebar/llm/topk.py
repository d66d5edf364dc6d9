"""Exact top-k by inner product: dual-tree search over cover trees of queries and candidates.

Distinct vectors go to the cell of their nearest landmark and, within it, to blocks of bounded
size; each block of queries and of candidates becomes a tree whose nodes know a center and a
covering radius. By Cauchy-Schwarz no pair of two nodes scores over

    center . center + r_q |center_c| + r_c |center_q| + r_q r_c

and a node pair whose bound is below the worst kth score of the query node's queries is
pruned: first pairs of whole blocks, before any vector is shipped, then pairs within blocks.
Pairs of leaves are scored by a matrix product. First kth scores come from a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.session import materialize, scratch_dir

#: Vectors of a candidate block and of a query block, about; blocks of candidates in a task.
BLOCK, QUERY_BLOCK, SLICE = 2048, 1024, 8
#: Vectors collected for landmarks and first scores, and landmarks, at most.
SAMPLE, LANDMARKS = 1024, 64
LEAF, FANOUT = 128, 16


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; null where one is null or not finite."""
    x = vector.cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~odd, F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v)))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of longs, shorter ones padded with zeros."""
    ends = np.asarray(lists.offsets)
    flat = np.asarray(lists.values)
    size = np.diff(ends)
    out = np.zeros((len(size), width), np.int64)
    if len(size) and (size == width).all():
        out[:] = flat[ends[0] : ends[-1]].reshape(len(size), width)
    else:
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            out[i, : b - a] = flat[a:b]
    return out


def _distances(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    d = x - center
    return np.sqrt(np.einsum("ij,ij->i", d, d))


@dataclass
class Node:
    """A stretch of the tree's rows within `radius` of `center`, which is row `row` of the vectors."""

    center: np.ndarray
    radius: float
    first: int
    last: int
    children: list[Node]
    row: int = 0

    @property
    def size(self) -> int:
        return self.last - self.first

    @cached_property
    def norm(self) -> float:
        return float(np.sqrt(self.center @ self.center))


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, Node]:
    """(order of the rows, root): children's centers lie more than half the radius apart."""

    def grow(rows: np.ndarray, row: int, first: int) -> tuple[np.ndarray, Node]:
        far = _distances(x[rows], x[row])
        radius = float(far.max(initial=0.0))
        node = Node(x[row], radius, first, first + len(rows), [], row)
        if len(rows) <= LEAF or radius == 0:
            return rows, node
        owner, near, centers = np.zeros(len(rows), int), far, [row]
        while near.max() > radius / 2 and len(centers) < FANOUT:
            centers.append(int(rows[near.argmax()]))
            own = _distances(x[rows], x[centers[-1]])
            owner[own < near] = len(centers) - 1
            near = np.minimum(near, own)
        ordered = []
        for i, c in enumerate(centers):
            part = rows[owner == i]
            if len(part):
                part, child = grow(part, c, first + sum(map(len, ordered)))
                ordered.append(part)
                node.children.append(child)
        return np.concatenate(ordered), node

    if not len(x):
        return np.arange(0), Node(np.zeros(x.shape[1]), 0.0, 0, 0, [])
    return grow(np.arange(len(x)), 0, 0)


def flat_tree(root: Node, order: np.ndarray) -> dict[str, list]:
    """The nodes as columns, each after its parent; centers by their places in the order of the rows."""
    places = np.empty(len(order), int)
    places[order] = np.arange(len(order))
    out: dict[str, list] = {"parent": [], "center": [], "first": [], "last": [], "radius": []}

    def add(node: Node, parent: int) -> None:
        own = len(out["parent"])
        values = (parent, int(places[node.row]), node.first, node.last, node.radius)
        for column, value in zip(out.values(), values, strict=True):
            column.append(value)
        for child in node.children:
            add(child, own)

    add(root, -1)
    return out


def tree_of(flat: dict[str, list], x: np.ndarray) -> Node:
    """The root of a tree that `flat_tree` gave, over the rows `x` in its order."""
    nodes: list[Node] = []
    for parent, center, first, last, radius in zip(*flat.values(), strict=True):
        nodes.append(Node(x[center], radius, first, last, [], center))
        if parent >= 0:
            nodes[parent].children.append(nodes[-1])
    return nodes[0]


def bound(a: Node, b: Node) -> float:
    """No vector of `a` scores more with one of `b`; slack for rounding."""
    top = a.center @ b.center + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
    return top + 1e-9 * (a.norm + a.radius + 1) * (b.norm + b.radius + 1)


class Best:
    """The k best (score, least id) candidates of each query so far.

    Hits at or above a query's floor wait until there are k per query on average, then all are
    ranked at once and the floors rise.
    """

    def __init__(self, k: int, floor: np.ndarray) -> None:
        self.k, self.floor, self.waiting = k, floor, 0
        #: query, score, id and place of each hit
        self.hits: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 4]

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        floor = self.floor[first : first + len(scores)].astype(scores.dtype)
        row, col = np.nonzero(scores >= floor[:, None])
        self.hits.append((first + row, scores[row, col].astype(np.int64), ids[col], at[col]))
        self.waiting += len(row)
        if self.waiting >= self.k * len(self.floor):
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Query, score, id and place of the best."""
        hits = [np.concatenate(x) for x in zip(*self.hits, strict=True)]
        order = np.lexsort((hits[2], -hits[1], hits[0]))
        hits = [x[order] for x in hits]
        rank = np.arange(len(order)) - np.searchsorted(hits[0], hits[0])
        query, score = (x[rank == self.k - 1] for x in hits[:2])
        self.floor[query] = np.maximum(self.floor[query], score)
        self.hits, self.waiting = [tuple(x[rank < self.k] for x in hits)], 0
        return self.hits[0]


def dual_tree(queries: np.ndarray, query_root: Node, cands: np.ndarray, root: Node, ids, at, best) -> None:
    """Meet every pair of nodes that may still matter, the most promising first.

    Pairs of nodes with LEAF * LEAF products or fewer are not divided: to score them costs less
    than to bound their children.
    """
    large = float(max(np.abs(queries).max(initial=0), np.abs(cands).max(initial=0)) + 1)
    # sums of products are whole in floats if none can pass 2^24 or 2^53
    most = large * large * queries.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    left, right = queries.astype(kind), cands.astype(kind)

    def visit(a: Node, b: Node) -> None:
        if a.first == a.last or b.first == b.last:
            return
        if bound(a, b) < best.floor[a.first : a.last].min():
            return
        if a.size * b.size <= LEAF * LEAF or not a.children and not b.children:
            score = left[a.first : a.last] @ right[b.first : b.last].T
            best.add(a.first, score, ids[b.first : b.last], at[b.first : b.last])
            return
        if a.children and (not b.children or a.radius > b.radius):
            pairs = [(x, b) for x in a.children]
        else:
            pairs = [(a, y) for y in b.children]
        for x, y in sorted(pairs, key=lambda p: -bound(*p)):
            visit(x, y)

    visit(query_root, root)


def _first_floor(x: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Lower bounds of each query's kth score, from a sample of distinct candidates."""
    if len(sample) < k:
        return np.full(len(x), np.iinfo(np.int64).min)
    large = float(np.abs(x).max(initial=0) + 1) * float(np.abs(sample).max(initial=0) + 1)
    if large * x.shape[1] < 2**53:
        score = np.rint(x.astype(float) @ sample.T.astype(float)).astype(np.int64)
    else:
        score = x @ sample.T
    return np.partition(score, -k, axis=1)[:, -k]


#: What `flat_tree` gives, in a block.
_TREE = pa.struct(
    [(name, pa.list_(pa.int32())) for name in ("parent", "center", "first", "last")]
    + [("radius", pa.list_(pa.float64()))]
)


def _list(values: pa.Array) -> pa.Array:
    """One list of all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the least integer type that holds them."""
    least, most = x.min(initial=0), x.max(initial=0)
    kind = next(k for k in ("i1", "i2", "i4", "i8") if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
    return x.astype(kind)


def _packed(width: int, sample: np.ndarray | None, k: int):
    """Packs the vectors of a block in the tree's order, with the tree; first floors if there is a sample."""

    def pack(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("vector").combine_chunks(), width)
        order, root = cover_tree(x.astype(float))
        x = x[order]
        data = _narrow(x)
        floor = np.empty(0, np.int64) if sample is None else _first_floor(x, sample, k)
        rows = table.take(pa.array(order))
        columns = {
            "block": table.column("block").slice(0, 1),
            "center": pa.array([root.center.tolist()], pa.list_(pa.float64())),
            "radius": pa.array([root.radius]),
            "floor": pa.array([int(floor.min()) if len(floor) else None], pa.int64()),
            "kind": pa.array([data.dtype.str]),
            "data": pa.array([data.tobytes()], pa.binary()),
            "floors": pa.array([floor.tobytes()], pa.binary()),
            "keys": _list(rows.column("key").combine_chunks()),
            "ids": _list(rows.column("ids").combine_chunks()),
            "tree": pa.array([flat_tree(root, order)], _TREE),
        }
        return pa.table(columns)

    return pack


_PACKED = (
    "block string, center array<double>, radius double, floor long, kind string, data binary, floors binary, "
    "keys array<string>, ids array<array<long>>, "
    "tree struct<parent array<int>, center array<int>, first array<int>, last array<int>, radius array<double>>"
)
_FOUND = "key string, score long, least long, ids array<long>"


def _search(width: int, k: int):
    """The k best candidates of each query of one block, among a task's candidate blocks."""

    def search(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_batches(max_chunksize=1), key=lambda r: r.column("block")[0].as_py())

        def block(row: pa.RecordBatch) -> tuple[np.ndarray, Node]:
            data = row.column("data")[0].as_buffer()
            x = np.frombuffer(data, row.column("kind")[0].as_py()).reshape(-1, width).astype(np.int64)
            return x, tree_of(row.column("tree")[0].as_py(), x.astype(float))

        blocks = [r for r in rows if not r.column("query")[0].as_py()]
        ids = pa.concat_arrays([r.column("ids")[0].values for r in blocks])
        least = np.asarray(pc.list_element(ids, 0))
        found = []
        for own in (r for r in rows if r.column("query")[0].as_py()):
            x, root = block(own)
            best = Best(k, np.frombuffer(own.column("floors")[0].as_buffer(), np.int64).copy())
            at = 0
            for y, top in map(block, blocks):
                places = np.arange(at, at + len(y))
                dual_tree(x, root, y, top, least[places], places, best)
                at += len(y)
            query, score, first, at = best.settle()
            key = own.column("keys")[0].values.take(pa.array(query))
            columns = [key, pa.array(score), pa.array(first), ids.take(pa.array(at))]
            found.append(pa.table(columns, ["key", "score", "least", "ids"]))
        return pa.concat_tables(found)

    return search


def _landmarks(sample: np.ndarray) -> np.ndarray:
    """Vectors of the sample, each the farthest from all before it."""
    x = sample.astype(float)
    chosen = [0]
    near = _distances(x, x[0])
    while len(chosen) < min(LANDMARKS, len(x)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(x, x[chosen[-1]]))
    return x[chosen]


def _in_cells(df: DataFrame, width: int, marks: np.ndarray) -> DataFrame:
    def assign(batches):
        for batch in batches:
            x = _matrix(batch.column(batch.schema.get_field_index("vector")), width).astype(float)
            far = (marks * marks).sum(1)[None, :] - 2 * (x @ marks.T)
            yield batch.append_column("cell", pa.array(far.argmin(1).astype(np.int64)))

    return df.mapInArrow(assign, "key string, vector array<long>, ids array<long>, cell long")


def _blocks(df: DataFrame, width: int, marks: np.ndarray, size: int, sample, k: int) -> DataFrame:
    """Packed blocks of about `size` vectors; a large cell is split by a hash of the vector."""
    spark = df.sparkSession
    n = df.count()
    placed = _in_cells(df, width, marks[: max(1, min(len(marks), n // size))])
    placed = materialize(placed, scratch_dir(spark, "cells"))
    counts = placed.groupBy("cell").count()
    parts = counts.select("cell", F.ceil(F.col("count") / size).alias("parts"))
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    block = F.concat_ws("-", "cell", part).alias("block")
    # one row per landmark at most; a merge join would deal all vectors out by cell, then again by block
    split = placed.join(F.broadcast(parts), "cell").select("key", "vector", "ids", block)
    packed = split.groupBy("block").applyInArrow(_packed(width, sample, k), _PACKED)
    return materialize(packed, scratch_dir(spark, "blocks"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates of another id.

    `queries` has query_id and vector, `candidates` vec_id and vector, arrays of long. Score
    is the inner product, which must fit a long; shorter vectors count as padded with zeros.
    Ties go to the smaller vec_id. Null ids and vectors take no part, rows that are repeated
    count once, and a query never meets a candidate of its own id. A query with fewer
    candidates gets all. Equal vectors are searched once, and of one vector's candidates the
    k + 1 of smallest id go on, since no other can be among a query's k best.
    """
    spark = queries.sparkSession
    key = F.md5(F.array_join("vector", ",").cast("binary")).alias("key")
    asked = queries.where("query_id is not null and vector is not null")
    asked = asked.select(F.col("query_id").cast("long"), key, "vector")
    given = candidates.where("vec_id is not null and vector is not null")
    given = given.select(F.col("vec_id").cast("long"), key, "vector").dropDuplicates(["key", "vec_id"])
    order = Window.partitionBy("key").orderBy("vec_id")
    given = given.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    given = given.groupBy("key").agg(
        F.any_value("vector").alias("vector"), F.array_sort(F.collect_list("vec_id")).alias("ids")
    )
    given = materialize(given.select("key", "vector", "ids"), scratch_dir(spark, "vectors"))
    apart = asked.groupBy("key").agg(F.any_value("vector").alias("vector"))
    apart = apart.withColumn("ids", F.array(F.lit(0).cast("long")))
    apart = materialize(apart.select("key", "vector", "ids"), scratch_dir(spark, "queries"))

    longest = [d.agg(F.max(F.size("vector"))).first()[0] or 0 for d in (given, apart)]
    width = max(1, *longest)
    first = given.orderBy("key").limit(SAMPLE).select("vector").toArrow().column("vector")
    sample = _matrix(first.combine_chunks(), width)
    empty = "query_id long, rank int, vec_id long, score long"
    if not len(sample):
        return spark.createDataFrame([], empty)
    marks = _landmarks(sample)
    ours = _blocks(apart, width, marks, QUERY_BLOCK, sample, k + 1)
    theirs = _blocks(given, width, marks, BLOCK, None, k + 1)

    slices = -(-theirs.count() // SLICE)
    spread = F.pmod(F.xxhash64("block"), F.lit(slices)).alias("slice")
    a = ours.select(
        F.col("block").alias("q"), F.col("center").alias("qc"), F.col("radius").alias("qr"), "floor",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"),
    )
    b = theirs.select("block", "center", "radius", spread)
    dot = F.aggregate(F.zip_with("qc", "center", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def norm(c: str) -> Column:
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))

    most = dot + F.col("qr") * norm("center") + F.col("radius") * norm("qc") + F.col("qr") * F.col("radius")
    slack = 1e-9 * (norm("qc") + F.col("qr") + 1) * (norm("center") + F.col("radius") + 1)
    pairs = a.join(b, "slice").where(most + slack >= F.col("floor")).select("q", "slice", "block")
    pairs = materialize(pairs, scratch_dir(spark, "pairs"))
    fields = ["q", "slice", "query", "block", "kind", "data", "tree"]
    shipped = pairs.join(theirs, "block").withColumn("query", F.lit(False)).select(*fields, "ids")
    asking = pairs.select("q", "slice").distinct().join(ours.withColumnRenamed("block", "q"), "q")
    asking = asking.withColumns({"query": F.lit(True), "block": F.col("q")})
    asking = asking.select(*fields, "floors", "keys")
    both = shipped.unionByName(asking, allowMissingColumns=True)
    found = both.groupBy("q", "slice").applyInArrow(_search(width, k + 1), _FOUND)

    best = Window.partitionBy("key").orderBy(F.desc("score"), "least")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    lists = found.groupBy("key").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    # a table, so that the join can split the queries of a vector that very many share
    lists = materialize(lists, scratch_dir(spark, "found"))
    matched = asked.select("query_id", "key").distinct().join(lists, "key")
    ranked = F.expr(
        f"""slice(array_sort(filter(flatten(transform(found,
            f -> transform(f.ids, i -> named_struct('less', -f.score, 'vec_id', i)))),
            x -> x.vec_id <> query_id)), 1, {k})"""
    )
    rows = matched.select("query_id", F.posexplode(ranked).alias("at", "hit"))
    return rows.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.less")).alias("score"),
    )
