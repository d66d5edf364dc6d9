"""Connected components of an edge table, by rounds of distributed star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.session import drop_path, materialize, scratch_dir

#: Parts, a power of two, that a node's neighbours are dealt to.
SALTS = 64


#: Edges that a task joins into components at once.
AT_ONCE = 1 << 19

#: Types of nodes that Arrow and Spark sort alike.
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _forest(u: pa.ChunkedArray, v: pa.ChunkedArray) -> tuple[pa.Array, pa.Array]:
    """Each node but the least of its component of these edges, and that least one."""
    nodes = pa.chunked_array([*u.chunks, *v.chunks], u.type).unique()
    nodes = nodes.take(pc.array_sort_indices(nodes))
    a, b = (pc.index_in(x, nodes).to_numpy() for x in (u, v))
    own = np.arange(len(nodes))
    root = own.copy()
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    rest = np.flatnonzero(root != own)
    return nodes.take(pa.array(rest)), nodes.take(pa.array(root[rest]))


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forests of a task's edges (u, v), `AT_ONCE` edges or a little more for each."""
    held, size = [], 0

    def joined() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        u, v = _forest(table.column(0), table.column(1))
        yield from pa.table({"u": u, "v": v}).to_batches(max_chunksize=1 << 16)

    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= AT_ONCE:
            yield from joined()
            held, size = [], 0
    if size:
        yield from joined()


def _contracted(edges: DataFrame) -> DataFrame:
    """`edges` (u, v), those of a task replaced by the forest of their components."""
    kind = edges.schema["u"].dataType
    if isinstance(kind, _PLAIN) or kind == T.StringType():
        return edges.mapInArrow(_forests, edges.schema)
    return edges


def _state(edges: DataFrame) -> tuple[bool, bool, int]:
    """Whether every u has one v, which is no u itself, whether some u has several rows, and all rows."""
    ends = edges.select(F.col("u").alias("node"), "v", F.lit(False).alias("low")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(None).cast(edges.schema["v"].dataType).alias("v"), F.lit(True).alias("low"))
    )
    # both kinds of rows are merged before the exchange, so that no node is hot
    nodes = ends.groupBy("node").agg(
        F.count("v").alias("n"), F.min("v").alias("p"), F.max("v").alias("q"), F.max("low").alias("low")
    )
    wrong, repeated, rows = nodes.agg(
        F.count(F.when((F.col("n") > 0) & (F.col("low") | (F.col("p") < F.col("q"))), 1)),
        F.count(F.when(F.col("n") > 1, 1)),
        F.sum("n"),
    ).first()
    return wrong == 0, repeated > 0, rows or 0


def _written(edges: DataFrame) -> tuple[DataFrame, str, bool, bool]:
    """`edges` contracted as a table, its path and state; tasks have `AT_ONCE` edges where there are that many."""
    spark = edges.sparkSession
    path = scratch_dir(spark, "edges")
    now = materialize(_contracted(edges.distinct()), path)
    settled, repeated, rows = _state(now)
    tasks = -(-rows // AT_ONCE)
    if not settled and tasks < len(now.inputFiles()):
        old, path = path, scratch_dir(spark, "edges")
        now = materialize(_contracted(now.coalesce(tasks)), path)
        drop_path(spark, old)
        settled, repeated, _ = _state(now)
    return now, path, settled, repeated


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) with the least v of each u as `m`; no task gets all of one u's rows.

    Rows are dealt by u and a hash of v. Each such part gives one row, of which a u has at
    most `SALTS`; these alone meet by u, and the minimum goes back to the parts.
    """
    known = pairs.where("u is not null and v is not null")
    salted = known.withColumn("part", F.xxhash64("v").bitwiseAND(SALTS - 1)).repartition("u", "part")
    parts = salted.groupBy("u", "part").agg(F.min("v").alias("own"))
    least = parts.groupBy("u").agg(F.min("own").alias("m"))
    # all three take the same columns of `salted`, so that one exchange serves them
    spread = parts.join(least, "u").select("u", "part", F.least("own", "m").alias("m"))
    # merged, since a broadcast with a key of two longs fills a memory page (32 MB of a heap of
    # 1.8 GB) of every executor, however small it is, and those of all rounds would add up there
    return salted.join(spread.hint("merge"), ["u", "part"]).select("u", "v", "m")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node it can reach.

    Edges that meet in a task are joined into components there; up to `AT_ONCE` need one task and
    nothing else. Of more, each round links every node's larger neighbours to its smallest
    neighbour, and every node's smaller neighbours to the smallest of them, until every node has
    its root. A round is a dozen exchanges, whose plans and broadcasts add up in the driver. A node's neighbours never come together in one row or task of a round,
    however many it has. Rounds are cut by tables in the shared folder, of which only the last one
    stays. Nulls and self-loops are ignored; repeated edges count once; no edges give an empty table.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = now.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
    now, path, settled, repeated = _written(now)
    while not settled:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        moved = _with_least(large)
        # a node's own row comes from the row of its least neighbour
        moved = moved.select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        old = path
        now, path, settled, repeated = _written(moved)
        drop_path(spark, old)
    now = now.distinct() if repeated else now
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
