"""Hard negatives by slots: one pass over scores answers all windows of an anchor.

An anchor's positives are its best other rows of its own label. Each positive allows negatives
up to a share of its score; these upper limits, in falling order, cut the scores into disjoint
slots. Anchors and rows meet in tiles of a block by a block. A tile keeps the best `k` rows of
another label per anchor and slot, and so does the merge of tiles. A positive's window begins
with its own slot, so its negatives are the first `k` of that slot and all lower ones, as far
as they reach the window's lower limit: overlapping windows share what the slots hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.llm.topk import _matrix
from tidebar.session import drop_path, materialize, scratch_dir

#: Rows of a block and anchors of a block, about; anchors of a tile that are scored together.
BLOCK, ANCHORS, STRIP = 8192, 2048, 256

_PACKED = "block long, ids binary, names array<string>, codes binary, kind string, data binary, limits binary, least binary"


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the least integer type that holds them."""
    large = int(np.abs(x).max(initial=0))
    kind = next(k for k, most in (("i2", 1 << 15), ("i4", 1 << 31), ("i8", 1 << 64)) if large < most)
    return x.astype(kind)


def _pack(table: pa.Table) -> pa.Table:
    """A block's rows as one, in order of ids; limits and least scores are an anchor's."""
    table = table.sort_by("vec_id")
    lists = table.column("vector").combine_chunks()
    x = _narrow(_matrix(lists, int(np.diff(lists.offsets.to_numpy()).max(initial=0))))
    names = table.column("label").combine_chunks().dictionary_encode()
    extra = {"limits": np.empty(0, np.int64), "least": np.empty(0, np.int64)}
    if "limits" in table.column_names:
        each = table.column("limits").combine_chunks()
        width = int(np.diff(each.offsets.to_numpy()).max(initial=0))
        extra = {"limits": np.full((len(x), width), np.iinfo(np.int64).min), "least": table.column("least").to_numpy()}
        for i, own in enumerate(each.to_pylist()):
            extra["limits"][i, : len(own)] = own
    columns = {
        "block": pa.array(table.column("block").to_pylist()[:1], pa.int64()),
        "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
        "names": pa.array([names.dictionary.to_pylist()], pa.list_(pa.string())),
        "codes": pa.array([names.indices.to_numpy().astype(np.int32).tobytes()], pa.binary()),
        "kind": pa.array([x.dtype.str]),
        "data": pa.array([x.tobytes()], pa.binary()),
    }
    return pa.table(columns | {k: pa.array([v.tobytes()], pa.binary()) for k, v in extra.items()})


def _blocks(df: DataFrame, n: int, size: int) -> DataFrame:
    """Packed blocks of about `size` of the `n` rows of `df`, whose ids are distinct."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // size)))).cast("long")
    packed = df.withColumn("block", block).groupBy("block").applyInArrow(_pack, _PACKED)
    return materialize(packed, scratch_dir(df.sparkSession, "blocks"))


def _unpacked(tables: list[pa.Table]) -> list[tuple]:
    """(ids, labels as numbers common to all, vectors as rows of one width, the row) of each block."""
    numbers: dict[str, int] = {}
    out = []
    for table in tables:
        row = table.to_pylist()[0]
        ids = np.frombuffer(row["ids"], np.int64)
        own = np.array([numbers.setdefault(name, len(numbers)) for name in row["names"]], np.int64)
        data = np.frombuffer(row["data"], row["kind"]).reshape(len(ids), -1)
        out.append((ids, own[np.frombuffer(row["codes"], np.int32)], data, row))
    width = max(x.shape[1] for _, _, x, _ in out)
    large = [float(np.abs(x.astype(float)).max(initial=0)) + 1 for _, _, x, _ in out]
    # products are whole in doubles if no sum can pass 2^53
    kind = np.float64 if np.prod(large) * max(width, 1) < 2**53 else np.int64
    return [(i, c, np.pad(x.astype(kind), ((0, 0), (0, width - x.shape[1]))), r) for i, c, x, r in out]


def _first(scores: np.ndarray, k: int):
    """(row, column, score) of each row's k best columns, the first of equal ones; `scores` is used up.

    The least number of the type marks what takes no part.
    """
    none = -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min
    rows = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        best = scores.argmax(1)
        top = scores[rows, best]
        good = top > none
        if not good.any():
            return
        yield rows[good], best[good], top[good].astype(np.int64)
        scores[rows, best] = none


def _table(found: list[tuple], names: list[str]) -> pa.Table:
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [[]] * len(names)
    return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(names, columns, strict=True)})


def _positives(n: int):
    """Each anchor's best `n` other rows of its label in a tile."""

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            (ids, label, x, _), (other, its, y, _) = _unpacked([left, right])
            none = -np.inf if x.dtype.kind == "f" else np.iinfo(np.int64).min
            for value in np.intersect1d(label, its):
                rows, columns = np.flatnonzero(label == value), np.flatnonzero(its == value)
                for at in range(0, len(rows), STRIP):
                    some = rows[at : at + STRIP]
                    scores = x[some] @ y[columns].T
                    scores[ids[some][:, None] == other[columns][None, :]] = none
                    for r, c, s in _first(scores, n):
                        found.append((ids[some[r]], other[columns[c]], s))
        return _table(found, ["anchor_id", "positive_id", "positive_score"])

    return tile


def slots_of(scores: np.ndarray, limits: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Number of limits, in falling order, that a score does not pass; 0 as well if it is below `least`."""
    slot = np.zeros(scores.shape, np.int16)
    for limit in limits.T:
        slot += scores <= limit[:, None]
    slot[scores < least[:, None]] = 0
    return slot


def _negatives(k: int):
    """The best `k` rows of another label per anchor and slot in a tile."""

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            (ids, label, x, row), (other, its, y, _) = _unpacked([left, right])
            none = -np.inf if x.dtype.kind == "f" else np.iinfo(np.int64).min
            limits = np.frombuffer(row["limits"], np.int64).reshape(len(ids), -1)
            least = np.frombuffer(row["least"], np.int64)
            for at in range(0, len(ids), STRIP):
                some = slice(at, at + STRIP)
                scores = x[some] @ y.T
                slot = slots_of(scores, limits[some], least[some])
                slot[label[some][:, None] == its[None, :]] = 0
                for number in range(1, limits.shape[1] + 1):
                    for r, c, s in _first(np.where(slot == number, scores, none), k):
                        found.append((ids[at + r], np.full(len(r), number), other[c], s))
        return _table(found, ["anchor_id", "slot", "negative_id", "negative_score"])

    return tile


def _tiles(left: DataFrame, right: DataFrame, work, schema: str) -> DataFrame:
    """`work` on each block of `left` with each of `right`: the stated anchors against all rows."""
    n_left, n_right = (d.agg(F.max("block")).first()[0] + 1 for d in (left, right))


    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    a = left.select("*", F.col("block").alias("a"), each(n_right).alias("b"))
    b = right.select("*", each(n_left).alias("a"), F.col("block").alias("b"))
    return a.groupBy("a", "b").cogroup(b.groupBy("a", "b")).applyInArrow(work, schema)


def _leading(df: DataFrame, keys: list[str], score: str, ident: str, n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, k: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has vec_id, label of any type and vector, an array of long; `anchors` is a condition on
    vec_id. A score is the inner product, shorter vectors count as padded with zeros; it times 100
    must fit a long. Higher scores come first, equal ones by the smaller vec_id. For each of an
    anchor's first `positives` other rows of its label, the first `k` rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score are returned; all of
    either if fewer, none where the window is empty, as it is below a score of 0. Rows with a
    null id, label, vector or component take no part; of rows with one id that with the least
    label, then vector, counts. Other columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    known = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "vector")
    known = known.where("vec_id is not null and label is not null and vector is not null")
    known = known.where(~F.exists("vector", lambda x: x.isNull()))
    known = known.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    path = scratch_dir(spark, "rows")
    known = materialize(known.select("vec_id", "row.label", "row.vector"), path)
    asked = known.where(anchors)
    n, n_asked = known.count(), asked.count()
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_asked:
        return spark.createDataFrame([], names)
    theirs = _blocks(known, n, BLOCK)
    ours = _blocks(asked, n_asked, ANCHORS)
    found = _tiles(ours, theirs, _positives(positives), "anchor_id long, positive_id long, positive_score long")
    pairs = _leading(found, ["anchor_id"], "positive_score", "positive_id", positives)
    pairs = pairs.select(
        "anchor_id", "positive_id", "positive_score",
        F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100").alias("limit"),
        F.expr(f"({low} * positive_score + pmod(-{low} * positive_score, 100)) div 100").alias("least"),
    )
    pairs = materialize(pairs.where("least <= limit"), scratch_dir(spark, "positives"))
    limits = pairs.groupBy("anchor_id").agg(
        F.sort_array(F.collect_set("limit"), asc=False).alias("limits"), F.min("least").alias("least")
    )
    asked = asked.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    asked = materialize(asked, scratch_dir(spark, "anchors"))
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], names)
    ours = _blocks(asked, n_asked, ANCHORS)
    drop_path(spark, path)
    held = "anchor_id long, slot long, negative_id long, negative_score long"
    slots = _tiles(ours, theirs, _negatives(k), held)
    slots = _leading(slots, ["anchor_id", "slot"], "negative_score", "negative_id", k)
    lists = slots.groupBy("anchor_id").agg(
        F.sort_array(
            F.collect_list(F.struct("slot", (-F.col("negative_score")).alias("less"), "negative_id"))
        ).alias("held")
    )
    limits = asked.select(F.col("vec_id").alias("anchor_id"), "limits")
    windows = pairs.join(limits, "anchor_id").join(lists, "anchor_id")
    # slots fall in score, so what a window may take is a stretch of the sorted list
    taken = F.expr(
        f"filter(slice(filter(held, x -> x.slot >= array_position(limits, limit)), 1, {k}), x -> -x.less >= least)"
    )
    out = windows.select("anchor_id", "positive_id", "positive_score", F.posexplode(taken).alias("at", "hit"))
    return out.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.negative_id").alias("negative_id"),
        "positive_score",
        (-F.col("hit.less")).alias("negative_score"),
    )
