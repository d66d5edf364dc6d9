"""Rolling statistics over row-count frames with a least number of observations.

`rolling` evaluates many statistics in a few Window operators. Its methods give the same
numbers:

* ``frame``: Spark's sliding frame. Each row re-aggregates its whole frame, so the cost
  is rows x frame length. Right for short frames, and the yardstick for the others.
* ``running``, at a cost that does not depend on the frame length:

  * Sums and means are differences of two running totals. A plain difference of doubles
    loses digits once a large value has passed through, so each value is split into an
    exact integer multiple of a power of two (summed as BIGINT, no rounding) and a
    remainder below that power, whose rounding error is some 2^-66 of the largest value
    in the group. Groups of over 2^22 rows are split at a bit less for each doubling.
  * Deviations cannot be differenced safely. Rows are cut into blocks as long as the
    frame, so that a frame is the end of one block and the beginning of the next, and the
    moments of both are merged: rows outside the frame never enter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

# Multiples stay below 2^40, and lower in groups of more than 2^22 rows, so that the multiples
# of all rows can be summed in a BIGINT.
_SPLIT_BITS = 40
_SUM_BITS = 62
# Frames up to this length are cheaper to re-aggregate than to difference.
SHORT_FRAME = 64

_WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
_RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@dataclass(frozen=True)
class Roll:
    """`how` of `col` over the `rows` rows that end at the current one.

    `sum`, `mean` and `std` (sample deviation) are NULL below `min_obs` observations;
    `lag` is the value `rows` rows earlier.
    """

    out: str
    col: str
    how: str
    rows: int
    min_obs: int = 1

    def __post_init__(self):
        if self.how not in ("sum", "mean", "std", "lag"):
            raise ValueError(f"unknown statistic: {self.how}")
        if self.rows < 1 or self.min_obs < 1:
            raise ValueError("rows and min_obs must be at least 1")


@dataclass(frozen=True)
class Reach:
    """Frames also end `days` days before the row's own `day` (an integer column, which
    must lead the ordering): rows of older days are out of sight."""

    day: str
    days: int


def rolling(
    df: DataFrame,
    rolls: Sequence[Roll],
    keys: Sequence[str],
    order: Sequence[str] = ("ts",),
    method: str = "auto",
    reach: Reach | None = None,
) -> DataFrame:
    """Add one column per roll. NaN and infinities count as missing.

    `keys` must keep groups bounded: a group is one task's work.
    """
    if method not in ("auto", "frame", "running"):
        raise ValueError(f"unknown method: {method}")
    if reach and (method == "frame" or order[0] != reach.day):
        raise ValueError("a reach needs running totals and its day first in the ordering")
    if reach and any(r.how == "std" for r in rolls):
        raise ValueError("deviations know no reach")
    partition = "PARTITION BY " + ", ".join(f"`{k}`" for k in keys)
    over = f"{partition} ORDER BY " + ", ".join(f"`{o}`" for o in order)

    def is_framed(r: Roll) -> bool:
        if reach:
            return False
        return method == "frame" or r.how == "lag" or (method == "auto" and r.rows <= SHORT_FRAME)

    deviating = {(r.col, r.rows) for r in rolls if r.how == "std" and not is_framed(r)}
    short = [r for r in rolls if is_framed(r)]
    blocked = [r for r in rolls if (r.col, r.rows) in deviating and r.how in ("mean", "std")]
    summed = [r for r in rolls if r not in short and r not in blocked]
    columns = [f"`{c}`" for c in df.columns]
    masked = {c: f"_x{i}" for i, c in enumerate(dict.fromkeys(r.col for r in rolls))}
    df = df.selectExpr(
        "*",
        *[
            f"CASE WHEN abs(`{c}`) < double('infinity') THEN `{c}` END AS {x}"
            for c, x in masked.items()
        ],
    )
    # The short frames ride along in the first Window operator of the totals.
    framed = [f"{_framed(r, masked[r.col], over)} AS `{r.out}`" for r in short]
    if summed:
        df = _totalled(df, summed, masked, over, partition, framed, reach)
    else:
        df = df.selectExpr("*", *framed)
    for rows in dict.fromkeys(r.rows for r in blocked):
        df = _blocked(df, [r for r in blocked if r.rows == rows], masked, over, partition)
    return df.selectExpr(*columns, *[f"`{r.out}`" for r in rolls])


def lag_n(
    df: DataFrame, out: str, col: str, n: int, keys: Sequence[str], order: Sequence[str] = ("ts",)
) -> DataFrame:
    """`col` as it was n rows earlier, NULL where the group is shorter."""
    return rolling(df, [Roll(out, col, "lag", n)], keys, order)


def zscore(
    df: DataFrame,
    out: str,
    col: str,
    rows: int,
    min_obs: int,
    keys: Sequence[str],
    order: Sequence[str] = ("ts",),
    method: str = "auto",
) -> DataFrame:
    """(x - rolling mean) / rolling sample deviation, NULL where the deviation is 0."""
    stats = [Roll("_mean", col, "mean", rows, min_obs), Roll("_std", col, "std", rows, min_obs)]
    df = rolling(df, stats, keys, order, method)
    return df.selectExpr("*", f"try_divide(`{col}` - _mean, _std) AS `{out}`").drop("_mean", "_std")


def _framed(roll: Roll, x: str, over: str) -> str:
    if roll.how == "lag":
        return f"lag({x}, {roll.rows}) OVER ({over})"
    frame = f"({over} ROWS BETWEEN {roll.rows - 1} PRECEDING AND CURRENT ROW)"
    agg = {"sum": "sum", "mean": "avg", "std": "stddev_samp"}[roll.how]
    return f"CASE WHEN count({x}) OVER {frame} >= {roll.min_obs} THEN {agg}({x}) OVER {frame} END"


def _totalled(
    df: DataFrame,
    rolls: Sequence[Roll],
    masked: dict,
    over: str,
    partition: str,
    framed: Sequence[str],
    reach: Reach | None,
) -> DataFrame:
    """Sums, means and lags as differences of running totals."""
    cols = list(dict.fromkeys(masked[r.col] for r in rolls if r.how != "lag"))

    # 1. The scale of each column in its group: the power of two to split by.
    df = df.selectExpr(
        "*",
        *framed,
        f"count(1) OVER ({over} {_WHOLE}) AS _n_rows",
        *[f"max(abs({x})) OVER ({over} {_WHOLE}) AS {x}_max" for x in cols],
    )
    exponent = "int(ceil(log2(nullif({x}_max, 0D))))"
    bits = f"least({_SPLIT_BITS}, {_SUM_BITS} - int(ceil(log2(_n_rows))))"
    power = f"pow(2D, greatest(least({exponent}, 1020) - {bits}, -1000))"
    df = df.selectExpr("*", *[f"{power.format(x=x)} AS {x}_q" for x in cols])
    df = df.selectExpr(
        "*", *[f"bigint(floor(coalesce({x}, 0D) / {x}_q)) AS {x}_mult" for x in cols]
    )

    # 2. Total the multiples, the remainders and the observations.
    steps = {}
    for x in cols:
        steps[f"{x}_hi"] = f"sum({x}_mult)"
        steps[f"{x}_lo"] = f"sum(coalesce({x}, 0D) - {x}_mult * {x}_q)"
        steps[f"{x}_n"] = f"count({x})"
    df = df.selectExpr(
        "*", *[f"{step} OVER ({over} {_RUNNING}) AS {total}" for total, step in steps.items()]
    )

    # 3. The totals where each frame begins: so many rows back, but within reach.
    wanted = {
        (f"{masked[r.col]}_{part}", r.rows)
        for r in rolls
        if r.how != "lag"
        for part in ("hi", "lo", "n")
    }
    lags = {(masked[r.col], r.rows) for r in rolls if r.how == "lag"}
    back = [f"lag({c}, {w}, 0) OVER ({over}) AS {c}{w}" for c, w in sorted(wanted)]
    back += [f"lag({x}, {w}) OVER ({over}) AS {x}_lag{w}" for x, w in sorted(lags)]
    begin = {(c, w): f"{c}{w}" for c, w in wanted}
    if reach:
        beyond = (
            f"({partition} ORDER BY `{reach.day}` "
            f"RANGE BETWEEN UNBOUNDED PRECEDING AND {reach.days + 1} PRECEDING)"
        )
        back.append(f"row_number() OVER ({over}) AS _row")
        begin = {
            (c, w): f"if(_row - {w} >= _row_edge, {c}{w}, coalesce({c}_edge, 0))" for c, w in wanted
        }
        df = df.selectExpr(
            "*",
            f"count(1) OVER {beyond} AS _row_edge",
            *[f"{step} OVER {beyond} AS {total}_edge" for total, step in steps.items()],
        )
    df = df.selectExpr("*", *back)

    def of(roll: Roll) -> str:
        x, w = masked[roll.col], roll.rows
        if roll.how == "lag":
            seen = f"CASE WHEN _row - {w} > _row_edge THEN {x}_lag{w} END"
            return seen if reach else f"{x}_lag{w}"
        hi, lo, n = (f"({c} - {begin[c, w]})" for c in (f"{x}_hi", f"{x}_lo", f"{x}_n"))
        total = f"({hi} * {x}_q + {lo})"
        out = f"{total} / {n}" if roll.how == "mean" else total
        return f"CASE WHEN {n} >= {roll.min_obs} THEN {out} END"

    return df.selectExpr("*", *[f"{of(r)} AS `{r.out}`" for r in rolls])


def _blocked(
    df: DataFrame, rolls: Sequence[Roll], masked: dict, over: str, partition: str
) -> DataFrame:
    """Deviations (and means of the same frames) from the moments of two part frames.

    All rolls have the same length. The last ordering is by block and row, which the
    operators after it share.
    """
    rows = rolls[0].rows
    cols = list(dict.fromkeys(masked[r.col] for r in rolls))
    moments = {"n": "count", "mid": "avg", "var": "var_pop", "min": "min", "max": "max"}

    def part_frame(side: str, order: str) -> list[str]:
        w = f"{partition}, _block ORDER BY _rn {order} {_RUNNING}"
        return [f"{f}({x}) OVER ({w}) AS {x}_{side}{m}" for x in cols for m, f in moments.items()]

    df = df.selectExpr("*", f"row_number() OVER ({over}) AS _rn").selectExpr(
        "*", f"(_rn - 1) DIV {rows} AS _block"
    )
    df = df.selectExpr("*", *part_frame("t", "DESC")).selectExpr("*", *part_frame("h", "ASC"))
    if rows > 1:
        by_row = f"{partition} ORDER BY _block, _rn"
        # A frame that ends with its block is the block, head alone.
        df = df.selectExpr(
            "*",
            *[
                f"CASE WHEN _rn % {rows} <> 0 THEN "
                f"lag({x}_t{m}, {rows - 1}) OVER ({by_row}) END AS {x}_o{m}"
                for x in cols
                for m in moments
            ],
        )
    else:
        df = df.selectExpr("*", *[f"NULL AS {x}_o{m}" for x in cols for m in moments])

    def of(roll: Roll) -> str:
        x = masked[roll.col]
        old, new = f"coalesce({x}_on, 0)", f"{x}_hn"
        n = f"({old} + {new})"
        mean = (
            f"(coalesce({x}_omid, 0D) * {old} + coalesce({x}_hmid, 0D) * {new}) / {n}"
        )
        if roll.how == "mean":
            out = mean
        else:
            # All observations being equal must give 0, not rounding noise.
            squares = (
                f"coalesce({x}_ovar, 0D) * {old} + coalesce({x}_hvar, 0D) * {new} + "
                f"coalesce(pow({x}_omid - {x}_hmid, 2), 0D) * ({old} * 1D * {new} / {n})"
            )
            same = f"least({x}_omin, {x}_hmin) = greatest({x}_omax, {x}_hmax)"
            out = (
                f"CASE WHEN {n} = 1 THEN NULL WHEN {same} THEN 0D "
                f"ELSE sqrt(({squares}) / ({n} - 1)) END"
            )
        return f"CASE WHEN {n} >= {roll.min_obs} THEN {out} END"

    return df.selectExpr("*", *[f"{of(r)} AS `{r.out}`" for r in rolls]).drop(
        "_rn", "_block", *[f"{x}_{side}{m}" for x in cols for side in "tho" for m in moments]
    )
