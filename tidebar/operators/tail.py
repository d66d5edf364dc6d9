"""Bounded history: every target day sees its own bars and those of the days before it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Target days that travel together. A bar is shuffled 1 + tail_days / BLOCK_DAYS times
# on average instead of 1 + tail_days times.
BLOCK_DAYS = 7

# Rows of blocks in a task, about: 140 of a symbol's days of full minutes.
ROWS_PER_TASK = 200_000

BLOCK_KEYS = ["part", "symbol"]
FAN_KEYS = ["part", "symbol", "target_day"]


def spread_blocks(
    bars: DataFrame,
    start: date | None = None,
    end: date | None = None,
    tail_days: int = 7,
    block_days: int = BLOCK_DAYS,
    n_bars: int | None = None,
) -> DataFrame:
    """Send each bar to every block of target days that needs it.

    A source day is needed by the target days `source_day .. source_day + tail_days` that
    lie in `[start, end]`. Adds `first_target` and `last_target` (day numbers: those the
    row serves within its block) and `part`, the shuffle key. Windows over `BLOCK_KEYS` or
    `FAN_KEYS` need no further exchange, and a group never exceeds tail_days + block_days
    days of bars, whatever the symbol's share of the data.
    """
    if tail_days < 0 or block_days < 1:
        raise ValueError("tail_days must be >= 0 and block_days >= 1")
    first, last = "unix_date(source_day)", f"unix_date(source_day) + {tail_days}"
    if start is not None:
        bars = bars.where(F.col("source_day") >= F.date_sub(F.lit(start), tail_days))
        first = f"greatest({first}, unix_date(DATE'{start}'))"
    if end is not None:
        bars = bars.where(F.col("source_day") <= F.lit(end))
        last = f"least({last}, unix_date(DATE'{end}'))"
    opens = f"_block * {block_days}"
    # AQE merges partitions by their size before rows multiply, so the number is set: by
    # the number of bars where the caller knows it.
    partitions = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n_bars is not None:
        partitions = max(1, -(-n_bars * (tail_days + block_days) // (block_days * ROWS_PER_TASK)))
    return (
        bars.selectExpr(
            "*",
            f"explode(sequence(int(floor(({first}) / {block_days})),"
            f" int(floor(({last}) / {block_days})))) AS _block",
        )
        # One hashed key rather than two columns: a constant symbol would be folded out
        # of the windows' keys and cost them a second exchange.
        .selectExpr(
            "*",
            f"greatest({first}, {opens}) AS first_target",
            f"least({last}, {opens} + {block_days - 1}) AS last_target",
            "xxhash64(symbol, _block) AS part",
        )
        .drop("_block")
        .repartition(partitions, "part")
    )


def fan_out(blocks: DataFrame) -> DataFrame:
    """One copy of each row of `spread_blocks` per target day it serves, made in place."""
    return (
        blocks.selectExpr("*", "explode(sequence(first_target, last_target)) AS _target")
        .selectExpr("*", "date_from_unix_date(_target) AS target_day")
        .drop("first_target", "last_target", "_target")
    )
