"""Ticks to one-minute bars, and log returns within each source day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.scalars import (
    day_start,
    in_day,
    ln_ieee,
    minute_floor,
    nan_to_null,
    utc_day_number,
)
from tidebar.schema import BAR_COLS, PRICE_COLS

KEYS = ["symbol", "source_day"]
_OHLCV = ["ts", *PRICE_COLS, "volume", "taker_base"]


def drop_null_ts(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.col("ts").isNotNull())


def clip_to_day(df: DataFrame, ts: str = "ts", day: str = "source_day") -> DataFrame:
    """Keep rows inside their own UTC day, [day, day + 1)."""
    return df.where(in_day(F.col(ts), F.col(day)))


def _bar_aggs(tie_break: bool) -> list[Column]:
    def when_seen(col: str) -> Column:
        # NULL ordering keys are skipped, so open/close are the first/last known price.
        order = F.struct("ts", col) if tie_break else F.col("ts")
        return F.when(F.col(col).isNotNull(), order)

    def total(col: str) -> Column:
        return nan_to_null(F.coalesce(F.sum(col), F.lit(0.0))).alias(col)

    return [
        F.min_by("open", when_seen("open")).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", when_seen("close")).alias("close"),
        total("volume"),
        total("taker_base"),
    ]


def minute_bars(
    ticks: DataFrame, keys: list[str] | None = None, tie_break: bool = False
) -> DataFrame:
    """One bar per key and non-empty minute; a minute without volumes sums to 0.0.

    Rows that share a timestamp have no defined order. With `tie_break` the lower
    (open) or higher (close) price decides, at the cost of a sort-based aggregate;
    without it the aggregate stays hash-based and any of the tied rows may be taken.
    """
    keys = KEYS if keys is None else keys
    minute = minute_floor(F.col("ts")).alias("_minute")
    return (
        drop_null_ts(ticks)
        .select("*", minute)
        .groupBy(*keys, "_minute")
        .agg(*_bar_aggs(tie_break))
        .withColumnRenamed("_minute", "ts")
        .select(*keys, *_OHLCV)
    )


def with_returns(bars: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Add `ret1m` (log difference to the bar before, 0.0 where unknown), its square
    and its absolute value. Starts afresh in every group of `keys`."""
    keys = KEYS if keys is None else keys
    by_ts = Window.partitionBy(*keys).orderBy("ts")
    ret = F.col("_lnc") - F.lag("_lnc").over(by_ts)
    return (
        bars.withColumn("_lnc", ln_ieee(F.col("close")))
        .withColumn("ret1m", F.coalesce(nan_to_null(ret), F.lit(0.0)))
        .withColumn("ret2_1m", F.col("ret1m") * F.col("ret1m"))
        .withColumn("absret1m", F.abs("ret1m"))
        .drop("_lnc")
    )


def day_bars(ticks: DataFrame, tie_break: bool = False) -> DataFrame:
    """Bars with returns of each source day, clipped to that day.

    Equals `clip_to_day(with_returns(minute_bars(ticks)))`. Rows after the day cannot
    influence it, and of those before it only the last minute's close does (it feeds the
    first return). So the former are dropped and the latter share one bucket, which
    bounds every window group at 1,441 rows however many stray rows a day carries.
    """
    early = utc_day_number(F.col("ts")) <= F.unix_date("source_day")
    return bars_of(counted_bars(drop_null_ts(ticks).where(early), tie_break))


def bars_of(counted: DataFrame) -> DataFrame:
    """The bars among the rows of `counted_bars`."""
    return counted.where(F.col("ts") >= day_start(F.col("source_day"))).select(*BAR_COLS)


def rows_met(counted: DataFrame) -> DataFrame:
    """(symbol, source_day, n_rows): how many rows `counted_bars` was given of each day."""
    return counted.groupBy(*KEYS).agg(F.sum("n").alias("n_rows"))


def counted_bars(ticks: DataFrame, tie_break: bool = False) -> DataFrame:
    """The bars of `day_bars`, and besides them a row per day for what lies before the day and
    one, of no minute, for what lies after it or has no instant; `n` counts every row's ticks.

    So one pass over raw rows gives both the bars and how many rows could be read.
    """
    opens = day_start(F.col("source_day"))
    carry = opens - F.expr("interval 1 minute")
    counts = utc_day_number(F.col("ts")) <= F.unix_date("source_day")
    minute = F.when(counts, F.greatest(minute_floor(F.col("ts")), carry))
    last_seen = F.max("ts").alias("_last_ts")
    last_close = F.max(F.when(F.col("close").isNotNull(), F.col("ts"))).alias("_close_ts")

    bars = (
        ticks.select("*", minute.alias("_minute"))
        .groupBy(*KEYS, "_minute")
        .agg(*_bar_aggs(tie_break), last_seen, last_close, F.count("*").alias("n"))
        .withColumnRenamed("_minute", "ts")
        # The carry bucket spans many minutes: its close counts only if it belongs
        # to the last of them. Rows of no minute have no close to follow.
        .withColumn(
            "close",
            F.when(
                (F.col("ts") >= opens)
                | (F.col("ts").isNotNull() & (minute_floor(F.col("_last_ts")) == minute_floor(F.col("_close_ts")))),
                F.col("close"),
            ),
        )
    )
    return with_returns(bars).select(*BAR_COLS, "n")
