"""Raw kline columns to canonical ticks: names, instants and numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.functions.scalars import from_epoch, nan_to_null, parse_instant, parse_number
from tidebar.schema import (
    MILLIS_THRESHOLD,
    PRICE_COLS,
    TAKER_ALIASES,
    TICK_COLS,
    TIME_ALIASES,
    VOLUME_ALIASES,
)

def pick_alias(present: Sequence[str], names: Sequence[str]) -> str | None:
    """The first of `names` that is present; values play no part."""
    return next((n for n in names if n in present), None)


def missing_columns(present: Sequence[str]) -> list[str]:
    """Canonical names of the required columns that are absent."""
    missing = [c for c in PRICE_COLS if c not in present]
    return missing if pick_alias(present, VOLUME_ALIASES) else [*missing, "volume"]


MISSING_MESSAGE = "missing required columns: "
NO_TIME_MESSAGE = "no timestamp column found"


def is_epoch(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def time_facts(ts: Column | None, epoch: Column | None) -> list[Column]:
    """Aggregates that settle a day's time column: `any_ts`, whether some `ts` is an
    instant, and `unit`, from the median of the epoch counts.

    Only the side of the threshold the median falls on matters, so counts and the two
    values next to the threshold replace the median itself: nothing to sort or hold.
    """
    any_ts = F.lit(False) if ts is None else F.coalesce(F.bool_or(ts.isNotNull()), F.lit(False))
    if epoch is None:
        return [any_ts.alias("any_ts"), F.lit("s").alias("unit")]
    n, above, low, high = epoch_counts(epoch)
    return [any_ts.alias("any_ts"), unit_of(n, above, low, high).alias("unit")]


def epoch_counts(epoch: Column) -> list[Column]:
    """Aggregates from which `unit_of` tells the unit: the number of counts and of those above
    the threshold, and the two next to it. They add up over parts of a day."""
    v = nan_to_null(epoch.cast("double"))
    above = v > MILLIS_THRESHOLD
    return [F.count(v), F.count_if(above), F.max(F.when(~above, v)), F.min(F.when(above, v))]


def unit_of(n: Column, above: Column, low: Column, high: Column) -> Column:
    """`ms` where the median is above the threshold, else `s`."""
    # With an even count split in half, the median is the mean of the two neighbours.
    ms = (2 * above > n) | ((n > 0) & (2 * above == n) & ((low + high) / 2 > MILLIS_THRESHOLD))
    return F.when(ms, "ms").otherwise("s")


def tick_columns(
    dtypes: dict[str, T.DataType], volume: str | None, taker: str | None
) -> list[Column]:
    """Prices and volumes as doubles; a column the data lack is all NULL."""

    def number(name: str | None, out: str) -> Column:
        if name not in dtypes:
            return F.lit(None).cast("double").alias(out)
        return parse_number(F.col(name), dtypes[name]).alias(out)

    return [
        *[number(c, c) for c in PRICE_COLS],
        number(volume, "volume"),
        number(taker, "taker_base"),
    ]


def instant_of(name: str, dtype: T.DataType, unit: str | None) -> Column:
    """Time column to instant: an epoch in `unit`, or whatever `parse_instant` takes."""
    if unit and is_epoch(dtype):
        return from_epoch(F.col(name), unit, dtype)
    return parse_instant(F.col(name), dtype)


def normalize(raw: DataFrame) -> DataFrame:
    """Ticks of a table that carries `symbol`, `source_day` and one raw kline schema.

    Whether a day goes by `ts` and which unit its epochs have is decided day by day.
    Raises ValueError when required columns are absent.
    """
    keys = ["symbol", "source_day"]
    dtypes = {f.name: f.dataType for f in raw.schema.fields}
    alt = pick_alias(dtypes, TIME_ALIASES)
    if alt is None and "ts" not in dtypes:
        raise ValueError(NO_TIME_MESSAGE)
    if missing := missing_columns(dtypes):
        raise ValueError(MISSING_MESSAGE + ", ".join(missing))

    ts = parse_instant(F.col("ts"), dtypes["ts"]) if "ts" in dtypes else None
    epoch = F.col(alt) if alt and is_epoch(dtypes[alt]) else None
    if alt is None:
        time = ts
    elif ts is None and epoch is None:
        time = instant_of(alt, dtypes[alt], None)
    else:
        raw = raw.join(raw.groupBy(*keys).agg(*time_facts(ts, epoch)), keys)
        other = (
            instant_of(alt, dtypes[alt], None)
            if epoch is None
            else F.when(F.col("unit") == "ms", instant_of(alt, dtypes[alt], "ms")).otherwise(
                instant_of(alt, dtypes[alt], "s")
            )
        )
        time = other if ts is None else F.when(F.col("any_ts"), ts).otherwise(other)
    return (
        raw.select(
            *keys,
            time.alias("ts"),
            *tick_columns(
                dtypes, pick_alias(dtypes, VOLUME_ALIASES), pick_alias(dtypes, TAKER_ALIASES)
            ),
        )
        .where("ts IS NOT NULL")
        .select(*TICK_COLS)
    )
