"""The operators as queries over the given tables; `oracles.py` holds the same in SQL.

Ticks come from `events`: every event is a trade at price value + 1 (see `_TICK`).
Windows are shortened to the tables' density (see `DENSITY`, `BY_TYPE`).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.functions.scalars import finite_or_null, minute_floor, parse_number, safe_div
from tidebar.operators.bars import clip_to_day, day_bars, drop_null_ts, minute_bars, with_returns
from tidebar.operators.features import daily_regime_features
from tidebar.operators.report import (
    day_outcomes,
    first_days,
    input_coverage,
    requested_days,
    rows_per_day,
    status_counts,
)
from tidebar.operators.rolling import Roll, lag_n, rolling, zscore
from tidebar.operators.tail import fan_out, spread_blocks
from tidebar.plans.job import run_regime_features
from tidebar.schema import FEATURE_COLS, RegimeSpec
from tidebar.session import scratch_dir, use_utc
from tidebar.sources.calendar import calendar
from tidebar.sources.klines import scan_klines
from tidebar.sources.layout import day_files, pick_layout
from tidebar.sources.normalize import normalize
from tidebar.sources.stores import files_below, system_of

# About 299 minutes a day carry events at scale 0.01, and 65 of each event type.
DENSITY = RegimeSpec(short=12, day=299, week=2093, min_short=4, min_day=75, min_week=897)
BY_TYPE = RegimeSpec(short=12, day=65, week=500, min_short=4, min_day=16, min_week=195)

_PRICE = "value + 1D"
_VOLUME = "1D + event_id % 10"
_TAKER = "(1D + event_id % 10) * (event_id % 5) / 4D"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf}/events.parquet").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def _ticks(
    events: DataFrame,
    symbol: str = "'ALL'",
    day: str = "cast(ts AS date)",
    open: str = _PRICE,
    close: str = _PRICE,
    volume: str = _VOLUME,
    taker: str = _TAKER,
) -> DataFrame:
    return events.selectExpr(
        f"{symbol} AS symbol",
        f"{day} AS source_day",
        "ts",
        f"{open} AS open",
        f"{_PRICE} AS high",
        f"{_PRICE} AS low",
        f"{close} AS close",
        f"{volume} AS volume",
        f"{taker} AS taker_base",
    )


def _rounded(places: int, *cols: str) -> list[str]:
    return [f"round({c}, {places}) + 0D AS {c}" for c in cols]


def _feature_cols() -> list[str]:
    # trend24 is a return per second, some 1e-5: it needs more places.
    return [*_rounded(12, "trend24"), *_rounded(6, *FEATURE_COLS[1:])]


def _day_range(events: DataFrame) -> tuple[date, date]:
    row = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    return row[0], row[1]


# --- bars and returns -------------------------------------------------------------


def q_minute_bars(spark, sf):
    return minute_bars(_ticks(_events(spark, sf), "event_type"))


def q_bars_null_open_close(spark, sf):
    ticks = _ticks(
        _events(spark, sf),
        open=f"if(event_id % 3 = 0, NULL, {_PRICE})",
        close=f"if(event_id % 4 = 0, NULL, {_PRICE})",
        volume=f"if(event_id % 6 = 0, NULL, {_VOLUME})",
        taker="CAST(NULL AS double)",
    )
    return minute_bars(ticks)


def q_drop_null_ts(spark, sf):
    events = _events(spark, sf).withColumn("ts", F.expr("if(event_id % 7 = 0, NULL, ts)"))
    return (
        drop_null_ts(_ticks(events, day="DATE'2024-01-01'"))
        .groupBy(minute_floor(F.col("ts")).alias("minute"))
        .agg(F.count("*").alias("n"))
    )


def _returns(spark, sf, **columns):
    return with_returns(minute_bars(_ticks(_events(spark, sf), "event_type", **columns)))


def q_log_returns_by_day(spark, sf):
    return _returns(spark, sf).selectExpr("symbol", "source_day", "ts", *_rounded(9, "ret1m"))


def q_returns_sq_abs(spark, sf):
    return _returns(spark, sf).selectExpr(
        "symbol", "source_day", "ts", *_rounded(9, "ret2_1m", "absret1m")
    )


def q_zero_price_returns(spark, sf):
    close = "CASE WHEN event_id % 40 = 0 THEN 0D WHEN event_id % 41 = 0 THEN -value ELSE value END"
    return _returns(spark, sf, close=close).selectExpr(
        "symbol",
        "source_day",
        "ts",
        "CASE WHEN ret1m = double('infinity') THEN 'inf' "
        "WHEN ret1m = -double('infinity') THEN '-inf' ELSE 'finite' END AS kind",
        "CASE WHEN abs(ret1m) < double('infinity') THEN round(ret1m, 9) + 0D END AS ret1m",
    )


def q_day_clip(spark, sf):
    """Some rows lie outside their file's day: they take part in returns, not in bars."""
    day = (
        "CASE WHEN event_id % 11 = 0 THEN date_sub(cast(ts AS date), 1) "
        "ELSE cast(ts + INTERVAL 90 MINUTES AS date) END"
    )
    bars = day_bars(_ticks(_events(spark, sf), "event_type", day=day))
    return bars.selectExpr(
        "symbol", "source_day", "ts", "open", "high", "low", "close", "volume", "taker_base",
        *_rounded(9, "ret1m"),
    )


# --- rolling statistics -----------------------------------------------------------

_DAY_KEYS = ["symbol", "source_day"]


def _bars(spark, sf, symbol="'ALL'"):
    return day_bars(_ticks(_events(spark, sf), symbol))


def q_lag_n(spark, sf):
    bars = _bars(spark, sf, "event_type")
    return lag_n(bars, "close_back", "close", 7, _DAY_KEYS).select(
        *_DAY_KEYS, "ts", "close", "close_back"
    )


def _rolled(spark, sf, how: str, col: str):
    bars = _bars(spark, sf).withColumn("share", safe_div(F.col("taker_base"), F.col("volume")))
    rolls = [Roll("short", col, how, 12, 4), Roll("long", col, how, 120, 30)]
    return rolling(bars, rolls, _DAY_KEYS).selectExpr(
        *_DAY_KEYS, "ts", *_rounded(6, "short", "long")
    )


def q_rolling_sum_min(spark, sf):
    return _rolled(spark, sf, "sum", "ret2_1m")


def q_rolling_mean_min(spark, sf):
    return _rolled(spark, sf, "mean", "share")


def q_rolling_std_min(spark, sf):
    return _rolled(spark, sf, "std", "close")


def q_rolling_zscore(spark, sf):
    rv = rolling(_bars(spark, sf), [Roll("_v", "ret2_1m", "sum", 30, 10)], _DAY_KEYS)
    rv = rv.selectExpr("*", "sqrt(_v) AS rv")
    return zscore(rv, "z", "rv", 100, 40, _DAY_KEYS).selectExpr(
        *_DAY_KEYS, "ts", *_rounded(6, "rv", "z")
    )


# --- features ---------------------------------------------------------------------


def _one_feature(name: str):
    def query(spark, sf):
        return daily_regime_features(_bars(spark, sf), spec=DENSITY).selectExpr(
            "symbol", "date", "ts", *[c for c in _feature_cols() if c.endswith(f" {name}")]
        )

    return query


def q_regime_features_all(spark, sf):
    return daily_regime_features(_bars(spark, sf, "event_type"), spec=BY_TYPE).selectExpr(
        "symbol", "date", "ts", *_feature_cols()
    )


def q_regime_features_default_windows(spark, sf):
    return daily_regime_features(_bars(spark, sf)).selectExpr(
        "symbol", "date", "ts", *_feature_cols()
    )


def q_tail_truncated_features(spark, sf):
    """A shorter history and a bounded range of target days."""
    events = _events(spark, sf)
    first, last = _day_range(events)
    start, end = first + timedelta(days=5), last - timedelta(days=3)
    features = daily_regime_features(
        day_bars(_ticks(events)), start, end, tail_days=4, spec=DENSITY
    )
    return features.selectExpr("symbol", "date", "ts", *_feature_cols())


def q_tail_fanout(spark, sf):
    events = _events(spark, sf)
    first, last = _day_range(events)
    bars = day_bars(_ticks(events, "event_type"))
    return (
        fan_out(spread_blocks(bars, first, last))
        .groupBy("symbol", "target_day")
        .agg(
            F.count("*").alias("n_bars"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.sum("volume").alias("volume"),
        )
    )


# --- scalars and normalisation ----------------------------------------------------


def q_calendar(spark, sf):
    return calendar(spark, *_day_range(_events(spark, sf)))


def q_safe_div_null(spark, sf):
    return _events(spark, sf).select(
        "event_id",
        safe_div(F.col("value"), (F.col("event_id") % 4).cast("double")).alias("quotient"),
    )


def q_inf_cleanup(spark, sf):
    x = F.expr(
        "CASE event_id % 5 WHEN 0 THEN double('infinity') WHEN 1 THEN -double('infinity') "
        "WHEN 2 THEN double('nan') ELSE value END"
    )
    return _events(spark, sf).select("event_id", finite_or_null(x).alias("x"))


# Texts that a number column may hold, by event_id % 16.
NUMBER_TEXTS = [
    "' 7.25 '", "'abc'", "''", "'inf'", "'-inf'", "'nan'", "'1.0d'", "'1e3'",
    "'+4'", "'.5'", "'5.'", "'Infinity'", "'0x10'", "'1.5f'", "'-2.5E-3'",
]


def number_text_sql() -> str:
    whens = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(NUMBER_TEXTS))
    return f"CASE event_id % 16 {whens} ELSE concat(event_id, '.5') END"


def q_numeric_coerce(spark, sf):
    texts = _events(spark, sf).selectExpr("event_id", f"{number_text_sql()} AS t")
    return texts.select(
        "event_id",
        parse_number(F.col("t"), T.StringType()).alias("number"),
        parse_number(F.col("event_id"), T.LongType()).alias("from_int"),
    )


_RAW_PRICES = [f"{_PRICE} AS {c}" for c in ("open", "high", "low", "close")]


def q_epoch_unit_detect(spark, sf):
    """Seconds on even days, milliseconds on odd ones; every seventh day mixes both."""
    raw = _events(spark, sf).selectExpr(
        "event_type AS symbol",
        "cast(ts AS date) AS source_day",
        "CASE WHEN if(day(ts) % 7 = 0, event_id, day(ts)) % 2 = 0 "
        "THEN unix_seconds(ts) ELSE unix_millis(ts) END AS open_time",
        *_RAW_PRICES,
        f"{_VOLUME} AS volume",
    )
    return (
        normalize(raw)
        .groupBy("symbol", "source_day")
        .agg(
            F.count("*").alias("n"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


def q_ts_resolution(spark, sf):
    """`ts` wins where any of the day's values parses, else the epoch column counts."""
    raw = _events(spark, sf).selectExpr(
        "'ALL' AS symbol",
        "cast(ts AS date) AS source_day",
        "CASE WHEN day(ts) % 3 = 0 THEN 'none' WHEN event_id % 5 = 0 THEN 'bad' "
        "ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') END AS ts",
        "unix_millis(ts) + 3600000 AS startTime",
        "event_id + 0D AS open",
        *_RAW_PRICES[1:],
        f"{_VOLUME} AS volume",
    )
    return normalize(raw).select("source_day", "ts", "open")


def q_alias_pick(spark, sf):
    """The first name present is taken, even where another one has the value."""
    raw = _events(spark, sf).selectExpr(
        "event_type AS symbol",
        "cast(ts AS date) AS source_day",
        "ts AS timestamp",
        "unix_millis(ts) AS openTimeMs",
        *_RAW_PRICES,
        f"if(event_id % 2 = 0, {_VOLUME}, NULL) AS volume",
        "1000D AS base_volume",
        "2000D AS takerBuyBase",
        f"{_TAKER} AS taker_buy_base_vol",
    )
    return minute_bars(normalize(raw)).select(
        "symbol", "source_day", "ts", "close", "volume", "taker_base"
    )


def q_taker_default(spark, sf):
    """No taker column: its sums are 0, its share 0 and its imbalance -1."""
    raw = _events(spark, sf).selectExpr(
        "event_type AS symbol", "cast(ts AS date) AS source_day", "ts",
        *_RAW_PRICES, f"{_VOLUME} AS base_volume",
    )
    bars = minute_bars(normalize(raw))
    taker, volume = F.col("taker_base"), F.col("volume")
    return bars.select(
        "symbol",
        "source_day",
        "ts",
        "taker_base",
        safe_div(taker, volume).alias("share"),
        safe_div(2 * taker - volume, volume).alias("imbalance"),
    )


def q_union_by_name(spark, sf):
    events = _events(spark, sf)
    old = events.where("event_id % 2 = 0").selectExpr("event_id", "value AS open")
    new = events.where("event_id % 2 = 1").selectExpr(
        "value + 1D AS open", f"{_TAKER} AS taker_base", "event_id"
    )
    return old.unionByName(new, allowMissingColumns=True)


# --- files ------------------------------------------------------------------------

_ARCHIVES: dict[tuple, str] = {}

# Days of the month that the archive leaves out, or writes without `close`.
GAP_DAY, BAD_DAY = 22, 13
FILE_SPLITS = 4


def kline_archive(spark: SparkSession, sf: str, whole: bool = False) -> str:
    """The ticks as daily files whose folder, names, types and units vary by day; all of
    them if `whole`, else without `GAP_DAY` and with `BAD_DAY` spoilt.

    By day of month modulo 5: 1 standard under `date=`; 2 seconds and other names under
    `dt=`; 3 both folders, of which `date=` counts; 4 texts under `date=D/h=H/`;
    0 an instant column and no taker volume under `dt=D/h=H/`.
    """
    key = (spark.sparkContext.applicationId, sf, whole)
    if key in _ARCHIVES:
        return _ARCHIVES[key]
    out = scratch_dir(spark, "archive")
    gap, bad = (0, 0) if whole else (GAP_DAY, BAD_DAY)
    events = _events(spark, sf)
    first, last = _day_range(events)
    # A day is split over several tasks, each of which gives one file per folder. A write
    # covers every fifth day.
    split = F.expr(
        f"(datediff(date, DATE'{first}') DIV 5) * {FILE_SPLITS} + event_id % {FILE_SPLITS}"
    ).cast("int")
    n_splits = ((last - first).days // 5 + 1) * FILE_SPLITS
    events = events.where(f"day(ts) <> {gap}").selectExpr(
        "*", "cast(ts AS date) AS date", "cast(ts AS date) AS dt", "hour(ts) DIV 12 AS h"
    )
    prices = [c.replace(_PRICE, f"CAST({_PRICE} AS string)") for c in _RAW_PRICES]
    std = ["unix_millis(ts) AS open_time", *_RAW_PRICES, f"{_VOLUME} AS volume"]
    taker = f"{_TAKER} AS taker_buy_base_asset_volume"

    def write(when: str, cols: list[str], *parts: str) -> None:
        rows = events.where(when).repartitionById(n_splits, split).selectExpr(*cols, *parts)
        rows.write.partitionBy(*parts).mode("append").parquet(out)

    good = f"day(ts) % 5 = {{}} AND day(ts) <> {bad}"
    write(good.format(1), [*std, taker], "date")
    write(
        good.format(2),
        ["unix_seconds(ts) AS openTime", *_RAW_PRICES, f"{_VOLUME} AS base_volume",
         f"{_TAKER} AS takerBuyBase"],
        "dt",
    )
    write(good.format(3), [*std, taker], "date")
    write(good.format(3), [*[c.replace(_PRICE, "999D") for c in std], taker], "dt")
    write(
        good.format(4),
        ["unix_millis(ts) AS timestamp", *prices, f"CAST({_VOLUME} AS string) AS volume",
         f"{_TAKER} AS taker_base"],
        "date", "h",
    )
    write(good.format(0), ["ts", *_RAW_PRICES, f"{_VOLUME} AS volume"], "dt", "h")
    write(f"day(ts) = {bad}", [c for c in std if not c.endswith(" close")], "date")
    _ARCHIVES[key] = out
    return out


def _plain_archive(spark: SparkSession, sf: str, kind: str) -> str:
    """The ticks in one schema, under folders of one kind.

    `uniform`: `date=D/`; `bare`: `D/`; `nested`: `dt=D/h=H/`; `symbols`: a folder per event
    type; `texts`: as `uniform` with instants as texts, in a form that varies by day; `schemas`: as
    `uniform`, but each day has files of two schemas; `runs`: the same schemas by turns, each for
    some days.
    """
    key = (spark.sparkContext.applicationId, sf, kind)
    if key in _ARCHIVES:
        return _ARCHIVES[key]
    out = scratch_dir(spark, f"archive-{kind}")
    time = "unix_millis(ts) AS open_time"
    if kind == "texts":
        forms = "array({})".format(", ".join(f'"{f}"' for f in TEXT_FORMS))
        time = f"date_format(ts, {forms}[day(ts) % {len(TEXT_FORMS)}]) AS timestamp"
    if kind in ("schemas", "runs"):
        out = _two_schemas(_events(spark, sf), out, "event_id" if kind == "schemas" else "(day(ts) DIV 7)")
        _ARCHIVES[key] = out
        return out
    parts = {
        "nested": ["cast(ts AS date) AS dt", "hour(ts) DIV 12 AS h"],
        "symbols": ["event_type AS symbol", "cast(ts AS date) AS date"],
    }.get(kind, ["cast(ts AS date) AS date"])
    rows = _events(spark, sf).selectExpr(
        time, *_RAW_PRICES, f"{_VOLUME} AS volume", f"{_TAKER} AS taker_base", *parts
    )
    rows.write.partitionBy(*(p.split(" AS ")[-1] for p in parts)).parquet(out)
    if kind == "bare":
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for entry in fs.listStatus(path(out)):
            name = entry.getPath().getName()
            if name.startswith("date="):
                fs.rename(entry.getPath(), path(out, name[len("date=") :]))
    _ARCHIVES[key] = out
    return out


def _two_schemas(events: DataFrame, out: str, number: str) -> str:
    """Events of even number without a taker volume and with prices as texts, odd ones with
    columns in another order and volumes as integers."""
    day = "cast(ts AS date) AS date"
    prices = [c.replace(_PRICE, f"CAST({_PRICE} AS string)") for c in _RAW_PRICES]
    old = ["unix_millis(ts) AS open_time", *prices, f"{_VOLUME} AS volume", day]
    new = [f"{_TAKER} AS taker_base", f"CAST({_VOLUME} AS int) AS volume", *_RAW_PRICES[::-1], "unix_millis(ts) AS open_time", day]
    for odd, columns in ((0, old), (1, new)):
        rows = events.where(f"{number} % 2 = {odd}").selectExpr(*columns)
        rows.write.partitionBy("date").mode("append").parquet(out)
    return out


#: Forms of an instant to the second, by day of month.
TEXT_FORMS = [
    "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyyMMdd HH:mm:ss", "dd MMM yyyy HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss", "MMMM d, yyyy HH:mm:ss", "dd.MM.yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss",
    "MM/dd/yyyy hh:mm:ss a", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "dd-MM-yyyy HH:mm:ss Z",
]


def _scan(spark, sf, whole=False):
    first, last = _day_range(_events(spark, sf))
    archive = kline_archive(spark, sf, whole)
    return scan_klines(spark, archive, ["ALL"], first, last, scratch_dir(spark, "scan"))


def _plain_scan(spark, sf, kind):
    events = _events(spark, sf)
    root, symbols = _plain_archive(spark, sf, kind), ["ALL"]
    if kind == "symbols":
        root += "/symbol={symbol}"
        symbols = [r.event_type for r in events.select("event_type").distinct().collect()]
    first, last = _day_range(events)
    return _by_minute(scan_klines(spark, root, symbols, first, last, scratch_dir(spark, "scan")).ticks)


def q_scan_hive_uniform(spark, sf):
    return _plain_scan(spark, sf, "uniform")


def q_scan_two_schemas(spark, sf):
    """Files of one day that differ in columns and types are united by name."""
    return _plain_scan(spark, sf, "schemas")


def q_scan_schema_runs(spark, sf):
    """Days of one schema and of another are each found by a filter on their folders."""
    return _plain_scan(spark, sf, "runs")


def q_scan_bare_days(spark, sf):
    return _plain_scan(spark, sf, "bare")


def q_scan_nested(spark, sf):
    return _plain_scan(spark, sf, "nested")


def q_scan_many_symbols(spark, sf):
    return _plain_scan(spark, sf, "symbols")


def q_ts_text_formats(spark, sf):
    return _plain_scan(spark, sf, "texts")


def q_layout_pick(spark, sf):
    first, last = _day_range(_events(spark, sf))
    files = day_files(spark, kline_archive(spark, sf), ["ALL"], first, last)
    return pick_layout(files).groupBy("day", "layout").agg(F.count("*").alias("n_files"))


def q_scan_ticks(spark, sf):
    return _by_minute(_scan(spark, sf, whole=True).ticks)


def _by_minute(ticks: DataFrame) -> DataFrame:
    return (
        ticks.groupBy("symbol", "source_day", minute_floor(F.col("ts")).alias("minute"))
        .agg(
            F.count("*").alias("n"),
            F.sum("close").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("taker_base").alias("taker_base"),
        )
        .selectExpr(
            "symbol", "source_day", "minute", "n", *_rounded(6, "close"), "volume", "taker_base"
        )
    )


def q_rejected_days(spark, sf):
    return _scan(spark, sf).rejected


def q_input_coverage(spark, sf):
    return input_coverage(_scan(spark, sf).inputs)


def _run_job(spark, sf, archive):
    """The whole job over an archive, up to ten days past its end.

    Days kept in seconds hold several events per instant, hence the tie-break.
    """
    first, last = _day_range(_events(spark, sf))
    out = scratch_dir(spark, "out")
    report = run_regime_features(
        spark,
        archive,
        ["ALL"],
        f"{out}/features",
        f"{out}/bars",
        start=first,
        end=last + timedelta(days=10),
        spec=DENSITY,
        tie_break=True,
    )
    return report, spark.read.parquet(f"{out}/features"), spark.read.parquet(f"{out}/bars")


def q_status_report(spark, sf):
    return _run_job(spark, sf, kline_archive(spark, sf))[0]


def q_regime_job(spark, sf):
    return _run_job(spark, sf, kline_archive(spark, sf, whole=True))[1].selectExpr("symbol", "date", "ts", *_feature_cols())


def q_bar_sink(spark, sf):
    return _run_job(spark, sf, kline_archive(spark, sf, whole=True))[2].selectExpr(
        "symbol", "date", "ts", "open", "high", "low", "close", "volume", "taker_base",
        *_rounded(9, "ret1m", "ret2_1m", "absret1m"),
    )


def q_status_unreadable_file(spark, sf):
    """One file of `BAD_DAY` is garbage: the days that see it are errors, all others done."""
    report = _run_job(spark, sf, _spoilt_archive(spark, sf, "garbage"))[0]
    return report.select("symbol", "day", "status", "n_feat_rows")


def q_status_damaged_page(spark, sf):
    """The files of `BAD_DAY` have good footers over pages that cannot be decoded."""
    report = _run_job(spark, sf, _spoilt_archive(spark, sf, "pages"))[0]
    return report.select("symbol", "day", "status", "n_feat_rows")


def q_damaged_page_features(spark, sf):
    """Features of the days that do not see the damaged day."""
    features = _run_job(spark, sf, _spoilt_archive(spark, sf, "pages"))[1]
    return features.selectExpr("symbol", "date", "ts", *_feature_cols())


def _spoilt_archive(spark: SparkSession, sf: str, kind: str) -> str:
    """A plain archive in which files of `BAD_DAY` are spoilt: one of `garbage`, or all `pages`."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _ARCHIVES:
        out = scratch_dir(spark, f"archive-{kind}")
        rows = _events(spark, sf).selectExpr(
            "unix_millis(ts) AS open_time", *_RAW_PRICES, f"{_VOLUME} AS volume", "cast(ts AS date) AS date"
        )
        rows.write.partitionBy("date").parquet(out)
        bad = rows.where(f"day(date) = {BAD_DAY}").select("date").distinct()
        spoil = {"garbage": _add_garbage, "pages": _spoil_pages}[kind]
        bad.foreach(lambda row: spoil(f"{out}/date={row.date}"))
        _ARCHIVES[key] = out
    return _ARCHIVES[key]


def _add_garbage(folder: str) -> None:
    system, inner = system_of(f"{folder}/garbage.parquet")
    with system.open_output_stream(inner) as f:
        f.write(b"this is no Parquet file")


def _spoil_pages(folder: str) -> None:
    """Overwrite all that lies before the footers of a folder's files."""
    for name, _ in files_below(folder):
        system, inner = system_of(f"{folder}/{name}")
        with system.open_input_file(inner) as f:
            whole = f.read()
        tail = 8 + int.from_bytes(whole[-8:-4], "little")
        with system.open_output_stream(inner) as f:
            f.write(whole[:4] + b"\xff" * (len(whole) - tail - 4) + whole[-tail:])


# --- report -----------------------------------------------------------------------


def _report(spark, sf):
    """A report per event type, whose files are missing or bad on some days."""
    events = _events(spark, sf)
    first, last = _day_range(events)
    days = events.selectExpr("event_type AS symbol", "cast(ts AS date) AS day", "ts")
    symbols = [r.event_type for r in events.select("event_type").distinct().collect()]
    present = days.where("NOT (symbol = 'click' AND day(day) > 9)")
    counts = rows_per_day(
        present.where("symbol <> 'error' OR day(day) <> 12").withColumnRenamed(
            "day", "source_day"
        ),
        "source_day",
        "n_bars",
    )
    rejected = (
        present.where("symbol = 'error' AND day(day) = 12")
        .select("symbol", "day")
        .distinct()
        .selectExpr("symbol", "day", "'missing required columns: close' AS error")
    )
    return day_outcomes(
        requested_days(calendar(spark, first, last), symbols),
        counts,
        rows_per_day(present, "day", "n_files"),
        rejected,
    )


def q_status_by_symbol(spark, sf):
    return _report(spark, sf)


def q_status_counts(spark, sf):
    return status_counts(_report(spark, sf))


def q_first_no_data_days(spark, sf):
    return first_days(_report(spark, sf), "no_data", 20).select("symbol", "day", "status")


def q_first_ok_days(spark, sf):
    """Fewer days than there are."""
    return first_days(_report(spark, sf), "ok", 7).select("symbol", "day", "status", "n_feat_rows")


def q_rows_per_day(spark, sf):
    return rows_per_day(_bars(spark, sf, "event_type"), "source_day", "n_feat_rows")


def q_clip_to_day(spark, sf):
    ticks = _ticks(_events(spark, sf), day="cast(ts + INTERVAL 6 HOURS AS date)")
    return clip_to_day(ticks).groupBy("source_day").agg(F.count("*").alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {n[2:]: f for n, f in globals().items() if n.startswith("q_")}
    return named | {f: _one_feature(f) for f in FEATURE_COLS}
