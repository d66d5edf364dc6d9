"""The batch job: daily kline files in, minute bars and regime features out."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebar.operators.bars import bars_of, counted_bars, rows_met
from tidebar.operators.features import daily_regime_features
from tidebar.operators.report import day_outcomes, requested_days, rows_per_day
from tidebar.operators.sink import write_daily, write_empty_days
from tidebar.schema import BAR_SCHEMA, FEATURE_SCHEMA, RegimeSpec
from tidebar.session import drop_path, materialize, scratch_dir, utc
from tidebar.sources.calendar import as_date, calendar
from tidebar.sources.klines import KlineScan, scan_klines, short_days


def run_regime_features(
    spark: SparkSession,
    in_path: str,
    symbols: list[str] | str,
    out_features: str,
    out_bars: str | None = None,
    *,
    start: str | date,
    end: str | date,
    tail_days: int = 7,
    spec: RegimeSpec = RegimeSpec(),
    tie_break: bool = False,
) -> DataFrame:
    """Write the features (and, if asked, the minute bars) of every day in `[start, end]`
    and return the run report, one row per symbol and day.

    Raw files are read once: the bars, a sixtieth of them, are kept in the shared folder
    and feed the features, the bar output and the report alike. A day of which not all rows
    can be decoded is an error, as are the days that see it.
    """
    symbols = [symbols] if isinstance(symbols, str) else list(symbols)
    start, end = as_date(start), as_date(end)
    if tail_days < 0:
        raise ValueError("tail_days must not be negative")
    requested = requested_days(calendar(spark, start, end), symbols)
    scratch = scratch_dir(spark, "regime-job")
    work = f"{scratch}/work"
    with utc(spark):
        try:
            since = start - timedelta(days=tail_days)
            scan = scan_klines(spark, in_path, symbols, since, end, work)
            counted = materialize(counted_bars(scan.rows, tie_break), f"{work}/bars")
            bars = bars_of(counted)
            counts = rows_per_day(bars, "source_day", "n_bars")
            failures = scan.rejected.unionByName(short_days(scan, rows_met(counted)))
            failures = failures.unionByName(_silent(scan, counts).join(failures, ["symbol", "day"], "left_anti"))
            outcomes = day_outcomes(requested, counts, scan.inputs, failures, tail_days)
            report = materialize(outcomes, f"{scratch}/report")
            failed = report.where("status = 'error'").select("symbol", F.col("day").alias("date"))
            failed = None if failed.isEmpty() else failed
            features = daily_regime_features(bars, start, end, tail_days, spec, n_bars=bars.count())
            write_daily(_without(features, failed), out_features, failed is None)
            empty = report.where("status = 'ok' AND n_feat_rows = 0").selectExpr("symbol", "day AS date")
            write_empty_days(FEATURE_SCHEMA, out_features, empty)
            if out_bars:
                wanted = bars.where(F.col("source_day").between(F.lit(start), F.lit(end)))
                write_daily(_without(wanted.withColumnRenamed("source_day", "date"), failed), out_bars)
                write_empty_days(BAR_SCHEMA.replace("source_day", "date"), out_bars, empty)
        finally:
            drop_path(spark, work)
    return report


def _silent(scan: KlineScan, counts: DataFrame) -> DataFrame:
    """Days whose time column holds texts, none of which gave a bar: an error, so that what
    an earlier run wrote stays."""
    silent = scan.texts.join(counts.withColumnRenamed("source_day", "day"), ["symbol", "day"], "left_anti")
    error = F.concat(F.lit("no instant of the day in any of "), "n_texts", F.lit(" texts"))
    return silent.select("symbol", "day", error.alias("error"))


def _without(df: DataFrame, failed: DataFrame | None) -> DataFrame:
    """`df` less the failed days."""
    return df if failed is None else df.join(failed, ["symbol", "date"], "left_anti")
