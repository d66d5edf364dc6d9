"""Bars, returns and their resets."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import by

from tidebar.operators.bars import clip_to_day, day_bars, minute_bars, with_returns
from tidebar.schema import BAR_COLS

D = date(2024, 1, 2)
T0 = datetime(2024, 1, 2)
SCHEMA = (
    "symbol string, source_day date, ts timestamp, open double, high double, low double, "
    "close double, volume double, taker_base double"
)


def tick(seconds, close, day=D, symbol="A", **other):
    row = {"open": close, "high": close, "low": close, "volume": 1.0, "taker_base": 0.5} | other
    at = None if seconds is None else T0 + timedelta(seconds=seconds)
    return (symbol, day, at, row["open"], row["high"], row["low"], close, row["volume"],
            row["taker_base"])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_first_and_last_skip_nulls_and_empty_sums_are_zero(spark):
    rows = [
        tick(0, 1.0, open=None),
        tick(1, 5.0, volume=None),
        tick(2, None, open=9.0, high=None),
        tick(60, None, open=None, high=None, low=None, volume=None, taker_base=None),
        tick(None, 7.0),
    ]
    got = by(minute_bars(frame(spark, rows)), "ts")
    assert [r[3:] for r in got] == [
        (5.0, 5.0, 1.0, 5.0, 2.0, 1.5),
        (None, None, None, None, 0.0, 0.0),
    ]


def test_empty_minutes_make_no_bar(spark):
    assert minute_bars(frame(spark, [tick(0, 1.0), tick(600, 2.0)])).count() == 2


def test_returns_restart_every_source_day(spark):
    rows = [tick(-60, 8.0, day=D - timedelta(days=1)), tick(0, 1.0), tick(60, math.e)]
    got = by(with_returns(minute_bars(frame(spark, rows))).select("ret1m"), "ts")
    assert [r[0] for r in got] == [0.0, 0.0, 1.0]


def test_null_close_blanks_two_returns(spark):
    rows = [tick(0, 1.0), tick(60, None, open=1.0), tick(120, 5.0), tick(180, 5.0 * math.e)]
    got = by(day_bars(frame(spark, rows)).select("ret1m"), "ts")
    assert [round(r[0], 12) for r in got] == [0.0, 0.0, 0.0, 1.0]


def test_zero_and_negative_closes(spark):
    rows = [tick(60 * i, c) for i, c in enumerate([1.0, 0.0, 0.0, 1.0, -1.0, 1.0])]
    got = by(day_bars(frame(spark, rows)).select("ret1m", "ret2_1m", "absret1m"), "ts")
    inf = math.inf
    assert [r[0] for r in got] == [0.0, -inf, 0.0, inf, 0.0, 0.0]
    assert got[1][1:] == (inf, inf)


def test_opposite_infinite_volumes_are_missing(spark):
    rows = [tick(0, 1.0, volume=math.inf), tick(1, 1.0, volume=-math.inf)]
    assert minute_bars(frame(spark, rows)).first().volume is None


def test_stray_rows_feed_returns_but_make_no_bar(spark):
    rows = [
        tick(-7200, 100.0),
        tick(-30, math.e),
        tick(-20, None),
        tick(0, math.e**3),
        tick(86400, 5.0),
    ]
    got = by(day_bars(frame(spark, rows)).select("ts", "close", "ret1m"), "ts")
    assert len(got) == 1 and got[0][0] == T0
    assert got[0][2] == pytest.approx(2.0)


def test_last_stray_minute_without_close_gives_no_return(spark):
    rows = [tick(-120, math.e), tick(-30, None), tick(0, math.e**3)]
    assert day_bars(frame(spark, rows)).first().ret1m == 0.0


def test_day_bars_equal_the_unbounded_way(spark):
    rng = random.Random(7)
    rows = [
        tick(
            rng.randrange(-90_000, 180_000) + i / 1e5,
            rng.choice([None, 0.0, -1.0, rng.uniform(1, 9), rng.uniform(1, 9)]),
            day=D + timedelta(days=rng.randrange(-1, 2)),
            symbol=rng.choice("AB"),
            open=rng.choice([None, 2.0]),
        )
        for i in range(4000)
    ]
    ticks = frame(spark, rows).repartition(5)
    plain = clip_to_day(with_returns(minute_bars(ticks))).select(*BAR_COLS)
    assert by(day_bars(ticks), *BAR_COLS[:3]) == by(plain, *BAR_COLS[:3])


def test_volume_is_preserved_and_prices_ordered(spark):
    rng = random.Random(3)
    rows = [tick(rng.randrange(86_400) + i / 1e5, rng.uniform(1, 9)) for i in range(2000)]
    bars = minute_bars(frame(spark, rows))
    assert bars.agg(F.sum("volume")).first()[0] == 2000.0
    assert bars.where("high < greatest(open, close) OR low > least(open, close)").count() == 0


def test_tie_break_is_independent_of_partitioning(spark):
    rows = [tick(0, float(c)) for c in range(50)]
    for n in (1, 7):
        row = minute_bars(frame(spark, rows).repartition(n), tie_break=True).first()
        assert (row.open, row.close) == (0.0, 49.0)


def test_ties_go_by_price_among_rows_of_the_outer_instants(spark):
    rng = random.Random(8)
    prices = [None, 0.0, -0.0, -2.5, 1.0, math.nextafter(1.0, 2.0), 5e-324, 1e300, math.inf, -math.inf]
    rows = [
        tick(rng.randrange(-3, 240) // 4 * 4, rng.choice(prices), symbol=rng.choice("AB"), open=rng.choice(prices))
        for _ in range(900)
    ]
    got = by(minute_bars(frame(spark, rows).repartition(6), tie_break=True).select("symbol", "ts", "open", "close"), "symbol", "ts")
    want = {}
    for r in rows:
        want.setdefault((r[0], r[2].replace(second=0)), []).append(r)
    for symbol, ts, first, last in got:
        own = want.pop((symbol, ts))
        assert first == min((r[2], r[3]) for r in own if r[3] is not None)[1]
        assert last == max((r[2], r[6]) for r in own if r[6] is not None)[1]
    assert not want


def test_plain_bars_use_hash_aggregation(spark):
    plan = day_bars(frame(spark, [tick(0, 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_window_groups_stay_bounded(spark):
    """Many stray rows of one source day collapse into one carried row."""
    rows = [tick(-60 * i - 60, 2.0) for i in range(3000)] + [tick(0, 2.0 * math.e)]
    got = day_bars(frame(spark, rows))
    assert got.count() == 1
    assert got.first().ret1m == pytest.approx(1.0)
