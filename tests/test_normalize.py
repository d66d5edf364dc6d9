"""Names, instants and numbers of raw kline schemas."""

from datetime import date, datetime

import pytest

from tidebar.schema import TAKER_ALIASES, TIME_ALIASES, VOLUME_ALIASES
from tidebar.sources.normalize import missing_columns, normalize, pick_alias, time_facts

MS = 1704067200000
AT = datetime(2024, 1, 1)
PRICES = {"open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5}


def raw(spark, *rows, day=date(2024, 1, 1), types=None):
    """Rows of dicts as a table that carries symbol and source_day."""
    names = list(rows[0])
    types = types or {}
    schema = "symbol string, source_day date, " + ", ".join(
        f"{n} {types.get(n, 'double')}" for n in names
    )
    return spark.createDataFrame([("A", day, *[r[n] for n in names]) for r in rows], schema)


def row(**cols):
    return PRICES | {"volume": 3.0} | cols


@pytest.mark.parametrize("name", TIME_ALIASES)
def test_time_aliases_and_units(spark, name):
    for value in (MS, MS // 1000):
        got = normalize(raw(spark, row(**{name: value}), types={name: "bigint"})).first()
        assert got.ts == AT


@pytest.mark.parametrize("name", VOLUME_ALIASES)
def test_volume_aliases(spark, name):
    cols = PRICES | {name: 7.0, "open_time": MS}
    assert normalize(raw(spark, cols, types={"open_time": "bigint"})).first().volume == 7.0


@pytest.mark.parametrize("name", TAKER_ALIASES)
def test_taker_aliases(spark, name):
    got = normalize(raw(spark, row(open_time=MS, **{name: 2.0}), types={"open_time": "bigint"}))
    assert got.first().taker_base == 2.0


def test_first_present_name_wins_even_when_null(spark):
    cols = row(open_time=MS, taker_base=2.0, taker_buy_base_vol=None, base_volume=9.0)
    got = normalize(raw(spark, cols, types={"open_time": "bigint"})).first()
    assert (got.taker_base, got.volume) == (None, 3.0)
    assert pick_alias(["b", "a"], ["a", "b"]) == "a"
    assert pick_alias([], ["a"]) is None


def test_no_taker_column(spark):
    got = normalize(raw(spark, row(open_time=MS), types={"open_time": "bigint"})).first()
    assert got.taker_base is None


def test_ts_wins_over_open_time(spark):
    types = {"ts": "timestamp", "open_time": "bigint"}
    rows = [row(ts=AT, open_time=0), row(ts=None, open_time=MS)]
    assert [r.ts for r in normalize(raw(spark, *rows, types=types)).collect()] == [AT]


def test_all_null_ts_falls_through(spark):
    types = {"ts": "timestamp", "open_time": "bigint"}
    got = normalize(raw(spark, row(ts=None, open_time=MS), types=types))
    assert got.first().ts == AT


def test_ts_choice_is_made_per_day(spark):
    types = {"ts": "string", "open_time": "bigint"}
    a = raw(spark, row(ts="bad", open_time=MS), row(ts="2024-01-01", open_time=0), types=types)
    b = raw(spark, row(ts="bad", open_time=MS), day=date(2024, 1, 2), types=types)
    got = normalize(a.unionByName(b)).orderBy("source_day").collect()
    assert [(r.source_day.day, r.ts) for r in got] == [(1, AT), (2, AT)]


def test_integer_ts_is_nanoseconds(spark):
    got = normalize(raw(spark, row(ts=MS * 1_000_000), types={"ts": "bigint"}))
    assert got.first().ts == AT


def test_microsecond_epochs_give_no_rows(spark):
    got = normalize(raw(spark, row(open_time=MS * 1000), types={"open_time": "bigint"}))
    assert got.count() == 0


def test_float_epochs(spark):
    got = normalize(raw(spark, row(open_time=MS / 1000 + 0.25))).first()
    assert got.ts == datetime(2024, 1, 1, 0, 0, 0, 250000)


def test_text_alias_column(spark):
    types = {"timestamp": "string"}
    rows = [row(timestamp="2024-01-01 00:00:00"), row(timestamp="?")]
    assert [r.ts for r in normalize(raw(spark, *rows, types=types)).collect()] == [AT]


@pytest.mark.parametrize(
    "values,unit",
    [
        ([10, 10**11], "ms"),  # halves: the mean of the neighbours decides
        ([10, 10**10 + 1], "s"),
        ([10, 20, 10**11], "s"),
        ([10, 10**11, 10**11], "ms"),
        ([10**10], "s"),
        ([10**10 + 1], "ms"),
        ([None, None], "s"),
        ([None, 10**11], "ms"),
    ],
)
def test_unit_by_median(spark, values, unit):
    df = spark.createDataFrame([(v,) for v in values], "t bigint")
    assert df.agg(*time_facts(None, df.t)).first().unit == unit


def test_numbers_as_texts(spark):
    types = dict.fromkeys(["open", "high", "low", "close", "volume"], "string")
    cols = {"open": " 1.5 ", "high": "abc", "low": "1.0d", "close": "", "volume": "inf"}
    got = normalize(
        raw(spark, cols | {"open_time": MS}, types=types | {"open_time": "bigint"})
    ).first()
    assert (got.open, got.high, got.low, got.close, got.volume) == (
        1.5, None, None, None, float("inf"),
    )


def test_required_columns(spark):
    assert missing_columns(["open", "low", "base_volume"]) == ["high", "close"]
    assert missing_columns(["open", "high", "low", "close"]) == ["volume"]
    cols = {k: v for k, v in row(open_time=MS).items() if k != "close"}
    with pytest.raises(ValueError, match="close"):
        normalize(raw(spark, cols, types={"open_time": "bigint"}))
    with pytest.raises(ValueError, match="timestamp"):
        normalize(raw(spark, row()))


def test_nothing_runs_before_an_action(spark):
    df = raw(spark, row(open_time=MS), types={"open_time": "bigint"})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("normalize", "no job is meant to run")
    out = normalize(df)
    assert not tracker.getJobIdsForGroup("normalize")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.first().ts == AT
