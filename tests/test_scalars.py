"""Numbers, instants and logs at their edges."""

import math
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.functions.scalars import (
    finite_or_null,
    from_epoch,
    in_day,
    ln_ieee,
    minute_floor,
    parse_instant,
    parse_number,
    safe_div,
)


def column(spark, values, dtype, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_number_texts(spark):
    texts = [" 1.5 ", "abc", "", "1.0d", "1.0f", "-inf", "nan", "1e3", ".5", "5.", "0x10", None]
    got = column(spark, texts, "string", lambda c: parse_number(c, T.StringType()))
    assert got == [1.5, None, None, None, None, -math.inf, None, 1e3, 0.5, 5.0, None, None]


def test_numbers_of_other_types(spark):
    nan = float("nan")
    assert column(spark, [1.0, nan], "double", lambda c: parse_number(c, T.DoubleType())) == [
        1.0,
        None,
    ]
    assert column(spark, [7], "bigint", lambda c: parse_number(c, T.LongType())) == [7.0]


def test_ln_ieee(spark):
    got = column(spark, [math.e, 0.0, -1.0, math.inf], "double", ln_ieee)
    assert got == [1.0, -math.inf, None, math.inf]


def test_finite_or_null(spark):
    got = column(spark, [1.0, math.inf, -math.inf, math.nan, None], "double", finite_or_null)
    assert got == [1.0, None, None, None, None]


def test_safe_div_under_ansi(spark):
    assert column(spark, [0.0, 4.0], "double", lambda c: safe_div(F.lit(2.0), c)) == [None, 0.5]


def test_epochs(spark):
    at = datetime(2024, 1, 1)
    for unit, value in {"s": 1704067200, "ms": 1704067200000, "ns": 1704067200000000000}.items():
        got = column(
            spark, [value, None], "bigint", lambda c, u=unit: from_epoch(c, u, T.LongType())
        )
        assert got == [at, None]
        got = column(
            spark, [float(value)], "double", lambda c, u=unit: from_epoch(c, u, T.DoubleType())
        )
        assert got == [at]


def test_out_of_range_epochs_are_null(spark):
    micros = 1704067200000000
    assert column(spark, [micros], "bigint", lambda c: from_epoch(c, "ms", T.LongType())) == [None]
    assert column(spark, [2**62], "bigint", lambda c: from_epoch(c, "s", T.LongType())) == [None]
    assert column(spark, [1e300], "double", lambda c: from_epoch(c, "s", T.DoubleType())) == [None]


def test_negative_nanoseconds_round_down(spark):
    got = column(
        spark, [-1500], "bigint", lambda c: F.unix_micros(from_epoch(c, "ns", T.LongType()))
    )
    assert got == [-2]


def test_instant_texts(spark):
    texts = ["2024-01-01", "2024-01-01T00:00:00Z", "2024-01-01 02:00:00+02:00", "12:30", "x", None]
    got = column(spark, texts, "string", lambda c: parse_instant(c, T.StringType()))
    assert got == [datetime(2024, 1, 1)] * 3 + [None] * 3


def test_minute_floor_before_1970(spark):
    got = column(
        spark, [-1], "bigint", lambda c: F.unix_seconds(minute_floor(F.timestamp_seconds(c)))
    )
    assert got == [-60]


def test_in_day_is_half_open_and_utc_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = column(
            spark,
            [1704067199, 1704067200, 1704153599, 1704153600],
            "bigint",
            lambda c: in_day(F.timestamp_seconds(c), F.lit("2024-01-01").cast("date")),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [False, True, True, False]
