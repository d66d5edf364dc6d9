"""Rolling statistics: running totals against sliding frames and pandas."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from tidebar.operators.rolling import Reach, Roll, lag_n, rolling, zscore

KEYS = ["g"]


def series():
    """Named series with gaps, infinities, outliers, constants and zeros."""
    rng = random.Random(11)
    n = 240
    noise = [rng.gauss(0, 1) for _ in range(n)]
    return {
        "noise": noise,
        "gaps": [None if rng.random() < 0.4 else x for x in noise],
        "inf": [math.inf if i % 50 == 7 else (-math.inf if i % 50 == 9 else x)
                for i, x in enumerate(noise)],
        "outlier": [1e12 if i == 30 else abs(x) for i, x in enumerate(noise)],
        "constant": [0.1] * n,
        "steps": [0.1 if i < 90 else 0.3 for i in range(n)],
        "zeros": [0.0 if i > 60 else x for i, x in enumerate(noise)],
        "tiny": [x * 1e-150 for x in noise],
        "large": [x * 1e150 for x in noise],
        "empty": [None] * n,
    }


def frame(spark, data):
    rows = [(g, i, x) for g, xs in data.items() for i, x in enumerate(xs)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, ts int, x double").repartition(3)


ROLLS = [
    Roll(f"{how}{w}", "x", how, w, m)
    for how in ("sum", "mean", "std")
    for w, m in ((1, 1), (5, 2), (70, 20), (100, 100), (200, 1))
]


def expected(xs, roll):
    s = pd.Series(xs, dtype="float64").replace([np.inf, -np.inf], np.nan)
    out = []
    for i in range(len(s)):  # plain evaluation of each frame, exactly summed
        seen = s.iloc[max(0, i - roll.rows + 1) : i + 1].dropna().tolist()
        n = len(seen)
        if n < roll.min_obs or (roll.how == "std" and n < 2):
            out.append(None)
        elif roll.how == "sum":
            out.append(math.fsum(seen))
        elif roll.how == "mean":
            out.append(math.fsum(seen) / n)
        else:
            mid = math.fsum(seen) / n
            out.append(
                0.0
                if len(set(seen)) == 1
                else math.sqrt(math.fsum((x - mid) ** 2 for x in seen) / (n - 1))
            )
    return out


@pytest.mark.parametrize("method", ["running", "auto"])
def test_against_brute_force(spark, method):
    data = series()
    got = rolling(frame(spark, data), ROLLS, KEYS, method=method).toPandas()
    for g, xs in data.items():
        part = got[got.g == g].sort_values("ts")
        for roll in ROLLS:
            # Squares of 1e150 leave the range of doubles.
            if roll.how == "std" and g in ("large", "tiny"):
                continue
            want = pd.Series(expected(xs, roll), dtype="float64")
            have = part[roll.out].reset_index(drop=True)
            assert (want.isna() == have.isna()).all(), (g, roll)
            scale = want.abs().fillna(0)
            floor = 1e-13 if g == "noise" or g in ("gaps", "inf", "zeros") else 0.0
            assert ((want - have).abs().fillna(0) <= 1e-10 * scale + floor).all(), (g, roll)


def test_sliding_frames_agree(spark):
    data = {g: xs for g, xs in series().items() if g in ("noise", "gaps", "inf", "zeros")}
    df = frame(spark, data)
    a = rolling(df, ROLLS, KEYS, method="frame").toPandas()
    b = rolling(df, ROLLS, KEYS, method="running").toPandas()
    both = a.merge(b, on=["g", "ts"])
    for r in ROLLS:
        x, y = both[f"{r.out}_x"], both[f"{r.out}_y"]
        assert (x.isna() == y.isna()).all()
        assert np.allclose(x.fillna(0), y.fillna(0), rtol=1e-9, atol=1e-9)


def test_small_sums_survive_a_passing_outlier(spark):
    """1e12 passes through; a plain difference of running doubles would lose 4 digits."""
    xs = [1e-4] * 10 + [1e12] + [1e-4] * 400
    roll = Roll("s", "x", "sum", 100, 1)
    got = rolling(frame(spark, {"a": xs}), [roll], KEYS, method="running").orderBy("ts").collect()
    assert got[-1].s == pytest.approx(0.01, rel=1e-9)


def test_totals_of_more_rows_than_the_split_was_made_for(spark):
    """Nine million multiples of some 2^40 would overflow a BIGINT."""
    n, w = 9_000_000, 1000
    df = spark.range(n).selectExpr("'a' AS g", "id AS ts", "1D - (id % 7) / 1024D AS x")
    out = rolling(df, [Roll("s", "x", "sum", w, 1), Roll("m", "x", "mean", w, w)], KEYS, method="running")
    got = out.where(f"ts % {n // 90} = {n // 90 - 1}").select("ts", "s", "m").collect()
    assert len(got) == 90
    for r in got:
        s = sum(1 - i % 7 / 1024 for i in range(r.ts - w + 1, r.ts + 1))
        assert (r.s, r.m) == (pytest.approx(s, rel=1e-12), pytest.approx(s / w, rel=1e-12))


def test_zero_after_movement_is_exactly_zero(spark):
    xs = [random.Random(5).random() for _ in range(50)] + [0.0] * 200
    got = rolling(frame(spark, {"a": xs}), [Roll("s", "x", "sum", 100, 1)], KEYS).orderBy("ts")
    assert got.collect()[-1].s == 0.0


def test_constant_frame_has_zero_deviation(spark):
    data = {"constant": [0.1] * 300, "gaps": [0.1 if i % 3 else None for i in range(300)]}
    for method in ("running", "frame"):
        out = rolling(frame(spark, data), [Roll("s", "x", "std", 100, 10)], KEYS, method=method)
        assert out.where("s <> 0").count() == 0


def test_zscore_of_constant_is_null(spark):
    out = zscore(frame(spark, {"a": [0.1] * 200}), "z", "x", 100, 10, KEYS, method="running")
    assert out.where("z IS NOT NULL").count() == 0


def test_lag(spark):
    out = lag_n(frame(spark, {"a": [1.0, 2.0, 3.0]}), "y", "x", 2, KEYS).orderBy("ts").collect()
    assert [r.y for r in out] == [None, None, 1.0]


def test_reach_hides_older_days(spark):
    """Frames with a reach equal frames over the rows of the reachable days alone."""
    rng = random.Random(2)
    rows = [("a", d, d * 100 + i, rng.choice([None, rng.random()]))
            for d in (0, 1, 2, 4, 5, 6, 9) for i in range(rng.randrange(5, 40))]
    df = spark.createDataFrame(rows, "g string, day int, ts int, x double")
    rolls = [r for r in ROLLS if r.how != "std"] + [Roll("back", "x", "lag", 30)]
    got = rolling(df, rolls, KEYS, ("day", "ts"), reach=Reach("day", 2)).toPandas()
    for day in sorted({r[1] for r in rows}):
        seen = df.where(f"day BETWEEN {day - 2} AND {day}")
        want = rolling(seen, rolls, KEYS, method="frame").where(f"day = {day}").toPandas()
        both = want.merge(got, on=["g", "day", "ts"])
        assert len(both) == len(want)
        for r in rolls:
            x, y = both[f"{r.out}_x"].astype(float), both[f"{r.out}_y"].astype(float)
            assert (x.isna() == y.isna()).all(), (day, r)
            assert np.allclose(x.fillna(0), y.fillna(0), rtol=1e-9, atol=1e-9), (day, r)


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        Roll("o", "x", "median", 3)
    with pytest.raises(ValueError):
        Roll("o", "x", "sum", 0)
    df = frame(spark, {"a": [1.0]})
    with pytest.raises(ValueError):
        rolling(df, [Roll("o", "x", "sum", 3)], KEYS, method="other")
    with pytest.raises(ValueError):
        rolling(df, [Roll("o", "x", "sum", 3)], KEYS, reach=Reach("day", 1))


def test_one_sort_no_exchange_per_statistic(spark):
    sums = [r for r in ROLLS if r.how != "std"]
    df = rolling(frame(spark, {"a": [1.0]}), sums, KEYS, method="running")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange hash") == 1
