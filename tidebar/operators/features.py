"""The eight regime features of a minute-bar series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from tidebar.operators.rolling import Reach, Roll, rolling
from tidebar.operators.tail import BLOCK_DAYS, BLOCK_KEYS, FAN_KEYS, fan_out, spread_blocks
from tidebar.schema import FEATURE_COLS, RegimeSpec

_INPUTS = [
    "ln(close) AS _lnc",
    "try_divide(taker_base, volume) AS _share",
    "try_divide(2D * taker_base - volume, volume) AS _imb",
]


def _level_rolls(spec: RegimeSpec) -> list[Roll]:
    day, week = (spec.day, spec.min_day), (spec.week, spec.min_week)
    return [
        Roll("_lnc_day", "_lnc", "lag", spec.day),
        Roll("_var_short", "ret2_1m", "sum", spec.short, spec.min_short),
        Roll("_var_day", "ret2_1m", "sum", *day),
        Roll("_var_week", "ret2_1m", "sum", *week),
        Roll("_abs_day", "absret1m", "mean", *day),
        Roll("_share_day", "_share", "mean", *day),
        Roll("_imb_day", "_imb", "mean", *day),
        Roll("_vol_day", "volume", "sum", *day),
        Roll("_vol_week", "volume", "sum", *week),
    ]


def _vol_of_vol_rolls(spec: RegimeSpec) -> list[Roll]:
    week = (spec.week, spec.min_week)
    return [Roll("_rv_mean", "_rv", "mean", *week), Roll("_rv_std", "_rv", "std", *week)]


def _root(variance: str) -> str:
    # A difference of totals may end a hair below 0; `greatest` would also turn NULL to 0.
    return f"sqrt(CASE WHEN {variance} < 0 THEN 0D ELSE {variance} END)"


def _formulas(spec: RegimeSpec) -> dict[str, str]:
    rv_day, rv_week = _root("_var_day"), _root("_var_week")
    return {
        "trend24": f"(_lnc - _lnc_day) / {spec.trend_seconds}",
        "chop24": f"try_divide(_abs_day, {rv_day})",
        "taker_imb24": "_imb_day",
        "taker_share24": "_share_day",
        "rv_burst_1h": "try_divide(_var_short, _var_day)",
        "rv24_over_rv168": f"try_divide({rv_day}, {rv_week})",
        "vol24_over_vol168": "try_divide(_vol_day, _vol_week)",
        "rv24_z168": "try_divide(_rv - _rv_mean, _rv_std)",
    }


def _finite(expr: str) -> str:
    return f"CASE WHEN abs({expr}) < double('infinity') THEN {expr} END"


def regime_features(
    bars: DataFrame,
    keys: Sequence[str],
    spec: RegimeSpec = RegimeSpec(),
    method: str = "auto",
) -> DataFrame:
    """Add `FEATURE_COLS` to bars, over the rows of each group of `keys` in `ts` order."""
    columns = bars.columns
    df = rolling(bars.selectExpr("*", *_INPUTS), _level_rolls(spec), keys, method=method)
    df = df.selectExpr("*", f"{_root('_var_day')} AS _rv")
    df = rolling(df, _vol_of_vol_rolls(spec), keys, method=method)
    formulas = _formulas(spec)
    return df.selectExpr(*columns, *[f"{_finite(formulas[f])} AS {f}" for f in FEATURE_COLS])


def daily_regime_features(
    bars: DataFrame,
    start: date | None = None,
    end: date | None = None,
    tail_days: int = 7,
    spec: RegimeSpec = RegimeSpec(),
    block_days: int = BLOCK_DAYS,
    n_bars: int | None = None,
) -> DataFrame:
    """Features of every bar in `[start, end]`, each day computed from its own bars and
    those of the `tail_days` before it, and from nothing older.

    Gives what `regime_features` gives over the groups of `fan_out`, without repeating
    everything per target day: seven features are windows over a block of days whose
    frames stop `tail_days` back. Only the z-score depends on the target day throughout
    (its oldest volatilities are themselves cut short), so only two narrow columns are
    fanned out.
    """
    blocks = spread_blocks(
        bars.selectExpr(
            "symbol", "source_day", "ts", "ret2_1m", "absret1m", "volume", *_INPUTS
        ),
        start,
        end,
        tail_days,
        block_days,
        n_bars,
    ).selectExpr("*", "unix_date(source_day) AS _day")
    level = rolling(
        blocks, _level_rolls(spec), BLOCK_KEYS, ("_day", "ts"), reach=Reach("_day", tail_days)
    )

    formulas = _formulas(spec)
    own = ", ".join(
        f"'{f}', {_finite(formulas[f])}" for f in FEATURE_COLS if f != "rv24_z168"
    )
    fanned = fan_out(
        level.selectExpr(
            *FAN_KEYS[:2],
            "ts",
            "_day",
            "first_target",
            "last_target",
            "CASE WHEN abs(ret2_1m) < double('infinity') THEN ret2_1m END AS _var",
            "_var_day",
            # Features travel with the row's own day only.
            f"CASE WHEN _day >= first_target THEN named_struct({own}) END AS _own",
        )
    ).selectExpr("*", "unix_date(target_day) = _day AS _is_own")

    # A frame that fits into the target day's history is the block's; the rows before
    # that hold all there is since the history began.
    seen = f"(PARTITION BY {', '.join(FAN_KEYS)} ORDER BY ts ROWS UNBOUNDED PRECEDING)"
    rv = fanned.selectExpr(
        "*",
        f"row_number() OVER (PARTITION BY {', '.join(FAN_KEYS)} ORDER BY ts) AS _row",
        f"count(_var) OVER {seen} AS _obs",
        f"sum(_var) OVER {seen} AS _total",
    ).selectExpr(
        *FAN_KEYS,
        "ts",
        "_own",
        "_is_own",
        f"CASE WHEN _row >= {spec.day} THEN {_root('_var_day')} "
        f"WHEN _obs >= {spec.min_day} THEN sqrt(_total) END AS _rv",
    )
    return (
        rolling(rv, _vol_of_vol_rolls(spec), FAN_KEYS)
        .where("_is_own")
        .selectExpr(
            "symbol",
            "target_day AS date",
            "ts",
            *[f"_own.{f}" for f in FEATURE_COLS if f != "rv24_z168"],
            f"{_finite(formulas['rv24_z168'])} AS rv24_z168",
        )
    )
