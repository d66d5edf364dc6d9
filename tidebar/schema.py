"""Column names, accepted aliases and window parameters."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: column names and windows that results depend on. ---------

FEATURE_COLS = [
    "trend24",
    "chop24",
    "taker_imb24",
    "taker_share24",
    "rv_burst_1h",
    "rv24_over_rv168",
    "vol24_over_vol168",
    "rv24_z168",
]

# Earlier names win when a day carries several of them.
TIME_ALIASES = ["open_time", "openTime", "start_time", "startTime", "timestamp", "openTimeMs"]
VOLUME_ALIASES = ["volume", "base_volume"]
TAKER_ALIASES = ["taker_buy_base_asset_volume", "taker_buy_base_vol", "taker_base", "takerBuyBase"]
PRICE_COLS = ["open", "high", "low", "close"]

# A day whose median time value is above this holds milliseconds, else seconds.
MILLIS_THRESHOLD = 10_000_000_000

# Windows in bars, and the least number of observations each needs.
SHORT_WINDOW, SHORT_LEAST = 60, 20
DAY_WINDOW, DAY_LEAST = 1440, 360
WEEK_WINDOW, WEEK_LEAST = 10080, 4320
TREND_SECONDS = 86400

# ----------------------------------------------------------------------------

TICK_COLS = ["symbol", "source_day", "ts", *PRICE_COLS, "volume", "taker_base"]
BAR_COLS = [*TICK_COLS, "ret1m", "ret2_1m", "absret1m"]

BAR_SCHEMA = (
    "symbol string, source_day date, ts timestamp, open double, high double, low double, "
    "close double, volume double, taker_base double, ret1m double, ret2_1m double, "
    "absret1m double"
)
FEATURE_SCHEMA = "symbol string, date date, ts timestamp, " + ", ".join(
    f"{c} double" for c in FEATURE_COLS
)
REPORT_SCHEMA = (
    "symbol string, day date, status string, n_feat_rows bigint, inputs string, error string"
)


@dataclass(frozen=True)
class RegimeSpec:
    """Row-count windows and the least number of observations each needs.

    Windows count bars, not minutes of wall time: gaps stretch what they cover.
    """

    short: int = SHORT_WINDOW
    day: int = DAY_WINDOW
    week: int = WEEK_WINDOW
    min_short: int = SHORT_LEAST
    min_day: int = DAY_LEAST
    min_week: int = WEEK_LEAST
    trend_seconds: int = TREND_SECONDS
