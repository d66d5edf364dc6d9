"""Kline bars and rolling market-regime features as Spark DataFrame plans."""

from tidebar.schema import FEATURE_COLS, RegimeSpec

__all__ = ["FEATURE_COLS", "RegimeSpec"]
