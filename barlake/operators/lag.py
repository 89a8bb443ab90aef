"""Lagged copies of columns within a symbol (L1, L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.technical import symbol_window

# The columns that the feature build lags, and by how many bars.
DEFAULT_LAGS: dict[str, tuple[int, ...]] = dict.fromkeys(("returns_1d", "rsi_14", "macd_hist", "volume_zscore_20d"), (1, 2, 3, 5))


def lag_name(column: str, n: int) -> str:
    return f"{column}_lag_{n}"


def lag_names(lags: dict[str, tuple[int, ...]] | None = None) -> list[str]:
    return [lag_name(c, n) for c, ns in (DEFAULT_LAGS if lags is None else lags).items() for n in ns]


def with_lags(df: DataFrame, lags: dict[str, tuple[int, ...]] | None = None, symbol: str = "symbol", order: str = "date") -> DataFrame:
    """One column for each (column, n) asked for: its value n bars ago.  Columns that ``df`` lacks are left out."""
    w = symbol_window(symbol, order)
    asked = (DEFAULT_LAGS if lags is None else lags).items()
    return df.withColumns({lag_name(c, n): F.lag(c, n).over(w) for c, ns in asked if c in df.columns for n in ns})
