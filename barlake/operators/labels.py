"""Forward-looking labels (Y1-Y3).  Never feature inputs: names start ``label_``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.numeric import fdiv
from barlake.operators.technical import symbol_window


def label_names(horizon_days: int) -> tuple[str, str]:
    return f"label_return_{horizon_days}d", f"label_direction_{horizon_days}d"


def forward_return(horizon_days: int, symbol: str = "symbol", order: str = "date") -> Column:
    """close[t+N] / close[t] - 1; NULL on the last N bars of a symbol."""
    return fdiv(F.lead("close", horizon_days).over(symbol_window(symbol, order)), F.col("close")) - 1


def direction(outcome: Column, threshold: float = 0.0) -> Column:
    """1 above the threshold, else 0; NULL without an outcome."""
    return F.when(outcome.isNotNull(), (outcome > threshold).cast("tinyint"))


def with_labels(df: DataFrame, horizon_days: int = 5, threshold: float = 0.0, symbol: str = "symbol", order: str = "date") -> DataFrame:
    """Forward return and its direction.  A return column that is already there is used."""
    ret, way = label_names(horizon_days)
    if ret not in df.columns:
        df = df.withColumn(ret, forward_return(horizon_days, symbol, order))
    return df.withColumn(way, direction(F.col(ret), threshold))


def add_forward_volatility(df: DataFrame, horizon_days: int = 5, symbol="symbol", order="date") -> DataFrame:
    """Config target type ``volatility``: sample std of the next ``N`` daily returns.

    ``label_volatility_{N}d`` is NULL unless all N future returns exist.
    """
    w = symbol_window(symbol, order)
    base = df
    if "returns_1d" not in df.columns:
        staged = df.select("*", F.lag("close", 1).over(w).alias("_pc"))
        base = staged.select(*df.columns, (fdiv(F.col("close"), F.col("_pc")) - 1).alias("returns_1d"))
    future = w.rowsBetween(1, horizon_days)
    r = F.col("returns_1d")
    staged = base.select("*", F.count(r).over(future).alias("_n"), F.stddev_samp(r).over(future).alias("_sd"))
    vol = F.when(F.col("_n") >= horizon_days, F.col("_sd"))
    return staged.select(*base.columns, vol.alias(f"label_volatility_{horizon_days}d"))
