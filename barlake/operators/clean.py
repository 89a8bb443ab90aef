"""Bar validation, first-wins dedupe and quality accounting.

``clean_bars`` keeps bars with non-null date/open/high/low/close, positive
prices and ``high >= low``; among valid bars sharing ``(symbol, date)`` the
first in source order wins; NULL volume becomes 0 while ``open_interest``
stays NULL.  Dedupe is a grouped ``min`` over ``struct(position, values)``:
partial aggregation collapses copies before the shuffle, so a key with a huge
number of copies costs one row per map task, not one task for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRICE_COLUMNS = ("open", "high", "low", "close")


def valid_bar(date: str = "date") -> Column:
    present = F.col(date).isNotNull()
    for c in PRICE_COLUMNS:
        present = present & F.col(c).isNotNull()
    positive = (F.col("open") > 0) & (F.col("high") > 0) & (F.col("low") > 0) & (F.col("close") > 0)
    return present & positive & (F.col("high") >= F.col("low"))


def dedupe_first(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """One row per ``keys``: the one with the smallest ``position`` (ties: smallest values)."""
    values = [c for c in df.columns if c not in keys and c != position]
    first = F.min(F.struct(F.col(position).alias("_pos"), *[F.col(c) for c in values])).alias("_first")
    agg = df.groupBy(*keys).agg(first)
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in values])


def clean_bars(
    df: DataFrame,
    symbol: str = "symbol",
    date: str = "date",
    position: str = "src_pos",
) -> DataFrame:
    """F1 + F2 + D1 + F3.  Output keeps the input columns minus ``position``."""
    valid = df.where(valid_bar(date))
    deduped = dedupe_first(valid, [symbol, date], position)
    cols = [c for c in df.columns if c != position]
    fill = {"volume": F.coalesce(F.col("volume"), F.lit(0).cast("bigint")).alias("volume")} if "volume" in cols else {}
    return deduped.select(*[fill.get(c, F.col(c)) for c in cols])


def quality_report(raw: DataFrame, cleaned: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """rows in, valid rows and rows out per symbol."""
    inp = raw.groupBy(symbol).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(valid_bar(date)).alias("rows_valid"),
    )
    outp = cleaned.groupBy(symbol).agg(F.count(F.lit(1)).alias("rows_out"))
    joined = inp.join(outp, on=symbol, how="left")
    rows_out = F.coalesce(F.col("rows_out"), F.lit(0))
    return joined.select(
        symbol, "rows_in", "rows_valid", rows_out.alias("rows_out"), (F.col("rows_in") - rows_out).alias("rows_dropped")
    )


def filter_min_history(df: DataFrame, min_history_days: int = 250, symbol: str = "symbol",
                       order: str = "date") -> DataFrame:
    """keep symbols with at least ``min_history_days`` bars.

    A window count (no extra shuffle); the frame spans the whole partition but
    is ordered by ``order`` so it shares the sort of the indicator windows
    that follow.
    """
    w = Window.partitionBy(symbol).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.count(F.lit(1)).over(w)
    return df.select("*", n.alias("_n_bars")).where(F.col("_n_bars") >= min_history_days).drop("_n_bars")
