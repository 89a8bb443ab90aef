"""Per-date cross-sectional features.

A date partition holds one trading day of the universe: its size is bounded
by the number of listed instruments, not by history length, so every rank
spec shares one exchange on ``date`` with one sort per ranked column.  Where a
date holds too many rows for a task, ``add_spread_ranks`` gives the same ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import fdiv
from barlake.operators.ordered import value_bucket

# Ranked columns and their direction (True: a high value ranks best).
RANK_COLUMNS: dict[str, bool] = {
    "returns_5d": True,
    "returns_20d": True,
    "returns_60d": True,
    "volume_zscore_20d": True,
    "volatility_20d": False,
    "rsi_14": True,
}


def average_rank(col: str, descending: bool, partition: str = "date") -> Column:
    """1-based average-tie rank of ``col`` within ``partition``; NULL stays NULL.

    ``rank()`` is the first position of a tie group and the count of rows up to
    and including the tie group (RANGE frame) is its last; their mean is the
    average rank.  Both share one ordering, hence one sort.
    """
    c = F.col(col)
    ordering = c.desc_nulls_last() if descending else c.asc_nulls_last()
    w = Window.partitionBy(partition).orderBy(ordering)
    upto = F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return F.when(c.isNotNull(), (F.rank().over(w) + upto) / F.lit(2.0))


def rank_column(col: str, descending: bool, partition: str = "date") -> Column:
    """(n - rank) / (n - 1) with n the non-null count on the date; n = 1 gives NaN.

    ``n`` uses the rank's own ordering with a whole-partition frame, so it
    shares that ordering's sort.
    """
    c = F.col(col)
    ordering = c.desc_nulls_last() if descending else c.asc_nulls_last()
    whole = Window.partitionBy(partition).orderBy(ordering).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.count(c).over(whole).cast("double")
    return fdiv(n - average_rank(col, descending, partition), n - F.lit(1.0)).alias(f"{col}_rank")


def add_cross_sectional_ranks(df: DataFrame, columns: dict[str, bool] | None = None, partition: str = "date") -> DataFrame:
    cols = RANK_COLUMNS if columns is None else columns
    exprs = [rank_column(c, desc, partition) for c, desc in cols.items() if c in df.columns]
    return df.select("*", *exprs) if exprs else df


def add_spread_ranks(df: DataFrame, columns: dict[str, bool] | None = None, key: str = "symbol", partition: str = "date") -> DataFrame:
    """The same columns as ``add_cross_sectional_ranks`` without a task for each date.

    For universes where one date's rows are too many for a task.  Each value
    gets a bucket that follows its order; ranks are taken inside (date, column,
    bucket), and the counts of the buckets before are added.  Equal values
    share a bucket, so ties are whole.  (key, partition) must be unique.
    """
    cols = {c: d for c, d in (RANK_COLUMNS if columns is None else columns).items() if c in df.columns}
    if not cols:
        return df
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v"), F.lit(d).alias("_d")) for c, d in cols.items()])).alias("r")
    long = df.select(key, partition, cells).select(key, partition, "r.*").where("_v is not null")
    place = value_bucket(long, "_v", False)
    falls = F.col("_d")
    long = long.select(key, partition, "_c", F.when(falls, -place).otherwise(place).alias("_b"), F.when(falls, -F.col("_v")).otherwise(F.col("_v")).alias("_o"))
    inside = Window.partitionBy(partition, "_c", "_b").orderBy("_o")
    upto = F.count("*").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = long.select(key, partition, "_c", "_b", ((F.rank().over(inside) + upto) / F.lit(2.0)).alias("_r"))
    totals = long.groupBy(partition, "_c", "_b").agg(F.count("*").alias("_t"))
    line = Window.partitionBy(partition, "_c").orderBy("_b")  # a row for each bucket, not for each value
    before = totals.select(partition, "_c", "_b", (F.sum("_t").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_t")).alias("_before"),
                           F.sum("_t").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).cast("double").alias("_n"))
    placed = local.join(before, [partition, "_c", "_b"]).select(key, partition, "_c", fdiv(F.col("_n") - F.col("_before") - F.col("_r"), F.col("_n") - 1.0).alias("_rank"))
    wide = placed.groupBy(key, partition).agg(*[F.max(F.when(F.col("_c") == c, F.col("_rank"))).alias(f"{c}_rank") for c in cols])
    return df.join(wide, [key, partition], "left").select(*df.columns, *[f"{c}_rank" for c in cols])


def add_market_relative_returns(
    df: DataFrame,
    market_symbol: str = "^TPX",
    symbol: str = "symbol",
    date: str = "date",
    returns_col: str = "returns_5d",
) -> DataFrame:
    """``excess_returns_5d`` = own ``returns_5d`` minus the index's on the same date.

    The reference left-joins the index series on ``date``.  Here the index
    value is looked up inside the date partition instead (``(symbol, date)``
    is unique, so at most one row matches): no join, no second pass over the
    pipeline, and it shares the exchange on ``date`` with the rank windows.
    The schema is static: the column is NULL where the index has no row.
    """
    mkt = F.max(F.when(F.col(symbol) == F.lit(market_symbol), F.col(returns_col))).over(Window.partitionBy(date))
    staged = df.select("*", mkt.alias("_mkt_ret"))
    return staged.select(*[F.col(c) for c in df.columns],
                         (F.col(returns_col) - F.col("_mkt_ret")).alias(f"excess_{returns_col}"))
