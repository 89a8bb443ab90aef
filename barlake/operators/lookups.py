"""Catalogue and prediction lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.operators.ordered import ordered_prefix_sums


def get_instrument(catalogue: DataFrame, symbol: str) -> DataFrame:
    """Q1: exact match on the upper-cased symbol (zero rows = not found)."""
    return catalogue.where(F.col("symbol") == F.lit(symbol.upper()))


MAX_PAGE = 500


def instrument_conditions(market: str | None = None, asset_type: str | None = None, active_only: bool = True, search: str | None = None) -> list[Column]:
    """Q2 conditions asked for; ``search`` is a case-insensitive contains (``%``/``_`` stay wildcards)."""
    asked = {"market": market, "asset_type": asset_type}
    found = [F.col(c) == v for c, v in asked.items() if v is not None]
    if search:
        found.append(F.col("symbol").ilike(f"%{search}%"))
    return found + [F.col("is_active")] * active_only


def list_instruments(catalogue: DataFrame, page: int = 1, page_size: int = 50, **conditions) -> DataFrame:
    """Q2 + A3 + O2: one page ordered by symbol, each row carrying the filtered total.

    Pages count from 1 and hold 1 to ``MAX_PAGE`` rows; anything else raises.
    The total is a scalar subquery over the same filter (a distributed count),
    not a window over all rows.
    """
    if page < 1 or not 1 <= page_size <= MAX_PAGE:
        raise ValueError(f"pages count from 1 and hold 1 to {MAX_PAGE} rows")
    matches = reduce(DataFrame.where, instrument_conditions(**conditions), catalogue)
    wanted = matches.orderBy("symbol").offset((page - 1) * page_size).limit(page_size)
    return wanted.withColumn("total", matches.agg(F.count("*")).scalar())


def number_pages(catalogue: DataFrame, page_size: int = 50, **conditions) -> DataFrame:
    """O2 + O3 for all pages at once: matching rows with ``page`` (as ``list_instruments`` cuts them), ``total`` and ``pages``.

    A row's page follows from the number of symbols up to it, a distributed running
    count: one plan, however many pages there are, and no global sort.
    """
    if not 1 <= page_size <= MAX_PAGE:
        raise ValueError(f"pages hold 1 to {MAX_PAGE} rows")
    matches = reduce(DataFrame.where, instrument_conditions(**conditions), catalogue)
    numbered = ordered_prefix_sums(matches.withColumn("_one", F.lit(1)), [], "symbol", ["_one"])
    total = matches.agg(F.count("*")).scalar()
    return numbered.select(*catalogue.columns, F.expr(f"int((cum__one - 1) div {page_size} + 1)").alias("page"), total.alias("total"),
                           F.ceil(total / page_size).cast("int").alias("pages"))


def page_ranges(catalogue: DataFrame, page_size: int = 50, **conditions) -> DataFrame:
    """(page, first_symbol, last_symbol, n_rows): the range of keys of each page, for readers that fetch pages by key."""
    return number_pages(catalogue, page_size, **conditions).groupBy("page").agg(
        F.min("symbol").alias("first_symbol"), F.max("symbol").alias("last_symbol"), F.count("*").alias("n_rows"))


def page_after(catalogue: DataFrame, last_symbol: str | None, page_size: int = 50, **conditions) -> DataFrame:
    """The page that follows a symbol (None: the first): a filter on the key and the least rows of each task, no offset."""
    matches = reduce(DataFrame.where, instrument_conditions(**conditions), catalogue)
    if last_symbol is not None:
        matches = matches.where(F.col("symbol") > last_symbol)
    return matches.orderBy("symbol").limit(page_size)


def page_count(total: int, page_size: int) -> int:
    """O3: ceil(total / size)."""
    return (total + page_size - 1) // page_size if total else 0


def last_n_bars(bars: DataFrame, n: int, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Q4: the newest ``n`` bars per symbol (the per-symbol limit runs before the shuffle)."""
    w = Window.partitionBy(symbol).orderBy(F.col(date).desc())
    return bars.select("*", F.row_number().over(w).alias("recency")).where(F.col("recency") <= n)


def latest_row(df: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """K2: the newest row per symbol via ``max_by``: summed up in each task before the shuffle."""
    others = [c for c in df.columns if c != symbol]
    agg = df.groupBy(symbol).agg(F.max_by(F.struct(*others), F.col(date)).alias("_last"))
    return agg.select(symbol, *[F.col(f"_last.{c}").alias(c) for c in others])


def predictions_on_date(pred: DataFrame, day: str, model_name: str | None = None) -> DataFrame:
    """Q5: predictions made on ``day`` (a partition filter when the table is partitioned by date)."""
    df = pred.where(F.col("prediction_date") == F.to_date(F.lit(day)))
    return df.where(F.col("model_name") == model_name) if model_name else df


def requested_symbols(spark: SparkSession, symbols: list[str]) -> DataFrame:
    """A request list (1-500 symbols, the API bound) as a small (symbol, pos) table."""
    if not 1 <= len(symbols) <= 500:
        raise ValueError("between 1 and 500 symbols per request")
    return spark.createDataFrame([(s, i) for i, s in enumerate(symbols)], "symbol string, pos int")


def latest_for_symbols(latest: DataFrame, request: DataFrame) -> DataFrame:
    """Q3: latest rows for the requested symbols in request order; unknown symbols are omitted."""
    return latest.join(F.broadcast(request), "symbol", "inner").orderBy("pos")
