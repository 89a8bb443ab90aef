"""Instrument metadata from bars (S5-S7 columns, A1) and the first catalogue load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.upsert import upsert_instruments
from barlake.schema import INSTRUMENTS_SCHEMA


def sector_code(symbol: Column, asset_type: Column) -> Column:
    """Stocks whose symbol starts with a digit and 3 digits/letters -> '<d>000', else NULL."""
    d = F.regexp_extract(symbol, r"(?i)^(\d)[\da-z]{3}", 1)
    return F.when((asset_type == "stock") & (d != ""), F.concat(d, F.lit("000")))


def instruments_from_bars(bars: DataFrame) -> DataFrame:
    """One row per symbol: market, asset type, sector and ``listed_at`` = first bar date.

    A symbol found under several markets or asset types takes the first pair in order.
    """
    agg = bars.groupBy("symbol").agg(F.min(F.struct("market", "asset_type")).alias("kind"), F.min("date").alias("listed_at"))
    return agg.select("symbol", F.col("kind.market").alias("market"), F.col("kind.asset_type").alias("asset_type"), "listed_at").select(
                      "symbol", "market", "asset_type",
                      sector_code(F.col("symbol"), F.col("asset_type")).alias("sector_code"), "listed_at")


def empty_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INSTRUMENTS_SCHEMA)


def initial_catalogue(spark: SparkSession, instruments: DataFrame, now: Column | None = None) -> DataFrame:
    """A catalogue from scratch: the U1 upsert into an empty catalogue."""
    return upsert_instruments(empty_catalogue(spark), instruments, now)
