"""Scans of the engine's own tables (S8-S11) with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import BARS_SCHEMA, INSTRUMENTS_SCHEMA
from barlake.session import path_exists


def read_silver(spark: SparkSession, silver_root: str, market: str | None = None,
                asset_types: tuple[str, ...] | None = None) -> DataFrame:
    """Silver bars; ``market``/``asset_type`` are partition columns, so these
    filters prune directories instead of reading them."""
    df = spark.read.schema(BARS_SCHEMA).parquet(silver_root)
    if market is not None:
        df = df.where(F.col("market") == market)
    if asset_types:
        df = df.where(F.col("asset_type").isin(list(asset_types)))
    return df


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Instrument catalogue."""
    return spark.read.schema(INSTRUMENTS_SCHEMA).parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed feature matrix; a missing path is an error, not an empty frame."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Features not found at {path} - build them first")
    return spark.read.parquet(path)


def distinct_symbols(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """The symbol set; only the symbol column is read from the scan."""
    return df.select(symbol).distinct()
