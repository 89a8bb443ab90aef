"""Batch jobs: bronze -> silver (S7 + clean + P1 + P2 + F10) and silver -> gold (U4).

Silver bars are Parquet partitioned by ``market/asset_type`` (clustered by
symbol, sorted by date inside files); the catalogue is one Parquet table.
Gold bars are partitioned by ``month`` and upserted with dynamic partition
overwrite; the gold catalogue is kept as snapshots with a commit record (never
read and overwritten in place).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.clean import clean_bars, quality_report
from barlake.operators.upsert import (
    PREDICTION_KEYS, symbol_ids, to_gold_bars, upsert_instruments, upsert_partitioned_table, upsert_predictions,
    write_partitions,
)
from barlake.plans.snapshots import is_committed, read_snapshot, write_snapshot
from barlake.schema import INSTRUMENTS_SCHEMA
from barlake.session import path_exists
from barlake.sources.bronze import extract_market
from barlake.sources.tables import read_silver

SILVER_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume", "open_interest", "market", "asset_type"]


def write_silver(bars: DataFrame, silver_root: str) -> None:
    """Partitioned by market/asset_type; only the partitions present in ``bars`` are replaced."""
    write_partitions(bars.select(*SILVER_COLUMNS), silver_root, ["market", "asset_type"], ["symbol", "date"])


def ingest(spark: SparkSession, raw_root: str, interim_root: str, market: str,
           asset_types: set[str] | None = None, limit: int | None = None, reject: str = "row",
           split_bytes: int | None = None) -> dict[str, int]:
    """Bronze -> silver bars + catalogue + quality report + rejects.  Returns row counts."""
    ex = extract_market(spark, raw_root, market, asset_types, limit, reject, split_bytes)
    raw = ex.bars
    cleaned = clean_bars(raw)
    write_silver(cleaned, os.path.join(interim_root, "ohlcv"))
    silver = read_silver(spark, os.path.join(interim_root, "ohlcv"), market, tuple(sorted(asset_types)) if asset_types else None)
    # instruments whose bars were all invalid leave the catalogue too
    tickers = ex.instruments.join(silver.select("symbol").distinct(), "symbol", "left_semi")
    tickers.write.mode("overwrite").parquet(os.path.join(interim_root, "tickers"))
    quality_report(raw, silver).write.mode("overwrite").parquet(os.path.join(interim_root, "quality"))
    ex.rejects.write.mode("overwrite").parquet(os.path.join(interim_root, "rejects"))
    return {"tickers": spark.read.parquet(os.path.join(interim_root, "tickers")).count()}


def _catalogue_root(gold_root: str) -> str:
    return os.path.join(gold_root, "instruments")


def read_gold_catalogue(spark: SparkSession, gold_root: str) -> DataFrame:
    """The newest committed catalogue, or an empty one."""
    return read_snapshot(spark, _catalogue_root(gold_root), INSTRUMENTS_SCHEMA)


def load_catalogue(spark: SparkSession, gold_root: str, instruments: DataFrame, now: Column | None = None, tag: str | None = None) -> None:
    """U1 persisted: the upserted catalogue becomes the next snapshot.  A ``tag`` that is committed already is left at that."""
    root = _catalogue_root(gold_root)
    if tag is None or not is_committed(spark, root, tag):
        write_snapshot(upsert_instruments(read_gold_catalogue(spark, gold_root), instruments, now), root, tag)


def load_bars(spark: SparkSession, gold_root: str, bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """U2 persisted: bars of known symbols into the months they belong to.  (Rows with their ids, unknown symbols.)"""
    matched, unknown = symbol_ids(read_gold_catalogue(spark, gold_root), bars)
    gold = to_gold_bars(matched).withColumn("month", F.trunc("date", "MM"))
    upsert_partitioned_table(os.path.join(gold_root, "ohlcv"), gold, ["ticker_id", "date"], "month")
    return matched, unknown


def load_to_gold(spark: SparkSession, interim_root: str, gold_root: str, market: str | None = None,
                 asset_types: set[str] | None = None, now: Column | None = None) -> DataFrame:
    """U4: catalogue upsert, then bars upsert touching only the months present in silver.

    Returns rows loaded per symbol (A5) and the unknown-symbol report is
    written next to the gold tables.
    """
    tickers_path = os.path.join(interim_root, "tickers")
    if not path_exists(spark, tickers_path):
        raise FileNotFoundError(f"Run the transform step first; missing {tickers_path}")
    updates = spark.read.parquet(tickers_path)
    if market is not None:
        updates = updates.where(F.col("market") == market)
    if asset_types:
        updates = updates.where(F.col("asset_type").isin(sorted(asset_types)))
    load_catalogue(spark, gold_root, updates, now)
    bars = read_silver(spark, os.path.join(interim_root, "ohlcv"), market, tuple(sorted(asset_types)) if asset_types else None)
    matched, unknown = load_bars(spark, gold_root, bars)
    unknown.write.mode("overwrite").parquet(os.path.join(gold_root, "unknown_symbols"))
    return matched.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_loaded"))


def write_predictions(predictions: DataFrame, path: str) -> None:
    """U3 persisted: upsert into a table partitioned by prediction quarter."""
    preds = predictions.withColumn("quarter_start", F.trunc("prediction_date", "quarter"))
    upsert_partitioned_table(path, preds, PREDICTION_KEYS, "quarter_start",
                             merge_fn=lambda t, u: upsert_predictions(t, u).withColumn(
                                 "quarter_start", F.trunc("prediction_date", "quarter")))
