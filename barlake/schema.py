"""Canonical table schemas (fixed, never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, LongType, StringType,
    StructField, StructType, TimestampType,
)

BARS_SCHEMA = StructType([
    StructField("symbol", StringType(), False),
    StructField("date", DateType(), False),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", LongType()),
    StructField("open_interest", LongType()),
    StructField("market", StringType()),
    StructField("asset_type", StringType()),
])

INSTRUMENTS_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("symbol", StringType(), False),
    StructField("name", StringType()),
    StructField("market", StringType()),
    StructField("asset_type", StringType()),
    StructField("sector_code", StringType()),
    StructField("listed_at", DateType()),
    StructField("delisted_at", DateType()),
    StructField("is_active", BooleanType()),
    StructField("created_at", TimestampType()),
    StructField("updated_at", TimestampType()),
])

PRICE = DecimalType(18, 6)
