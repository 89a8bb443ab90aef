"""Bar-shaped inputs derived from the driver's test tables.

The engine's tables are daily bars; the test tables are TPC-H-like.  These
functions only reshape test rows into the bar schema (no indicator, label or
ranking work happens here):

* ``brand_bars``: one bar per (part brand, ship date) from lineitem x part;
  price = extendedprice / quantity, open/close = first/last price by the
  total order (orderkey, linenumber, partkey, suppkey, price), volume = sum of
  quantity.
* ``index_bars``: the same over all brands (symbol ``^MKT``), built from the
  brand bars' first/last structs so lineitem is scanned once.
* ``raw_bars``: one unvalidated bar per lineitem with faults injected by
  predicates, plus its source position, for the cleaning operators.
* ``event_bars``: a second, short-history shape from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.numeric import fdiv

MARKET = "jp"
INDEX_SYMBOL = "^MKT"
BAR_COLUMNS = ["symbol", "market", "asset_type", "date", "open", "high", "low", "close", "volume", "open_interest"]
POSITION_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        fdiv(F.col("l_extendedprice"), F.col("l_quantity")).alias("px"),
        *POSITION_COLUMNS,
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )


def _brand_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _priced_lines(spark, sf_dir)
    key = F.struct(*[F.col(c) for c in POSITION_COLUMNS], F.col("px"))
    return lines.groupBy("symbol", "date").agg(
        F.min(key).alias("_first"),
        F.max(key).alias("_last"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.sum("l_quantity").alias("_qty"),
    )


def _shape(df: DataFrame, asset_type: str) -> DataFrame:
    return df.select(
        "symbol",
        F.lit(MARKET).alias("market"),
        F.lit(asset_type).alias("asset_type"),
        "date",
        F.col("_first.px").alias("open"),
        "high",
        "low",
        F.col("_last.px").alias("close"),
        F.col("_qty").cast("bigint").alias("volume"),
        F.lit(None).cast("bigint").alias("open_interest"),
    )


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(_brand_aggregate(spark, sf_dir), "stock")


def index_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = _brand_aggregate(spark, sf_dir)
    mkt = agg.groupBy("date").agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("_qty").alias("_qty"),
    ).withColumn("symbol", F.lit(INDEX_SYMBOL))
    return _shape(mkt, "index")


def all_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand bars plus the ``^MKT`` index series (asset types stock + index).

    lineitem is aggregated once; each brand bar is then emitted twice (as
    itself and as a contribution to the index) and re-aggregated, so the
    second aggregation runs over bars, not line items.
    """
    agg = _brand_aggregate(spark, sf_dir)
    level = F.explode(F.array(F.lit(0), F.lit(1))).alias("_lvl")
    both = agg.select("*", level)
    sym = F.when(F.col("_lvl") == 1, F.lit(INDEX_SYMBOL)).otherwise(F.col("symbol"))
    kind = F.when(F.col("_lvl") == 1, F.lit("index")).otherwise(F.lit("stock"))
    re = both.groupBy(sym.alias("symbol"), "date", kind.alias("_kind")).agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("_qty").alias("_qty"),
    )
    return re.select(
        "symbol", F.lit(MARKET).alias("market"), F.col("_kind").alias("asset_type"), "date",
        F.col("_first.px").alias("open"), "high", "low", F.col("_last.px").alias("close"),
        F.col("_qty").cast("bigint").alias("volume"), F.lit(None).cast("bigint").alias("open_interest"),
    )


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unvalidated bar per lineitem, with injected faults and its source position.

    Faults: linenumber 7 with return flag R -> NULL open; linenumber 6 ->
    high and low swapped; discount 0 -> NULL volume; linenumber 5 with line
    status F -> non-positive close.
    """
    lines = _priced_lines(spark, sf_dir)
    px = F.col("px")
    hi = px * (F.lit(1.0) + F.col("l_tax"))
    lo = px * (F.lit(1.0) - F.col("l_discount"))
    swap = F.col("l_linenumber") == 6
    return lines.select(
        "symbol",
        F.lit(MARKET).alias("market"),
        F.lit("stock").alias("asset_type"),
        "date",
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.lit(None)).otherwise(px).alias("open"),
        F.when(swap, lo).otherwise(hi).alias("high"),
        F.when(swap, hi).otherwise(lo).alias("low"),
        F.when((F.col("l_linenumber") == 5) & (F.col("l_linestatus") == "F"), -px).otherwise(px).alias("close"),
        F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_quantity").cast("bigint")).alias("volume"),
        F.lit(None).cast("bigint").alias("open_interest"),
        F.struct(*[F.col(c) for c in POSITION_COLUMNS], px.alias("px")).alias("src_pos"),
    )


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of ``events.value`` per user (symbol = user id), first/last by (ts, event_id)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    key = F.struct("ts", "event_id", "value")
    agg = ev.groupBy(F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("date")).agg(
        F.min(key).alias("_first"),
        F.max(key).alias("_last"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.count(F.lit(1)).alias("_qty"),
    )
    return agg.select(
        "symbol",
        F.lit("us").alias("market"),
        F.lit("stock").alias("asset_type"),
        "date",
        F.col("_first.value").alias("open"),
        "high",
        "low",
        F.col("_last.value").alias("close"),
        F.col("_qty").cast("bigint").alias("volume"),
        F.lit(None).cast("bigint").alias("open_interest"),
    )
