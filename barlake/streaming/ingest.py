"""Incremental ingest with Structured Streaming (R1): bronze files into silver, catalogue and gold.

A file-source stream watches the bronze market directory.  Every micro-batch
of new files is parsed by the batch scan's parser and cleaned (F1-F3, first
wins inside the batch), then goes into the tables in this order:

1. silver bars, upserted by (symbol, date);
2. the gold catalogue (U1): a snapshot, committed together with the batch's number;
3. gold bars (U2), upserted by (instrument, date) in the months touched.

``foreachBatch`` is at-least-once.  After each table the number of the batch
is noted beside it, so a batch that is replayed after a failure skips the
tables it had finished and goes on with the next; an upsert cut off half-way
is repeated and, being keyed, ends in the same table.  Late and revised files
are just later batches: "last wins" for each key across batches, as when the
batch job loads twice.  New symbols get the next ids in the order of arrival.
Lines that can't be used are written to the rejects, a folder for each batch.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.clean import clean_bars
from barlake.operators.instruments import instruments_from_bars
from barlake.operators.upsert import replace_by_key, upsert_partitioned_table
from barlake.plans.ingest import load_bars, load_catalogue
from barlake.session import make_folder, materialize, path_exists
from barlake.sources.bronze import file_path_column, good_rows, parse_lines, rejected_lines

SILVER_KEYS = ["symbol", "date"]


def once(spark: SparkSession, notes: str, tag: str, action: Callable[[], None]) -> bool:
    """Do ``action`` unless ``notes`` has the tag, then note it.  Whether it was done."""
    mark = f"{notes}/{tag}"
    if path_exists(spark, mark):
        return False
    action()
    make_folder(spark, mark)
    return True


def store_silver(bars: DataFrame, silver_path: str) -> None:
    staged = bars.withColumn("month", F.trunc("date", "MM"))
    upsert_partitioned_table(silver_path, staged, SILVER_KEYS, "month", merge_fn=lambda t, u: replace_by_key(t, u, SILVER_KEYS))


def start_ingest_stream(spark: SparkSession, raw_root: str, market: str, silver_path: str, checkpoint: str, available_now: bool = True,
                        rejects_path: str | None = None, gold_root: str | None = None, reject: str = "row",
                        asset_types: set[str] | None = None, now: Column | None = None, max_files: int | None = None):
    """Start the stream; with ``available_now`` it processes the backlog and stops.

    Without ``gold_root`` it ends at silver.  ``reject`` and ``asset_types`` as in the batch
    scan; ``max_files`` bounds a batch.
    """
    files = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
    if max_files:
        files = files.option("maxFilesPerTrigger", max_files)
    src = files.load(os.path.join(raw_root, market)).select("value", file_path_column().alias("file_path"), F.col("_metadata.file_block_start").alias("block"))

    def store_batch(batch: DataFrame, number: int) -> None:
        # the id in the checkpoint tells this stream's batches from those of another, or of one begun anew
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        tag = f"{stream}-{number}"
        # ids increase along each block of a file; with the block's start they order its lines
        lines = batch.withColumn("line_id", F.monotonically_increasing_id())
        parsed = materialize(parse_lines(lines, raw_root, market, asset_types))
        if rejects_path:
            # a folder for each batch, so that a replayed batch replaces its own
            rejected_lines(parsed, reject).write.mode("overwrite").parquet(f"{rejects_path}/batch={number}")
        raw = good_rows(parsed, reject)
        bars = materialize(clean_bars(raw))
        if bars.isEmpty():
            return
        once(spark, f"{silver_path}-batches", tag, lambda: store_silver(bars, silver_path))
        if gold_root is None:
            return
        # symbols without a valid bar are no instruments; listed_at counts all parsed bars
        instruments = instruments_from_bars(raw).join(bars.select("symbol").distinct(), "symbol", "left_semi")
        load_catalogue(spark, gold_root, instruments, now, tag)
        once(spark, f"{gold_root}/ohlcv-batches", tag, lambda: load_bars(spark, gold_root, bars))

    writer = src.writeStream.foreachBatch(store_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
