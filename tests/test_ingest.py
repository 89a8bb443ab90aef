"""Bronze scan (S1-S7), ingest/load jobs and idempotent upserts."""

from __future__ import annotations

import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from barlake.operators import upsert as U
from barlake.operators.instruments import initial_catalogue
from barlake.plans.ingest import ingest, load_to_gold, read_gold_catalogue
from barlake.sources.bronze import extract_market, parse_lines

HEADER = "<TICKER>,<PER>,<DATE>,<TIME>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>,<OPENINT>"


def write(root, rel, text):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def bronze_tree():
    root = tempfile.mkdtemp(prefix="bronze-")
    write(root, "jp/tse stocks/1/7203.jp.txt", HEADER + "\n"
          "7203.JP,D,20240102,000000,2500.0,2520.0,2495.0,2515.0,1000000,0\n"
          "7203.JP,D,20240103,000000,2515.0,2530.0,2510.0,2528.0,1200000,0\n"
          "7203.JP,D,20240103,000000,9999.0,9999.0,9990.0,9995.0,5,0\n")
    # columns reordered, optional columns missing: matched by name
    write(root, "jp/tse etfs/1305.jp.txt", "<DATE>,<CLOSE>,<OPEN>,<LOW>,<HIGH>,<TICKER>\n20240105,20.5,20.0,19.5,21.0,1305.JP\n")
    write(root, "jp/tse indices/^tpx.txt", HEADER + "\n^TPX,D,20240102,000000,2000,2010,1990,2005,0,0\n")
    # CRLF line ends and padded header names
    write(root, "jp/tse stocks/3/1301.jp.txt", "<TICKER>, <DATE>,<OPEN> ,<HIGH>,<LOW>,<CLOSE>\r\n1301.JP,20240102,5,6,4,5.5\r\n")
    write(root, "jp/tse stocks/2/130a.jp.txt", HEADER + "\n130A.JP,D,20240104,000000,10,11,9,10,100,\n")
    write(root, "jp/tse stocks/empty.jp.txt", "")
    write(root, "jp/tse stocks/bad.jp.txt", "<TICKER>,<DATE>,<OPEN>\nBAD,20240102,1\n")
    write(root, "jp/tse stocks/9984.jp.txt", HEADER + "\n9984.JP,D,2024-01-02,000000,1,1,1,1,1,0\n9984.JP,D,20240103,000000,2,2,1,2,1,0\n")
    write(root, "jp/unknown folder/x.jp.txt", HEADER + "\nX,D,20240102,000000,1,1,1,1,1,0\n")
    write(root, "jp/tse stocks/Foo.TXT", HEADER + "\nFOO,D,20240102,000000,1,1,1,1,1,0\n")
    return root


def test_extract_paths_types_sectors(spark):
    root = bronze_tree()
    ex = extract_market(spark, root, "jp")
    inst = {r.symbol: r for r in ex.instruments.collect()}
    assert set(inst) == {"7203.JP", "1305.JP", "^TPX", "130A.JP", "9984.JP", "1301.JP"}
    crlf = ex.bars.where(F.col("symbol") == "1301.JP").first()
    assert (crlf.date, crlf.open, crlf.close) == (date(2024, 1, 2), 5.0, 5.5)
    assert inst["7203.JP"].asset_type == "stock" and inst["7203.JP"].sector_code == "7000"
    assert inst["130A.JP"].sector_code == "1000"
    assert inst["^TPX"].asset_type == "index" and inst["^TPX"].sector_code is None
    assert inst["1305.JP"].asset_type == "etf" and inst["1305.JP"].sector_code is None
    etf = ex.bars.where(F.col("symbol") == "1305.JP").first()
    assert (etf.open, etf.high, etf.low, etf.close, etf.volume) == (20.0, 21.0, 19.5, 20.5, None)
    reasons = {r.reason for r in ex.rejects.collect()}
    assert "missing required columns" in reasons and "unparseable date" in reasons
    # row mode keeps the good row of 9984; file mode rejects the whole file
    assert ex.bars.where(F.col("symbol") == "9984.JP").count() == 1
    ex_file = extract_market(spark, root, "jp", reject="file")
    assert ex_file.bars.where(F.col("symbol") == "9984.JP").count() == 0
    only_idx = extract_market(spark, root, "jp", asset_types={"index"})
    assert [r.symbol for r in only_idx.instruments.collect()] == ["^TPX"]
    assert extract_market(spark, root, "us").bars.count() == 0


def test_ingest_and_load_idempotent(spark):
    root = bronze_tree()
    work = tempfile.mkdtemp(prefix="work-")
    interim, gold = os.path.join(work, "interim"), os.path.join(work, "gold")
    ingest(spark, root, interim, "jp")
    silver = spark.read.parquet(os.path.join(interim, "ohlcv"))
    first = silver.where(F.col("symbol") == "7203.JP").orderBy("date").collect()
    assert [r.open for r in first] == [2500.0, 2515.0]  # first-wins within the file
    load_to_gold(spark, interim, gold, now=F.to_timestamp(F.lit("2025-01-01 00:00:00")))
    cat1 = sorted((r.id, r.symbol) for r in read_gold_catalogue(spark, gold).collect())
    bars1 = sorted(tuple(r) for r in spark.read.parquet(os.path.join(gold, "ohlcv")).collect())
    load_to_gold(spark, interim, gold, now=F.to_timestamp(F.lit("2025-01-02 00:00:00")))
    cat2 = sorted((r.id, r.symbol) for r in read_gold_catalogue(spark, gold).collect())
    bars2 = sorted(tuple(r) for r in spark.read.parquet(os.path.join(gold, "ohlcv")).collect())
    assert cat1 == cat2 and bars1 == bars2 and len(bars1) == silver.count()


def test_catalogue_upsert_rules(spark):
    upd0 = spark.createDataFrame([("A", "jp", "stock", None, date(2020, 1, 5)), ("B", "jp", "etf", None, date(2020, 1, 1))],
                                 "symbol string, market string, asset_type string, sector_code string, listed_at date")
    cat = initial_catalogue(spark, upd0, F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    cat = cat.withColumn("is_active", F.col("symbol") != "A").withColumn("name", F.lit("keep"))
    upd = spark.createDataFrame([("A", "jp", "etf", None, date(2019, 1, 1)), ("C", "jp", "stock", "7000", date(2021, 1, 1))],
                                "symbol string, market string, asset_type string, sector_code string, listed_at date")
    got = {r.symbol: r for r in U.upsert_instruments(cat, upd, F.to_timestamp(F.lit("2025-01-01 00:00:00"))).collect()}
    assert got["A"].id == 1 and got["A"].asset_type == "etf" and got["A"].listed_at == date(2019, 1, 1)
    assert got["A"].is_active and got["A"].name == "keep"
    assert got["B"].asset_type == "etf" and got["B"].name == "keep"
    assert got["C"].id == 3 and got["C"].name is None and got["C"].is_active


def test_ragged_blank_and_repeated_headers_lose_nothing(spark):
    root = tempfile.mkdtemp(prefix="bronze-")
    write(root, "jp/tse stocks/1234.jp.txt", "\n" + HEADER + "\n\n1234.JP,D,20240102,0,1,2,1,2,10,0\n1234.JP,D,20240103\n"
          "1234.JP,D,20240104,0,1,2,1,2,10,0,9\n1234.JP,D,20240105,0,x,2,1,2,10,0\n   \n1234.JP,D,20240108,0,1,2,1,2,,\n")
    write(root, "jp/tse etfs/a+b c%.txt", "<TICKER>,<DATE>,<OPEN>,<OPEN>,<HIGH>,<LOW>,<CLOSE>\nX,20240102,5,99,6,4,5\n")
    for mode, n_good in (("row", 3), ("file", 1)):
        ex = extract_market(spark, root, "jp", reject=mode)
        assert ex.bars.count() == n_good and ex.rejects.count() == 6 - n_good
    ex = extract_market(spark, root, "jp")
    assert sorted(r.reason for r in ex.rejects.collect()) == ["field count differs from header"] * 2 + ["unparseable number"]
    twice = ex.bars.where("asset_type = 'etf'").first()
    assert (twice.symbol, twice.open) == ("A+B C%", 5.0)
    assert {r.volume for r in ex.bars.where("symbol = '1234.JP'").collect()} == {10, None}


def test_paths_of_any_store(spark):
    for root, path in (("hdfs://nn/data/raw", "hdfs://nn:8020/data/raw/jp/tse stocks/1/7203.jp.txt"), ("/data/raw", "file:/data/raw/jp/tse stocks/7203.jp.txt"),
                       ("s3a://bucket/raw/", "s3a://bucket/raw/jp/TSE Stocks/7203.jp.txt"), ("file:///data/raw", "file:/data/raw/jp/tse stocks/7203.jp.txt")):
        lines = spark.createDataFrame([(path, 0, 0, HEADER), (path, 0, 1, "7203.JP,D,20240102,0,1,2,1,2,3,0"), (path, 64, 0, "7203.JP,D,20240103,0,1,2,1,2,3,0")],
                                      "file_path string, block bigint, line_id bigint, value string")
        rows = parse_lines(lines, root, "jp").collect()
        assert [(r.symbol, r.asset_type, r.reason) for r in rows] == [("7203.JP", "stock", None)] * 2


def test_symbol_in_two_folders_is_one_instrument(spark):
    rows = [("A", "jp", "stock", None, date(2020, 1, 5)), ("A", "jp", "etf", None, date(2019, 1, 1))]
    upd = spark.createDataFrame(rows, "symbol string, market string, asset_type string, sector_code string, listed_at date")
    got = initial_catalogue(spark, upd, F.to_timestamp(F.lit("2024-01-01 00:00:00"))).collect()
    assert [(r.id, r.symbol, r.asset_type, r.listed_at) for r in got] == [(1, "A", "etf", date(2019, 1, 1))]


def test_missing_replace_column_raises(spark):
    target = spark.createDataFrame([(1, 2.0)], "k int, v double")
    with pytest.raises(ValueError, match="lacks"):
        U.merge_by_key(target, spark.createDataFrame([(1,)], "k int"), ["k"], replace=["v"])


def test_unreadable_target_raises_and_changes_nothing(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="target-"), "t")
    rows = [(1, date(2024, 1, 1), 1.0, "a"), (2, date(2024, 1, 1), 2.0, "a"), (3, date(2024, 1, 1), 3.0, "b")]
    schema = "ticker_id long, date date, v double, part string"
    U.upsert_partitioned_table(path, spark.createDataFrame(rows, schema), ["ticker_id", "date"], "part")
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    for f in files:
        with open(f, "r+b") as h:
            h.write(b"damaged!")
    before = {f: open(f, "rb").read() for f in files}
    with pytest.raises(Exception):
        U.upsert_partitioned_table(path, spark.createDataFrame(rows[:1], schema), ["ticker_id", "date"], "part")
    assert {f: open(f, "rb").read() for f in files} == before


def test_cluster_without_shared_folder_raises():
    from types import SimpleNamespace

    from barlake.session import ensure_checkpoint_dir

    session = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None), conf={"spark.x": "y"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_upsert_requires_unique_keys(spark):
    dup = spark.createDataFrame([(1, date(2024, 1, 1)), (1, date(2024, 1, 1))], "ticker_id long, date date")
    with pytest.raises(ValueError):
        U.check_unique_keys(dup, ["ticker_id", "date"])
