"""Snapshots with a commit record, and the stream into silver, catalogue and gold."""

from __future__ import annotations

import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from barlake.plans import snapshots as S
from barlake.plans.ingest import ingest, load_to_gold, read_gold_catalogue
from barlake.sources.bronze import extract_market
from barlake.streaming import ingest as stream

HEADER = "<TICKER>,<PER>,<DATE>,<TIME>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>,<OPENINT>\n"
SCHEMA = "k bigint, v string"


def folder(name):
    return tempfile.mkdtemp(prefix=f"{name}-")


def write(root, rel, *lines):
    path = os.path.join(root, "jp", rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(HEADER + "".join(f"X,D,{line}\n" for line in lines))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_snapshots(spark):
    root = os.path.join(folder("snap"), "table")
    schema = spark.createDataFrame([], SCHEMA).schema
    assert S.read_snapshot(spark, root, schema).collect() == [] and S.newest(spark, root) is None
    for n in range(5):
        before = S.read_snapshot(spark, root, schema)
        assert S.write_snapshot(before.unionByName(spark.createDataFrame([(n, "x")], SCHEMA)), root, tag=f"t{n}", keep=2) == n
    assert [k for k, _ in rows_of(S.read_snapshot(spark, root, schema))] == [0, 1, 2, 3, 4]
    assert len(os.listdir(os.path.join(root, "data"))) == 2  # the newest two
    assert S.is_committed(spark, root, "t0") and not S.is_committed(spark, root, "t9")


def test_torn_snapshot_is_never_read(spark):
    root = os.path.join(folder("snap"), "table")
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    S.write_snapshot(df, root)
    # a writer that died: a folder of data without a commit
    spark.createDataFrame([(9, "half")], SCHEMA).write.parquet(f"{root}/data/torn")
    assert rows_of(S.read_snapshot(spark, root, df.schema)) == [(1, "a")]
    S.write_snapshot(spark.createDataFrame([(2, "b")], SCHEMA), root)
    assert rows_of(S.read_snapshot(spark, root, df.schema)) == [(2, "b")]
    assert not os.path.exists(f"{root}/data/torn")


def drops():
    """Three drops of files: bars, older bars that come late with a bad symbol, a revised bar with a new symbol."""
    return [
        [("tse stocks/1/7203.jp.txt", ["20240301,000000,10,11,9,10,5,0", "20240302,000000,10,12,9,11,5,0"]), ("tse etfs/1305.jp.txt", ["20240301,000000,1,2,1,2,7,0"])],
        [("tse stocks/late/7203.jp.txt", ["20240105,000000,8,9,7,8,4,0", "20240104,000000,-8,9,7,8,4,0"]), ("tse stocks/late/9999.jp.txt", ["20240105,000000,8,7,9,8,4,0"])],
        [("tse stocks/revised/7203.jp.txt", ["20240302,000000,10,12,9,99,6,0"]), ("tse indices/^tpx.txt", ["20240302,000000,2000,2010,1990,2005,0,0"])],
    ]


def tables(spark, gold):
    cat = read_gold_catalogue(spark, gold)
    return (rows_of(cat.select("id", "symbol", "asset_type", "sector_code", "listed_at", "is_active")),
            rows_of(spark.read.parquet(f"{gold}/ohlcv").drop("month")))


def batch_load(spark):
    """Each drop ingested and loaded by the batch job, one after another."""
    gold = os.path.join(folder("gold"), "g")
    for files in drops():
        raw, interim = folder("raw"), folder("interim")
        for rel, lines in files:
            write(raw, rel, *lines)
        ingest(spark, raw, interim, "jp")
        load_to_gold(spark, interim, gold, now=F.to_timestamp(F.lit("2025-01-01 00:00:00")))
    return tables(spark, gold)


def run_stream(spark, raw, work, **options):
    q = stream.start_ingest_stream(spark, raw, "jp", f"{work}/silver", f"{work}/checkpoint", gold_root=f"{work}/gold", rejects_path=f"{work}/rejects",
                                   now=F.to_timestamp(F.lit("2025-01-01 00:00:00")), **options)
    q.awaitTermination()


def test_stream_equals_batch(spark):
    raw, work = folder("raw"), folder("stream")
    for files in drops():
        for rel, lines in files:
            write(raw, rel, *lines)
        run_stream(spark, raw, work)
    catalogue, bars = tables(spark, f"{work}/gold")
    assert (catalogue, bars) == batch_load(spark)
    assert [c[:2] for c in catalogue] == [(1, "1305.JP"), (2, "7203.JP"), (3, "^TPX")]  # 9999 never had a valid bar
    assert next(c for c in catalogue if c[1] == "7203.JP")[4] == date(2024, 1, 4)  # listed by the raw bar that the cleaning drops
    assert float(next(b for b in bars if b[:2] == (2, date(2024, 3, 2)))[5]) == 99.0


@pytest.mark.parametrize("broken", ["store_silver", "load_catalogue", "load_bars"])
def test_batch_killed_between_tables(spark, monkeypatch, broken):
    raw, work = folder("raw"), folder("stream")
    calls = {"store_silver": 0, "load_catalogue": 0, "load_bars": 0}

    def counted(name, original, fails):
        def run(*args, **kwargs):
            if fails and calls.get("fail") is None:
                calls["fail"] = True
                raise RuntimeError("executor gone")
            out = original(*args, **kwargs)
            calls[name] += 1
            return out
        return run

    for name in ("store_silver", "load_catalogue", "load_bars"):
        monkeypatch.setattr(stream, name, counted(name, getattr(stream, name), name == broken))
    for n, files in enumerate(drops()):
        for rel, lines in files:
            write(raw, rel, *lines)
        if n == 0:
            with pytest.raises(Exception, match="executor gone"):
                run_stream(spark, raw, work)
        run_stream(spark, raw, work)
    assert calls["store_silver"] == 3 and calls["load_bars"] == 3  # a table that had its batch is not written again
    assert tables(spark, f"{work}/gold") == batch_load(spark)


def test_replayed_batch_is_skipped(spark):
    """A batch whose tables are all written, but whose end was never noted in the checkpoint, changes nothing."""
    raw, work = folder("raw"), folder("stream")
    for rel, lines in drops()[0]:
        write(raw, rel, *lines)
    run_stream(spark, raw, work)
    before, versions = tables(spark, f"{work}/gold"), S.commits(spark, f"{work}/gold/instruments").count()
    for name in os.listdir(f"{work}/checkpoint/commits"):
        os.remove(f"{work}/checkpoint/commits/{name}")
    run_stream(spark, raw, work)
    assert tables(spark, f"{work}/gold") == before and S.commits(spark, f"{work}/gold/instruments").count() == versions


def test_stream_options(spark):
    raw, work = folder("raw"), folder("stream")
    write(raw, "tse stocks/1/1111.jp.txt", "20240301,000000,10,11,9,10,5,0", "bad,000000,10,11,9,10,5,0")
    write(raw, "tse etfs/1305.jp.txt", "20240301,000000,1,2,1,2,7,0")
    write(raw, "tse stocks/2222.jp.txt", "20240301,000000,10,11,9,10,5,0")
    run_stream(spark, raw, work, reject="file", asset_types={"stock"}, max_files=1)
    assert [c[1] for c in tables(spark, f"{work}/gold")[0]] == ["2222.JP"]
    assert {r.reason for r in spark.read.parquet(f"{work}/rejects").collect()} == {"unparseable date", "file rejected"}


def test_files_in_many_splits(spark):
    from barlake.plans.lake_queries import split_size

    raw = folder("raw dir")
    write(raw, "tse stocks/1/7203 a%b+c#1.jp.txt", *[f"{20200101 + i % 28},000000,{i + 1},{i + 2},{i},{i + 1},5,0" for i in range(1, 200)])
    write(raw, "tse stocks/UPPER.TXT", "20240301,000000,10,11,9,10,5,0")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with split_size(spark, 700):
        ex = extract_market(spark, raw, "jp")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    bars = ex.bars.collect()
    assert len(bars) == 199 and {b.symbol for b in bars} == {"7203 A%B+C#1.JP"} and ex.rejects.count() == 0
    assert len({b.src_pos.block for b in bars}) > 5
    in_order = sorted(bars, key=lambda b: (b.src_pos.block, b.src_pos.line_id))
    assert [b.open for b in in_order] == [float(i + 1) for i in range(1, 200)]
