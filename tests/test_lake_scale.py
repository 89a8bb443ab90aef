"""Files of a lake: tasks of a scan in small splits, moves and listings of many files."""

from __future__ import annotations

import inspect
import os
import tempfile

import pytest

from barlake import session as S
from barlake.plans.ingest import ingest
from barlake.sources.bronze import extract_market, scan_lines

HEADER = "<TICKER>,<DATE>,<OPEN>,<HIGH>,<LOW>,<CLOSE>\n"


def lake(lines: int) -> str:
    root = tempfile.mkdtemp(prefix="lake-")
    os.makedirs(f"{root}/jp/tse stocks")
    for symbol in ("1301", "7203"):
        with open(f"{root}/jp/tse stocks/{symbol}.jp.txt", "w") as out:
            out.write(HEADER + "".join(f"T,{20000101 + i % 28},{i + 2},{i + 3},{i + 1},{i + 2}\n" for i in range(lines)))
    return root


def test_small_splits_share_tasks(spark):
    root = lake(2000)
    with S.split_size(spark, 500):
        lines = scan_lines(spark, f"{root}/jp")
        assert lines.select("file_path", "block").distinct().count() > 100
        assert lines.rdd.getNumPartitions() <= max(4, 4 * spark.sparkContext.defaultParallelism) + 1
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    assert extract_market(spark, root, "jp", split_bytes=500).bars.count() == 4000


def test_only_raw_files_are_read_in_small_splits(spark, monkeypatch):
    from barlake.plans import ingest as I

    seen = []
    monkeypatch.setattr(I, "clean_bars", lambda bars, clean=I.clean_bars: (seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes")), clean(bars))[1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    root = lake(30)
    assert "split_bytes" in inspect.signature(ingest).parameters
    assert ingest(spark, root, tempfile.mkdtemp(prefix="interim-"), "jp", split_bytes=500) == {"tickers": 2}
    assert seen == [before]


def test_move_files(spark):
    root = tempfile.mkdtemp(prefix="move-")
    for i in range(40):
        os.makedirs(f"{root}/from/{i}")
        with open(f"{root}/from/{i}/part.txt", "w") as out:
            out.write(str(i))
    found = S.files_below(spark, f"{root}/from", ".txt")
    assert len(found) == 40
    S.move_files(spark, [(f, f"{root}/to/{int(f.split('/')[-2]) % 3}/{f.split('/')[-2]} a%.txt") for f in found])
    assert S.files_below(spark, f"{root}/from", ".txt") == []
    for i in range(40):
        with open(f"{root}/to/{i % 3}/{i} a%.txt") as text:
            assert text.read() == str(i)
    with pytest.raises(Exception):
        S.move_files(spark, [(f"{root}/none.txt", f"{root}/to/none.txt")])
