"""Ranks, string splitters, paging and long windows whose groups span many tasks."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlake.operators import cross_sectional as X
from barlake.operators import lookups as L
from barlake.operators import ordered as O
from barlake.operators import technical as T
from barlake.operators.instruments import initial_catalogue
from barlake.operators.upsert import assign_new_ids

DAY = date(2024, 1, 1)


def same(a, b):
    return all((x is None) == (y is None) and (x is None or (np.isnan(x) and np.isnan(y)) or x == pytest.approx(y, rel=1e-9, abs=1e-9)) for x, y in zip(a, b))


def one_large_day(n=2000):
    rnd = random.Random(3)
    special = [None, float("nan"), 0.0, -0.0, 1e300, -1e300, 5.0, 5.0]
    rows = [(f"S{i}", DAY, rnd.choice([rnd.gauss(0, 1), round(rnd.gauss(0, 1), 1), rnd.choice(special)]), rnd.gauss(100, 1)) for i in range(n)]
    rows += [(f"S{i}", DAY + timedelta(days=1 + i % 3), rnd.gauss(0, 1), 1.0) for i in range(n // 10)]
    return [*rows, ("alone", DAY + timedelta(days=9), 1.0, None)]


def test_spread_ranks_equal_ranks(spark):
    df = spark.createDataFrame(one_large_day(), "symbol string, date date, a double, b double").repartition(4)
    cols = {"a": True, "b": False, "missing": True}
    want = {(r.symbol, r.date): (r.a_rank, r.b_rank) for r in X.add_cross_sectional_ranks(df, cols).collect()}
    got = X.add_spread_ranks(df, cols)
    assert got.columns == ["symbol", "date", "a", "b", "a_rank", "b_rank"]
    rows = got.collect()
    assert len(rows) == len(want) and all(same((r.a_rank, r.b_rank), want[r.symbol, r.date]) for r in rows)


def test_a_date_spans_tasks(spark):
    df = spark.createDataFrame(one_large_day(), "symbol string, date date, a double, b double")
    plan = X.add_spread_ranks(df, {"a": True})._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "rank(" in line]
    assert windows and all("_b" in line for line in windows)  # ranked inside buckets of a date, not over all of it
    placed = df.where(F.col("date") == DAY).select(O.value_bucket(df, "a", False).alias("b")).groupBy("b").count()
    assert placed.count() > 300 and placed.where("b is not null and b <> 0").agg(F.max("count")).first()[0] < 200


def test_string_splitters_follow_the_order(spark, monkeypatch):
    monkeypatch.setattr(O, "PER_BUCKET", 50)
    monkeypatch.setattr(O, "SKIP", 4)
    words = sorted({"BRAND#" + "".join(random.Random(i).choice("abé日\U0001F600Z") for _ in range(i % 7)) + str(i) for i in range(3000)} | {""})
    df = spark.createDataFrame([(w,) for w in words], "s string").repartition(5).cache()
    bounds = O.string_bounds(df, "s")
    assert bounds == sorted(bounds) and len(bounds) > 40
    got = {r.s: r.b for r in df.select("s", O.string_bucket(F.col("s"), bounds).alias("b")).collect()}
    assert [got[w] for w in words] == [sum(b <= w for b in bounds) for w in words]
    sizes = pd.Series(list(got.values())).value_counts()
    assert sizes.max() < 6 * 50
    df.unpersist()


def test_ids_of_many_symbols_with_one_beginning(spark):
    n = 100_000
    new = spark.range(n).select(F.concat(F.lit("BRAND#"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("symbol"))
    cat = initial_catalogue(spark, spark.createDataFrame([], "symbol string, market string, asset_type string, sector_code string, listed_at date"))
    ids = assign_new_ids(cat, new)
    stats = ids.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id"), F.sum(F.expr("int(id <> int(substr(symbol, 7)) + 1)"))).first()
    assert tuple(stats) == (n, n, 1, n, 0)
    buckets = new.select(O.value_bucket(new, "symbol", False).alias("b")).groupBy("b").count().agg(F.count("*"), F.max("count")).first()
    assert buckets[0] > 20 and buckets[1] < 3 * O.PER_BUCKET


def test_pages_in_one_plan(spark):
    rows = [(f"S{i:03}", "jp", "stock" if i % 3 else "etf", None, DAY) for i in range(100)]
    cat = initial_catalogue(spark, spark.createDataFrame(rows, "symbol string, market string, asset_type string, sector_code string, listed_at date"),
                            F.to_timestamp(F.lit("2024-01-01 00:00:00"))).cache()
    for size, conditions in ((7, {}), (9, {"asset_type": "stock"}), (500, {"search": "s00"}), (5, {"market": "us"})):
        numbered = L.number_pages(cat, size, **conditions).collect()
        pages = {r.page for r in numbered}
        assert pages == set(range(1, len(pages) + 1))
        last = None
        for page in sorted(pages):
            want = [r.symbol for r in L.list_instruments(cat, page, size, **conditions).collect()]
            assert sorted(r.symbol for r in numbered if r.page == page) == want
            assert [r.symbol for r in L.page_after(cat, last, size, **conditions).collect()] == want
            span = L.page_ranges(cat, size, **conditions).where(F.col("page") == page).first()
            assert (span.first_symbol, span.last_symbol, span.n_rows) == (want[0], want[-1], len(want))
            last = want[-1]
        assert all((r.total, r.pages) == (len(numbered), len(pages)) for r in numbered)
        assert L.page_after(cat, last, size, **conditions).collect() == [] or last is None
    with pytest.raises(ValueError):
        L.number_pages(cat, 501)
    cat.unpersist()


@pytest.mark.parametrize("n", [1, 2, 5, 60])
def test_sliding_frames(spark, n):
    rnd = np.random.default_rng(n)
    rows = []
    for s, size in (("A", 200), ("B", 61), ("C", 3), ("D", 1)):
        v = rnd.normal(1e6, 1, size).tolist()
        for i in range(0, size, 37):
            v[i] = None if i % 2 else float("nan")
        rows += [(s, DAY + timedelta(days=i), x) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double").repartition(3)
    specs = [(a, "x", n, f"{a}_{n}") for a in T.SLIDING]
    got = T.add_sliding(df, specs)
    assert got.columns == ["symbol", "date", "x", *[s[3] for s in specs]]
    w = T.symbol_window()
    aggs = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    want = {(r.symbol, r.date): r for r in df.select("*", *[T.rolling(aggs[a], F.col("x"), w, n).alias(name) for a, _, _, name in specs]).collect()}
    for r in got.collect():
        assert same([r[s[3]] for s in specs], [want[r.symbol, r.date][s[3]] for s in specs]), (r, want[r.symbol, r.date])
    with pytest.raises(ValueError):
        T.add_sliding(df, [("median", "x", 3, "m")])


def test_window_lists(spark):
    rows = [("A", DAY + timedelta(days=i), 10.0 + (i * 7) % 5, 12.0 + (i * 7) % 5, 9.0, 10.0 + (i * 3) % 7, 100 + i % 9) for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume bigint")
    default = T.add_all_technical(df)
    assert len(T.technical_column_names()) == 26 and default.columns == [*df.columns, *T.technical_column_names()]
    wide = T.add_all_technical(df, price_windows=(3, 200), volume_windows=(5, 150))
    names = T.technical_column_names((3, 200), (5, 150))
    assert {"returns_3d", "returns_200d", "returns_1d", "volatility_3d", "volatility_200d", "volume_zscore_5d", "volume_zscore_20d", "volume_zscore_150d"} <= set(names)
    own = T.add_volume_zscore(T.add_volatility(df, (3, 200)), 150)
    a = {r.date: (r.volatility_3d, r.volatility_200d, r.volume_zscore_150d) for r in wide.collect()}
    assert all(same(a[r.date], (r.volatility_3d, r.volatility_200d, r.volume_zscore_150d)) for r in own.collect())
