"""Indicator operators: the reference's unit cases plus exact checks."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlake.operators import technical as T
from barlake.operators.calendar import add_calendar_features
from barlake.operators.cross_sectional import add_cross_sectional_ranks
from barlake.operators.labels import with_labels
from barlake.operators.lag import with_lags

SCHEMA = "symbol string, date date, open double, high double, low double, close double, volume bigint, open_interest bigint"


def synthetic(spark, n=60, start_price=100.0, symbol="S"):
    start = date(2024, 1, 1)
    rows = []
    for i in range(n):
        p = start_price + i * 0.5
        rows.append((symbol, start + timedelta(days=i), p, p + 1.0, p - 1.0, p, 1_000_000 + i * 1000, 0))
    return spark.createDataFrame(rows, SCHEMA)


def col(df, name):
    return [r[0] for r in df.orderBy("date").select(name).collect()]


def test_returns_columns_and_nulls(spark):
    out = T.add_returns(synthetic(spark, 30), periods=(1, 5))
    assert {"returns_1d", "returns_5d", "log_returns_1d"} <= set(out.columns)
    r1, r5 = col(out, "returns_1d"), col(out, "returns_5d")
    assert r1[0] is None and r5[4] is None
    assert all(r > 0 for r in r1[1:])


def test_rsi_bounded_and_trend_is_100(spark):
    out = col(T.add_rsi(synthetic(spark, 50), 14), "rsi_14")
    valid = [v for v in out if v is not None]
    assert all(0 <= v <= 100 for v in valid)
    assert out[12] is None and out[13] == 100.0  # first value at index 13, no losses


def test_macd_columns_and_values_match_pandas_ewm(spark):
    rng = np.random.default_rng(7)
    rows = []
    for sym in ("A", "B"):
        price = 100.0
        for i in range(3000):  # long enough to cross several EMA chunks
            price *= float(np.exp(rng.normal(0, 0.02)))
            rows.append((sym, date(2000, 1, 1) + timedelta(days=i), price, price, price, price, 1, 0))
    df = spark.createDataFrame(rows, SCHEMA)
    out = T.add_macd(df).toPandas().sort_values(["symbol", "date"])
    for sym, g in out.groupby("symbol"):
        close = g["close"].reset_index(drop=True)
        fast = close.ewm(span=12, adjust=False).mean()
        slow = close.ewm(span=26, adjust=False).mean()
        macd = fast - slow
        signal = macd.ewm(span=9, adjust=False).mean()
        assert np.allclose(g["macd"].to_numpy(), macd.to_numpy(), rtol=0, atol=1e-9)
        assert np.allclose(g["macd_signal"].to_numpy(), signal.to_numpy(), rtol=0, atol=1e-9)
        assert np.allclose(g["macd_hist"].to_numpy(), (macd - signal).to_numpy(), rtol=0, atol=1e-9)


def test_bollinger_order(spark):
    out = T.add_bollinger_bands(synthetic(spark, 40), 20).where(F.col("bb_mid_20").isNotNull()).collect()
    assert out and all(r.bb_upper_20 >= r.bb_mid_20 >= r.bb_lower_20 for r in out)


def test_obv_monotone_on_uptrend(spark):
    obv = col(T.add_obv(synthetic(spark, 20)), "obv")
    assert obv[0] == 0 and obv == sorted(obv)


def test_volume_zscore_constant_is_nan(spark):
    df = synthetic(spark, 25).withColumn("volume", F.lit(5).cast("bigint"))
    z = col(T.add_volume_zscore(df, 20), "volume_zscore_20d")
    assert z[18] is None and np.isnan(z[19])


def test_stochastic_and_atr(spark):
    out = T.add_atr(T.add_stochastic(synthetic(spark, 30)), 14).orderBy("date").collect()
    assert out[12].stoch_k is None and out[13].stoch_k is not None
    assert out[15].stoch_d is not None and out[14].stoch_d is None
    assert out[13].atr_14 == pytest.approx(2.0)  # high - low = 2, and |h - pc|, |l - pc| <= 1.5


def test_volatility_first_value_index_20(spark):
    v = col(T.add_volatility(synthetic(spark, 30), (20,)), "volatility_20d")
    assert v[19] is None and v[20] is not None


def test_calendar(spark):
    out = add_calendar_features(synthetic(spark, 10)).orderBy("date").collect()
    assert (out[0].month, out[0].quarter, out[0].year) == (1, 1, 2024)
    assert out[0].day_of_week == 1  # 2024-01-01 is a Monday (ISO 1)
    assert out[0].is_month_start and not out[0].is_month_end


def test_lagged_columns(spark):
    df = spark.createDataFrame([("S", date(2024, 1, i + 1), float(i + 1)) for i in range(5)], "symbol string, date date, x double")
    out = with_lags(df, {"x": (1, 2)})
    assert col(out, "x_lag_1") == [None, 1.0, 2.0, 3.0, 4.0]
    assert col(out, "x_lag_2") == [None, None, 1.0, 2.0, 3.0]
    assert with_lags(df, {"y": (1,)}).columns == df.columns


def test_cross_sectional_rank(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), s, r) for s, r in (("A", 0.10), ("B", -0.05), ("C", 0.02))],
                               "date date, symbol string, returns_5d double")
    ranks = {r.symbol: r.returns_5d_rank for r in add_cross_sectional_ranks(df).collect()}
    assert ranks["A"] == pytest.approx(1.0) and ranks["B"] == pytest.approx(0.0) and ranks["C"] == pytest.approx(0.5)


def test_rank_ties_average_and_single_is_nan(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), "A", 1.0), (date(2024, 1, 1), "B", 1.0), (date(2024, 1, 1), "C", 0.0),
                                (date(2024, 1, 2), "A", 1.0), (date(2024, 1, 2), "B", None)],
                               "date date, symbol string, returns_5d double")
    got = {(r.date.day, r.symbol): r.returns_5d_rank for r in add_cross_sectional_ranks(df).collect()}
    assert got[(1, "A")] == pytest.approx(0.75) and got[(1, "C")] == 0.0
    assert np.isnan(got[(2, "A")]) and got[(2, "B")] is None


def test_forward_and_direction_labels(spark):
    df = spark.createDataFrame([("S", date(2024, 1, i + 1), c) for i, c in enumerate([100.0, 101.0, 102.0, 103.0, 104.0, 105.0])],
                               "symbol string, date date, close double")
    r = col(with_labels(df, 2), "label_return_2d")
    assert r[0] == pytest.approx(0.02) and r[-1] is None and r[-2] is None
    df2 = spark.createDataFrame([("S", date(2024, 1, i + 1), c) for i, c in enumerate([100.0, 100.0, 110.0, 95.0, 100.0])],
                                "symbol string, date date, close double")
    assert col(with_labels(df2, 2, 0.0), "label_direction_2d") == [1, 0, 0, None, None]


def test_no_leakage_features_unchanged_when_future_removed(spark):
    full = synthetic(spark, 120)
    cut = full.where(F.col("date") <= date(2024, 3, 1))
    cols = [c for c in T.technical_column_names()]
    a = T.add_all_technical(full).where(F.col("date") <= date(2024, 3, 1)).orderBy("date").select(*cols).collect()
    b = T.add_all_technical(cut).orderBy("date").select(*cols).collect()
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert (u is None and v is None) or (isinstance(u, float) and np.isnan(u) and np.isnan(v)) or u == pytest.approx(v)


def test_full_stack_single_symbol_exchange(spark):
    df = synthetic(spark, 100).union(synthetic(spark, 100, symbol="Z"))
    plan = T.add_all_technical(df)._jdf.queryExecution().executedPlan().toString()
    # one hash exchange on symbol feeds every indicator
    assert plan.count("Exchange hashpartitioning") == 1
