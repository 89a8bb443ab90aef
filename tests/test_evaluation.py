"""Folds, metrics and portfolio statistics."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest

from barlake.operators import folds as FO
from barlake.operators import metrics as M
from barlake.operators import portfolio as P
from barlake.operators.ordered import average_precision, exact_quantiles, roc_auc


def test_single_split(spark):
    f = FO.walk_forward_splits(spark, "2020-01-01", "2022-12-31", "2023-01-10", "2023-12-31", 1, 5).collect()
    assert len(f) == 1 and f[0].train_start == date(2020, 1, 1) and f[0].val_end == date(2023, 12, 31)


def test_embargo_and_order_errors(spark):
    with pytest.raises(ValueError, match="embargo"):
        FO.walk_forward_splits(spark, "2020-01-01", "2023-01-01", "2023-01-02", "2023-12-31", embargo_days=5)
    with pytest.raises(ValueError, match="after train_end"):
        FO.walk_forward_splits(spark, "2020-01-01", "2023-06-01", "2023-06-01", "2023-12-31")


def test_contiguous_and_rolling_folds(spark):
    f = FO.walk_forward_splits(spark, "2020-01-01", "2022-12-31", "2023-01-10", "2023-12-31", 3, 5).orderBy("fold").collect()
    size = (date(2023, 12, 31) - date(2023, 1, 10)).days // 3
    assert all(s.train_start == date(2020, 1, 1) for s in f)
    assert all((f[i + 1].val_start - f[i].val_start).days == size for i in range(2))
    assert f[-1].val_end == date(2023, 12, 31)
    span = (date(2022, 12, 31) - date(2020, 1, 1)).days
    r = FO.walk_forward_splits(spark, "2020-01-01", "2022-12-31", "2023-01-10", "2023-12-31", 3, 5, expanding=False).collect()
    assert all((s.train_end - s.train_start).days == span for s in r)
    g = FO.walk_forward_splits(spark, "2020-01-01", "2022-01-01", "2022-01-08", "2023-01-01").select(FO.gap_days()).first()[0]
    assert g == 7


def scored(spark, ys, ps, fold=0):
    return spark.createDataFrame([(fold, int(y), float(p)) for y, p in zip(ys, ps)], "fold int, y int, p double")


def test_perfect_and_random_auc(spark):
    assert roc_auc(scored(spark, [0, 0, 1, 1], [.1, .2, .9, .95]), ["fold"]).first().roc_auc == 1.0
    rng = np.random.default_rng(42)
    y, p = rng.integers(0, 2, 1000), rng.random(1000)
    auc = roc_auc(scored(spark, y, p), ["fold"]).first().roc_auc
    assert 0.45 < auc < 0.55


def test_auc_and_ap_exact_with_ties(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 3000)
    p = np.round(rng.random(3000) * 0.5 + 0.3 * y, 2)  # many ties
    auc = roc_auc(scored(spark, y, p), ["fold"]).first().roc_auc
    # Mann-Whitney with average ranks
    ranks = pd_rank(p)
    npos = y.sum()
    expect = (ranks[y == 1].sum() - npos * (npos + 1) / 2) / (npos * (len(y) - npos))
    assert auc == pytest.approx(expect, abs=1e-12)
    ap = average_precision(scored(spark, y, p), ["fold"]).first().average_precision
    order = np.argsort(-p, kind="stable")
    thresholds = np.unique(p)[::-1]
    tp_prev, s = 0, 0.0
    for t in thresholds:
        tp = int(((p >= t) & (y == 1)).sum())
        n = int((p >= t).sum())
        s += (tp - tp_prev) / npos * tp / n
        tp_prev = tp
    assert ap == pytest.approx(s, abs=1e-12)
    assert order is not None


def pd_rank(p):
    import pandas as pd

    return pd.Series(p).rank(method="average").to_numpy()


def test_single_class_is_nan_and_baselines(spark):
    df = scored(spark, [1, 1, 1, 1], [.2, .6, .7, .9])
    m = M.compute_metrics(df, ["fold"]).first()
    assert np.isnan(m.roc_auc) and np.isnan(m.average_precision) and np.isnan(m.log_loss)
    assert m.accuracy == 0.75 and m.positive_rate == 1.0
    m2 = M.confusion_metrics(scored(spark, [1, 1, 1, 1, 0, 0], [.9] * 6), ["fold"]).first()
    assert m2.positive_rate == pytest.approx(4 / 6) and m2.baseline_majority_accuracy == pytest.approx(4 / 6)


def test_exact_quantiles(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)], "v double")
    q = exact_quantiles(df, "v", {"q25": 0.25, "q50": 0.5, "q95": 0.95}).first()
    assert (q.q25, q.q50, q.q95) == (2.0, 4.0, 9.0)


def preds(spark, n_days=10, n_per_day=5, start=date(2024, 1, 1)):
    rows = [(start + timedelta(days=d), f"SYM{r}", (n_per_day - r) / n_per_day, (n_per_day - r) * 0.01)
            for d in range(n_days) for r in range(n_per_day)]
    return spark.createDataFrame(rows, "date date, symbol string, predicted_probability double, label_return_5d double")


def test_backtest_cases(spark):
    r = P.backtest_top_k(preds(spark, 20, 10), "label_return_5d", top_k=3, transaction_cost_bps=0.0).first()
    assert r.cumulative_return > 1.0 and r.win_rate == pytest.approx(1.0) and r.n_trades == 60
    free = P.backtest_top_k(preds(spark), "label_return_5d", top_k=2, transaction_cost_bps=0.0).first()
    costly = P.backtest_top_k(preds(spark), "label_return_5d", top_k=2, transaction_cost_bps=50.0).first()
    assert costly.cumulative_return < free.cumulative_return
    s = P.backtest_top_k(preds(spark, 30), "label_return_5d", top_k=3).first()
    assert s.annualised_volatility >= 0.0 and s.sharpe_ratio == 0.0
    empty = preds(spark).limit(0)
    assert P.backtest_summary(empty, "label_return_5d")["n_trades"] == 0


def test_caps_calendar_and_capital(spark):
    days = [r.date for r in P.calendar_rebalance_dates(preds(spark, 40), "weekly").orderBy("date").collect()]
    assert days == [date(2024, 1, 1) + timedelta(days=7 * i) for i in range(6)]  # a Monday
    assert P.calendar_rebalance_dates(preds(spark, 40), "daily").count() == 40 and P.calendar_rebalance_dates(preds(spark, 40), "monthly").count() == 2
    with pytest.raises(ValueError):
        P.calendar_rebalance_dates(preds(spark), "yearly")
    got = P.capped_returns(preds(spark, 8), "label_return_5d", 2, 0.3, "weekly", 0.0).orderBy("date").collect()
    assert [(r.n_picks, r.weight) for r in got] == [(2, 0.3)] * 2
    assert got[0].gross_return == pytest.approx(0.6 * 0.045)
    curve = P.capital_curve(spark.createDataFrame([(date(2024, 1, 1), 0.1), (date(2024, 1, 8), -0.5)], "date date, net_return double"), 1000.0)
    assert [(round(r.capital, 6), round(r.drawdown, 6)) for r in curve.orderBy("date").collect()] == [(1100.0, 0.0), (550.0, -0.5)]


def test_test_range_role(spark):
    f = FO.with_test_range(FO.walk_forward_splits(spark, "2020-01-01", "2022-12-31", "2023-01-10", "2023-12-31"), "2024-01-01")
    rows = spark.createDataFrame([(date(2021, 5, 5),), (date(2023, 6, 1),), (date(2025, 1, 1),), (date(2024, 1, 3),)], "date date")
    roles = sorted((r.date.isoformat(), r.role) for r in FO.assign_folds(rows, f).collect())
    assert roles == [("2021-05-05", "train"), ("2023-06-01", "val"), ("2024-01-03", "test"), ("2025-01-01", "test")]


def test_rebalance_every_n(spark):
    df = preds(spark, 20, 10)
    days = sorted(r.date for r in P.rebalance_dates(df, 5).collect())
    assert days == [date(2024, 1, 1), date(2024, 1, 6), date(2024, 1, 11), date(2024, 1, 16)]
    r = P.backtest_rebalanced(df, "label_return_5d", top_k=3, every_n=5, transaction_cost_bps=0.0).first()
    assert r.n_trades == 4 * 3 and r.win_rate == 1.0


def test_page_count_and_sparse_columns(spark):
    from barlake.operators.lookups import page_count
    from barlake.operators.preprocessing import drop_sparse_columns, fill_zero

    assert (page_count(0, 50), page_count(50, 50), page_count(51, 50)) == (0, 1, 2)
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None), (None, 3.0)], "a double, b double")
    assert drop_sparse_columns(df, ["a", "b"], 0.3).columns == ["a"]  # a: 25 % missing, b: 75 %
    assert [r.b for r in fill_zero(df, ["b"]).collect()] == [0.0, 0.0, 0.0, 3.0]
