"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables through ``barlake.sources.fixtures``
and runs the library's operators on all of it.  Output floats go through
``present`` (NaN/inf -> NULL, rounded) to match the oracle's presentation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.numeric import out
from barlake.operators import technical as T
from barlake.operators.calendar import CALENDAR_COLUMNS, add_calendar_features
from barlake.operators.clean import clean_bars, dedupe_first, filter_min_history, quality_report, valid_bar
from barlake.operators.cross_sectional import RANK_COLUMNS, add_cross_sectional_ranks, add_market_relative_returns, add_spread_ranks
from barlake.operators.labels import with_labels
from barlake.operators.lag import lag_names, with_lags
from barlake.plans.features import FeatureSettings, build_feature_frame
from barlake.session import materialize
from barlake.sources import fixtures as fx

RETURN_PERIODS = (1, 5, 10, 20, 60)


def present(df: DataFrame, keys: list[str], floats: list[str], other: list[str] | None = None) -> DataFrame:
    return df.select(
        *keys,
        *[out(F.col(c)).alias(c) for c in floats],
        *(other or []),
    )


def _tech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.add_all_technical(fx.all_bars(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str, min_history: int = 250, drop_unlabelled: bool = True) -> DataFrame:
    return build_feature_frame(fx.all_bars(spark, sf_dir), FeatureSettings(
        min_history_days=min_history, market_index_symbol=fx.INDEX_SYMBOL, drop_unlabelled=drop_unlabelled))


# ---------------------------------------------------------------- step 0/1
def q_bars_daily(spark, sf_dir):
    b = fx.brand_bars(spark, sf_dir)
    return present(b, ["symbol", "market", "asset_type", "date"], ["open", "high", "low", "close"], ["volume", "open_interest"])


def q_index_bars(spark, sf_dir):
    b = fx.index_bars(spark, sf_dir)
    return present(b, ["symbol", "market", "asset_type", "date"], ["open", "high", "low", "close"], ["volume", "open_interest"])


def q_returns(spark, sf_dir):
    r = T.add_returns(fx.all_bars(spark, sf_dir), RETURN_PERIODS)
    return present(r, ["symbol", "date"], [f"returns_{n}d" for n in RETURN_PERIODS])


def q_log_returns(spark, sf_dir):
    r = T.add_returns(fx.all_bars(spark, sf_dir), RETURN_PERIODS)
    return present(r, ["symbol", "date"], [f"log_returns_{n}d" for n in RETURN_PERIODS])


def q_cross_sectional_rank(spark, sf_dir):
    r = T.add_returns(fx.all_bars(spark, sf_dir), (5, 20, 60))
    ranked = add_cross_sectional_ranks(r, {"returns_5d": True, "returns_20d": True, "returns_60d": True})
    return present(ranked, ["symbol", "date"], ["returns_5d", "returns_5d_rank", "returns_20d_rank", "returns_60d_rank"])


def q_cross_sectional_rank_spread(spark, sf_dir):
    """The ranks of ``cross_sectional_rank``, with a date's rows spread over tasks."""
    r = T.add_returns(fx.all_bars(spark, sf_dir), (5, 20, 60))
    ranked = add_spread_ranks(materialize(r), {"returns_5d": True, "returns_20d": True, "returns_60d": True})
    return present(ranked, ["symbol", "date"], ["returns_5d", "returns_5d_rank", "returns_20d_rank", "returns_60d_rank"])


# ---------------------------------------------------------------- step 2
def q_clean_bars(spark, sf_dir):
    c = clean_bars(fx.raw_bars(spark, sf_dir))
    return present(c, ["symbol", "date"], ["open", "high", "low", "close"], ["volume", "open_interest"])


def q_clean_report(spark, sf_dir):
    raw = fx.raw_bars(spark, sf_dir)
    return quality_report(raw, clean_bars(raw))


def q_dedupe_first(spark, sf_dir):
    """Dates with several valid bars for a symbol, and the bar that wins (first in source order)."""
    valid = fx.raw_bars(spark, sf_dir).where(valid_bar())
    copies = valid.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("n_copies")).where(F.col("n_copies") > 1)
    winners = dedupe_first(valid, ["symbol", "date"], "src_pos")
    j = winners.join(copies, ["symbol", "date"], "inner")
    return present(j, ["symbol", "date", "n_copies"], ["open", "high", "low", "close"], ["volume"])


def q_min_history(spark, sf_dir):
    kept = filter_min_history(fx.all_bars(spark, sf_dir), 1500)
    return present(kept, ["symbol", "date"], ["close"])


# ---------------------------------------------------------------- step 3/4
def q_rsi(spark, sf_dir):
    return present(T.add_rsi(fx.all_bars(spark, sf_dir), 14), ["symbol", "date"], ["rsi_14"])


def q_bollinger(spark, sf_dir):
    cols = ["bb_mid_20", "bb_upper_20", "bb_lower_20", "bb_width_20", "bb_pct_20"]
    return present(T.add_bollinger_bands(fx.all_bars(spark, sf_dir)), ["symbol", "date"], cols)


def q_atr(spark, sf_dir):
    return present(T.add_atr(fx.all_bars(spark, sf_dir)), ["symbol", "date"], ["atr_14"])


def q_obv(spark, sf_dir):
    return T.add_obv(fx.all_bars(spark, sf_dir)).select("symbol", "date", "obv")


def q_stochastic(spark, sf_dir):
    return present(T.add_stochastic(fx.all_bars(spark, sf_dir)), ["symbol", "date"], ["stoch_k", "stoch_d"])


def q_volatility(spark, sf_dir):
    return present(T.add_volatility(fx.all_bars(spark, sf_dir)), ["symbol", "date"], ["volatility_20d", "volatility_60d"])


def q_volume_zscore(spark, sf_dir):
    return present(T.add_volume_zscore(fx.all_bars(spark, sf_dir)), ["symbol", "date"], ["volume_zscore_20d"])


def q_macd(spark, sf_dir):
    return present(T.add_macd(fx.all_bars(spark, sf_dir)), ["symbol", "date"], ["macd", "macd_signal", "macd_hist"])


def q_calendar(spark, sf_dir):
    return add_calendar_features(fx.all_bars(spark, sf_dir)).select("symbol", "date", *CALENDAR_COLUMNS)


def q_lags(spark, sf_dir):
    df = with_lags(_tech(spark, sf_dir))
    return present(df, ["symbol", "date"], lag_names())


def q_forward_labels(spark, sf_dir):
    return present(with_labels(fx.all_bars(spark, sf_dir), 5), ["symbol", "date"], ["label_return_5d"])


def q_direction_labels(spark, sf_dir):
    df = with_labels(fx.all_bars(spark, sf_dir), 5, 0.0)
    return df.select("symbol", "date", F.col("label_direction_5d").cast("int").alias("label_direction_5d"))


def q_technical_stack(spark, sf_dir):
    floats = [c for c in T.technical_column_names() if c != "obv"]
    return present(_tech(spark, sf_dir), ["symbol", "date"], floats, ["obv"])


def q_event_features(spark, sf_dir):
    """The same per-symbol operators on a second bar shape (events: many short histories)."""
    df = T.add_rsi(T.add_returns(fx.event_bars(spark, sf_dir), (1, 5)), 5)
    df = T.add_volume_zscore(df, 5)
    return present(df, ["symbol", "date"], ["close", "returns_1d", "returns_5d", "rsi_5", "volume_zscore_5d"])


# ---------------------------------------------------------------- step 5
def q_excess_returns(spark, sf_dir):
    r = T.add_returns(fx.all_bars(spark, sf_dir), (5,))
    ex = add_market_relative_returns(r, fx.INDEX_SYMBOL)
    return present(ex, ["symbol", "date"], ["returns_5d", "excess_returns_5d"])


#: All float columns of the feature matrix; the others are whole numbers and flags.
INPUT_FLOATS = [c for c in T.technical_column_names() if c != "obv"] + lag_names()
FEATURE_MATRIX_FLOATS = ["open", "high", "low", "close", *INPUT_FLOATS, "label_return_5d", *[f"{c}_rank" for c in RANK_COLUMNS], "excess_returns_5d"]


def q_feature_matrix(spark, sf_dir):
    """Every column that the feature build makes."""
    return present(features(spark, sf_dir), ["symbol", "market", "asset_type", "date"], FEATURE_MATRIX_FLOATS,
                   ["volume", "open_interest", "obv", *CALENDAR_COLUMNS, F.col("label_direction_5d").cast("int").alias("label_direction_5d")])


def q_feature_row_counts(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.groupBy("symbol", "year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("returns_60d").alias("n_returns_60d"),
        F.count("volatility_60d").alias("n_volatility_60d"),
        F.sum(F.col("label_direction_5d").cast("int")).cast("bigint").alias("n_up"),
    )


QUERIES = {
    "bars_daily": q_bars_daily,
    "index_bars": q_index_bars,
    "returns": q_returns,
    "log_returns": q_log_returns,
    "cross_sectional_rank": q_cross_sectional_rank,
    "cross_sectional_rank_spread": q_cross_sectional_rank_spread,
    "clean_bars": q_clean_bars,
    "clean_report": q_clean_report,
    "dedupe_first": q_dedupe_first,
    "min_history": q_min_history,
    "rsi": q_rsi,
    "bollinger": q_bollinger,
    "atr": q_atr,
    "obv": q_obv,
    "stochastic": q_stochastic,
    "volatility": q_volatility,
    "volume_zscore": q_volume_zscore,
    "macd": q_macd,
    "calendar": q_calendar,
    "lags": q_lags,
    "forward_labels": q_forward_labels,
    "direction_labels": q_direction_labels,
    "technical_stack": q_technical_stack,
    "event_features": q_event_features,
    "excess_returns": q_excess_returns,
    "feature_matrix": q_feature_matrix,
    "feature_row_counts": q_feature_row_counts,
}


# ---------------------------------------------------------------- step 6
from barlake.functions.numeric import finite_or_null  # noqa: E402
from barlake.operators import folds as FO  # noqa: E402
from barlake.operators import metrics as M  # noqa: E402
from barlake.operators import portfolio as P  # noqa: E402
from barlake.operators import preprocessing as PP  # noqa: E402
from barlake.operators.lookups import (  # noqa: E402
    get_instrument, last_n_bars, latest_for_symbols, latest_row, list_instruments, predictions_on_date, requested_symbols,
)
from barlake.operators.ordered import average_precision, roc_auc  # noqa: E402

MODEL = "rank20"
STRATEGY_KS = (3, 5)
STRATEGY_BPS = (5.0, 10.0)


def scored(spark, sf_dir, score_col: str = "returns_20d_rank") -> DataFrame:
    """Labelled feature rows scored with a rank column as the predicted probability."""
    f = features(spark, sf_dir)
    return f.select(
        "symbol", "date", finite_or_null(F.col(score_col)).alias("p"),
        F.col("label_direction_5d").cast("int").alias("y"), F.col("label_return_5d").alias("ret"),
    ).where(F.col("p").isNotNull())


def data_bounds(dated: DataFrame) -> DataFrame:
    """Split bounds from the data's date range: validation = last 40 %, 7-day gap."""
    b = dated.agg(F.min("date").alias("train_start"), F.max("date").alias("val_end"))
    vs = F.date_add(F.col("train_start"), F.expr("datediff(val_end, train_start) * 3 div 5").cast("int"))
    b = b.select("train_start", vs.alias("val_start"), "val_end")
    return b.select("train_start", F.date_sub("val_start", 7).alias("train_end"), "val_start", "val_end")


def data_folds(dated: DataFrame, n_splits: int = 3, expanding: bool = True) -> DataFrame:
    return FO.expand_folds(data_bounds(dated), n_splits=n_splits, embargo_days=5, expanding=expanding)


def validation_rows(spark, sf_dir) -> DataFrame:
    s = materialize(scored(spark, sf_dir))
    return FO.assign_folds(s, data_folds(s)).where(F.col("role") == "val")


def q_walk_forward_folds(spark, sf_dir):
    s = materialize(features(spark, sf_dir).select("date"))
    exp = data_folds(s, 3, True).withColumn("mode", F.lit("expanding"))
    roll = data_folds(s, 3, False).withColumn("mode", F.lit("rolling"))
    one = data_folds(s, 1, True).withColumn("mode", F.lit("single"))
    return exp.unionByName(roll).unionByName(one).select("mode", *FO.FOLD_COLUMNS, FO.gap_days())


def q_fold_assignment(spark, sf_dir):
    f = materialize(features(spark, sf_dir).select("symbol", "date"))
    a = FO.assign_folds(f, data_folds(f))
    return a.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("symbol").alias("n_symbols"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )


def q_class_metrics(spark, sf_dir):
    m = M.confusion_metrics(validation_rows(spark, sf_dir), ["fold"])
    return present(m, ["fold", "n", "positives"], ["accuracy", "precision", "recall", "f1", "positive_rate",
                                                    "baseline_always_positive_accuracy", "baseline_majority_accuracy"])


def q_roc_auc(spark, sf_dir):
    return present(roc_auc(validation_rows(spark, sf_dir), ["fold"]), ["fold"], ["roc_auc"])


def q_average_precision(spark, sf_dir):
    return present(average_precision(validation_rows(spark, sf_dir), ["fold"]), ["fold"], ["average_precision"])


def q_log_loss(spark, sf_dir):
    return present(M.log_loss(validation_rows(spark, sf_dir), ["fold"]), ["fold"], ["log_loss"])


def q_run_metrics(spark, sf_dir):
    m = M.compute_metrics(validation_rows(spark, sf_dir).withColumn("model_name", F.lit(MODEL)), ["model_name", "fold"])
    long = M.metrics_long(m, ["model_name", "fold"], prefix="val_")
    return present(long, ["model_name", "fold", "metric"], ["value"])


def q_topk_picks(spark, sf_dir):
    picks = P.top_k_per_date(scored(spark, sf_dir), 3, score="p")
    return present(picks, ["date", "symbol", "pick_rank"], ["p", "ret"])


def strategy_daily(spark, sf_dir, ks=STRATEGY_KS, bps=STRATEGY_BPS) -> DataFrame:
    """All (k, bps) strategies at once: one pick pass for the largest k, then per-strategy means."""
    picks = P.top_k_per_date(scored(spark, sf_dir), max(ks), score="p")
    grid = spark.createDataFrame([(k, b) for k in ks for b in bps], "top_k int, cost_bps double")
    per = picks.join(F.broadcast(grid), F.col("pick_rank") <= F.col("top_k"), "inner")
    return P.daily_returns(per, "ret", ["top_k", "cost_bps"], "cost_bps")


def q_portfolio_stats(spark, sf_dir):
    stats = P.portfolio_stats(strategy_daily(spark, sf_dir), ["top_k", "cost_bps"], "top_k", rebalance_days=5)
    return present(stats, ["top_k", "cost_bps", "n_trades"], ["cumulative_return", "annualised_return",
                   "annualised_volatility", "sharpe_ratio", "max_drawdown", "win_rate"])


def q_equity_curve(spark, sf_dir):
    curve = P.equity_curve(strategy_daily(spark, sf_dir, (3,), (5.0,)), ["top_k", "cost_bps"])
    return present(curve, ["top_k", "cost_bps", "date"], ["gross_return", "net_return", "equity", "drawdown"])


def q_latest_row(spark, sf_dir):
    return present(latest_row(fx.all_bars(spark, sf_dir)), ["symbol", "date"], ["close"], ["volume"])


# ---------------------------------------------------------------- step 7
from barlake.operators import upsert as U  # noqa: E402
from barlake.operators.instruments import initial_catalogue, instruments_from_bars  # noqa: E402

NOW = "2025-01-01 00:00:00"


def _now():
    return F.to_timestamp(F.lit(NOW))


def catalogue(spark, sf_dir, bars: DataFrame | None = None) -> DataFrame:
    bars = bars if bars is not None else fx.all_bars(spark, sf_dir)
    return initial_catalogue(spark, instruments_from_bars(bars), _now())


def q_upsert_instruments(spark, sf_dir):
    bars = materialize(fx.all_bars(spark, sf_dir))
    first_load = instruments_from_bars(bars.where((F.col("asset_type") == "stock") & (F.col("date") < "1998-01-01")))
    old = initial_catalogue(spark, first_load, F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    old = materialize(old.withColumn("name", F.concat(F.col("symbol"), F.lit(" Co"))))
    upd = instruments_from_bars(bars.where(F.col("date") >= "1997-01-01"))
    merged = U.upsert_instruments(old, upd, _now())
    return merged.select("id", "symbol", "name", "market", "asset_type", "sector_code", "listed_at", "delisted_at",
                         "is_active", (F.col("updated_at") == _now()).alias("touched"))


def gold_bars(spark, sf_dir):
    bars = materialize(fx.all_bars(spark, sf_dir))
    cat = materialize(catalogue(spark, sf_dir, bars))
    return cat, bars


def _present_gold(df):
    return df.select("ticker_id", "date", *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                     "volume", "open_interest")


def q_upsert_bars(spark, sf_dir):
    cat, bars = gold_bars(spark, sf_dir)
    target, _ = U.symbol_ids(cat, bars.where(F.col("date") < "1999-01-01"))
    revised = clean_bars(fx.raw_bars(spark, sf_dir)).where(F.col("date") >= "1998-07-01")
    updates, _ = U.symbol_ids(cat, revised)
    merged = U.upsert_bars(U.to_gold_bars(target), U.to_gold_bars(updates))
    return _present_gold(merged)


SCORE_COLUMNS = {"rank20": "returns_20d_rank", "rank5": "returns_5d_rank"}


def scored_features(spark, sf_dir) -> DataFrame:
    """The feature columns that predictions and outcomes are made of, built once."""
    return materialize(features(spark, sf_dir).select("symbol", "date", *SCORE_COLUMNS.values(), "label_direction_5d"))


def prediction_rows(f: DataFrame, models: tuple[str, ...] = tuple(SCORE_COLUMNS)) -> DataFrame:
    """Prediction rows by symbol for the named rank 'models' on every labelled feature row."""
    made = F.explode(F.array(*[F.struct(F.lit(m).alias("model_name"), finite_or_null(F.col(SCORE_COLUMNS[m])).alias("predicted_probability")) for m in models]))
    p = f.select("symbol", F.col("date").alias("prediction_date"), F.col("label_direction_5d").cast("int").alias("actual"), made.alias("p"))
    return p.select("symbol", "prediction_date", F.lit(5).alias("horizon_days"), "p.*", "actual").where("predicted_probability is not null").select(
        "*", F.lit("run1").alias("run_id"), (F.col("predicted_probability") >= 0.5).cast("int").alias("predicted_class"),
        F.lit(None).cast("int").alias("actual_class"), F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("created_at"))


def predictions(spark, sf_dir, f: DataFrame | None = None, cat: DataFrame | None = None) -> DataFrame:
    """Prediction rows of both models with instrument ids."""
    f = f if f is not None else features(spark, sf_dir)
    return U.symbol_ids(cat if cat is not None else catalogue(spark, sf_dir), prediction_rows(f))[0]


PRED_COLS = ["ticker_id", "prediction_date", "horizon_days", "model_name", "run_id",
             "predicted_probability", "predicted_class", "actual_class", "created_at"]


def q_upsert_predictions(spark, sf_dir):
    pr = materialize(predictions(spark, sf_dir))
    target = pr.where(F.col("prediction_date") < "1999-01-01").select(*PRED_COLS)
    target = target.withColumn("actual_class", F.when(F.col("prediction_date") < "1998-01-01", F.lit(1)).cast("int"))
    upd = pr.where(F.col("prediction_date") >= "1998-06-01").select(
        "ticker_id", "prediction_date", "horizon_days", "model_name", F.lit("run2").alias("run_id"),
        (F.col("predicted_probability") * 0.5 + 0.25).alias("predicted_probability"), "predicted_class")
    merged = U.upsert_predictions(target, upd, _now())
    return present(merged, ["ticker_id", "prediction_date", "horizon_days", "model_name", "run_id"],
                   ["predicted_probability"], ["predicted_class", "actual_class",
                                               (F.col("created_at") == _now()).alias("inserted")])


def q_actual_class_fill(spark, sf_dir):
    f, cat = scored_features(spark, sf_dir), materialize(catalogue(spark, sf_dir))
    pr = predictions(spark, sf_dir, f, cat)
    table = pr.select(*PRED_COLS).withColumn(
        "actual_class", F.when(F.col("prediction_date") < "1998-01-01", F.lit(0)).cast("int"))
    labels = f.select(
        "symbol", F.col("date").alias("prediction_date"), F.lit(5).alias("horizon_days"),
        F.col("label_direction_5d").alias("actual"))
    outcomes, _ = U.symbol_ids(cat, labels)
    filled = U.fill_actual_class(table, outcomes)
    return filled.groupBy("model_name", F.year("prediction_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("actual_class").alias("n_known"),
        F.sum("actual_class").cast("bigint").alias("n_up"),
        F.sum(F.when(F.col("actual_class") == F.col("predicted_class"), 1).otherwise(0)).cast("bigint").alias("n_hit"),
    )


def q_purge_symbols(spark, sf_dir):
    cat, bars = gold_bars(spark, sf_dir)
    gold, _ = U.symbol_ids(cat, bars)
    removed = cat.where(F.col("asset_type") == "index").select("id")
    kept = U.purge(U.to_gold_bars(gold), removed)
    return kept.groupBy("ticker_id").agg(F.count(F.lit(1)).alias("n_bars"), F.max("date").alias("last_date"))


# ---------------------------------------------------------------- step 8
def q_instrument_lookup(spark, sf_dir):
    return get_instrument(catalogue(spark, sf_dir), "^mkt").select("id", "symbol", "market", "asset_type", "listed_at")


def q_instrument_search(spark, sf_dir):
    page = list_instruments(catalogue(spark, sf_dir), page=1, page_size=500, search="brand#1")
    return page.select("id", "symbol", "market", "asset_type", "total")


def q_instrument_page(spark, sf_dir):
    page = list_instruments(catalogue(spark, sf_dir), page=2, page_size=5, market="jp", asset_type="stock")
    return page.select("id", "symbol", "listed_at", "total")


def q_last_n_bars(spark, sf_dir):
    return present(last_n_bars(fx.all_bars(spark, sf_dir), 10), ["symbol", "date", "recency"], ["close"])


def q_predictions_on_date(spark, sf_dir):
    pr = predictions_on_date(predictions(spark, sf_dir), "1999-03-15")
    return present(pr, ["ticker_id", "symbol", "model_name"], ["predicted_probability"], ["predicted_class"])


REQUEST = ["Brand#13", "Brand#21", "^MKT", "Brand#99", "Brand#5", "Brand#42"]


def q_latest_predictions(spark, sf_dir):
    asked = prediction_rows(features(spark, sf_dir).where(F.col("symbol").isin(REQUEST)), (MODEL,))
    latest = latest_row(asked.select("symbol", F.col("prediction_date").alias("date"), "predicted_probability", "predicted_class"))
    out_df = latest_for_symbols(latest, requested_symbols(spark, REQUEST))
    return present(out_df, ["pos", "symbol", "date"], ["predicted_probability"], ["predicted_class"])


QUERIES.update({
    "walk_forward_folds": q_walk_forward_folds,
    "fold_assignment": q_fold_assignment,
    "class_metrics": q_class_metrics,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "log_loss": q_log_loss,
    "run_metrics": q_run_metrics,
    "topk_picks": q_topk_picks,
    "portfolio_stats": q_portfolio_stats,
    "equity_curve": q_equity_curve,
    "latest_row": q_latest_row,
    "upsert_instruments": q_upsert_instruments,
    "upsert_bars": q_upsert_bars,
    "upsert_predictions": q_upsert_predictions,
    "actual_class_fill": q_actual_class_fill,
    "purge_symbols": q_purge_symbols,
    "instrument_lookup": q_instrument_lookup,
    "instrument_search": q_instrument_search,
    "instrument_page": q_instrument_page,
    "last_n_bars": q_last_n_bars,
    "predictions_on_date": q_predictions_on_date,
    "latest_predictions": q_latest_predictions,
})


# ---------------------------------------------------------------- step 10 (MLlib; rows-only check)
def _split_dates(spark, feats: DataFrame) -> dict:
    """Walk-forward bounds from the data's date range (one aggregated row)."""
    b = data_bounds(feats.select("date")).first()
    return {"train_start": b.train_start, "train_end": b.train_end, "val_start": b.val_start,
            "val_end": b.val_end, "n_splits": 3, "embargo_days": 5}


def _train(spark, sf_dir, model_name, params=None):
    from barlake.plans.train import run_metrics_table, train_one_model

    f = materialize(features(spark, sf_dir))  # the bounds and the folds read the same rows, built once
    res = train_one_model(spark, f, model_name, params=params, **_split_dates(spark, f))
    return present(run_metrics_table(res).drop("run_id"), ["model_name", "fold", "metric"], ["value"])


def q_train_logreg(spark, sf_dir):
    """Walk-forward logistic regression: per-fold validation metrics (long table)."""
    return _train(spark, sf_dir, "logreg")


#: Trees of the registered boosting query; a real run takes the model's default of 500.
GBT_PARAMS = {"n_estimators": 5, "max_depth": 3}


def q_train_gbt(spark, sf_dir):
    """Walk-forward gradient-boosted trees over all rows, ``GBT_PARAMS``: per-fold validation metrics (long table)."""
    return _train(spark, sf_dir, "gbt", GBT_PARAMS)


def q_score_latest(spark, sf_dir):
    """Fit logreg on the labelled history, then score every symbol's newest (unlabelled) row."""
    from barlake.plans.train import fit, predict_latest, prepare, usable_features

    labelled = features(spark, sf_dir)
    everything = features(spark, sf_dir, drop_unlabelled=False)
    from barlake.plans.features import input_columns

    cols = input_columns()
    train = materialize(prepare(labelled, cols, "label_direction_5d"))
    use = usable_features(train, cols)
    model = fit("logreg", train, use)
    scored = predict_latest(everything, model, "logreg", use)
    return present(scored, ["symbol", "prediction_date", "model_name"], ["predicted_probability"], ["predicted_class"])


def _fold_train_rows(spark, sf_dir) -> DataFrame:
    f = materialize(features(spark, sf_dir))
    return FO.assign_folds(f, data_folds(f)).where(F.col("role") == "train")


def q_model_medians(spark, sf_dir):
    """The exact medians that fill missing model inputs, for each fold."""
    from barlake.plans.features import input_columns

    m = PP.fit_quantiles(_fold_train_rows(spark, sf_dir), input_columns(), {"median": 0.5}, ["fold"])
    return present(m, ["fold", "column_name"], ["median"])


def q_model_weights(spark, sf_dir):
    """Training rows and class weights of both models, for each fold (a row for each fold and model)."""
    from barlake.plans.train import MODELS, class_weights

    counts = _fold_train_rows(spark, sf_dir).groupBy("fold").agg(F.count("*").alias("n"), F.sum("label_direction_5d").cast("bigint").alias("pos")).collect()
    rows = [(r.fold, name, r.n, *class_weights(name, r.n, float(r.pos))) for r in counts for name in MODELS]
    w = spark.createDataFrame(rows, "fold int, model_name string, n_rows bigint, weight_0 double, weight_1 double")
    return present(w, ["fold", "model_name", "n_rows"], ["weight_0", "weight_1"])


QUERIES.update({
    "train_logreg": q_train_logreg,
    "train_gbt": q_train_gbt,
    "model_medians": q_model_medians,
    "model_weights": q_model_weights,
    "score_latest": q_score_latest,
})


# ---------------------------------------------------------------- step 12 (config-declared options)
MISSING_COLS = [*INPUT_FLOATS, "obv", *[f"{c}_rank" for c in RANK_COLUMNS], "excess_returns_5d"]


def _train_rows(feats: DataFrame) -> DataFrame:
    """Rows up to the data-derived train end (statistics are fitted on these only)."""
    return feats.where(F.col("date") <= data_bounds(feats.select("date")).select("train_end").scalar())


def q_missing_ratio(spark, sf_dir):
    return present(PP.missing_ratios(features(spark, sf_dir), MISSING_COLS), ["column_name"], ["missing_ratio"])


def q_forward_fill(spark, sf_dir):
    filled = PP.forward_fill(features(spark, sf_dir).select("symbol", "date", *INPUT_FLOATS), INPUT_FLOATS)
    return present(filled, ["symbol", "date"], INPUT_FLOATS)


def _fitted_on_train(spark, sf_dir, fit, apply) -> DataFrame:
    f = materialize(features(spark, sf_dir).select("symbol", "date", *INPUT_FLOATS))
    return present(apply(f, fit(_train_rows(f), INPUT_FLOATS)), ["symbol", "date"], INPUT_FLOATS)


def q_winsorize(spark, sf_dir):
    return _fitted_on_train(spark, sf_dir, PP.fit_quantile_bounds, PP.winsorize)


def q_clip_iqr(spark, sf_dir):
    return _fitted_on_train(spark, sf_dir, PP.fit_iqr_bounds, PP.winsorize)


def q_robust_scale(spark, sf_dir):
    return _fitted_on_train(spark, sf_dir, PP.fit_robust_scale, PP.scale)


def q_standard_scale(spark, sf_dir):
    return _fitted_on_train(spark, sf_dir, PP.fit_standard_scale, PP.scale)


def q_date_bounds(spark, sf_dir):
    """Bars between two dates, both included."""
    bars = PP.date_bounds(fx.all_bars(spark, sf_dir), "1996-02-29", "1999-12-31")
    return bars.groupBy("symbol").agg(F.count("*").alias("n_bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


QUERIES.update({
    "missing_ratio": q_missing_ratio,
    "forward_fill": q_forward_fill,
    "winsorize": q_winsorize,
    "robust_scale": q_robust_scale,
    "clip_iqr": q_clip_iqr,
    "standard_scale": q_standard_scale,
    "date_bounds": q_date_bounds,
})


def q_forward_volatility(spark, sf_dir):
    """Config target type 'volatility': std of the next 5 daily returns per symbol."""
    from barlake.operators.labels import add_forward_volatility

    df = add_forward_volatility(T.add_returns(fx.all_bars(spark, sf_dir), (1,)), 5)
    return present(df, ["symbol", "date"], ["label_volatility_5d"])


QUERIES["forward_volatility"] = q_forward_volatility


def q_portfolio_rebalanced(spark, sf_dir):
    """Top-3 picks only on every 5th trading date (config rebalance option), 5 bps."""
    stats = P.backtest_rebalanced(scored(spark, sf_dir), "ret", top_k=3, every_n=5, transaction_cost_bps=5.0, score="p")
    return present(stats, ["top_k", "cost_bps", "n_trades"], ["cumulative_return", "annualised_return",
                   "annualised_volatility", "sharpe_ratio", "max_drawdown", "win_rate"])


QUERIES["portfolio_rebalanced"] = q_portfolio_rebalanced


def q_portfolio_capped(spark, sf_dir):
    """Top-3 picks on the first date of each week and month, a quarter of the capital a position at most."""
    s = materialize(scored(spark, sf_dir))
    rows = [P.capped_returns(s, "ret", 3, 0.25, f, score="p").withColumn("frequency", F.lit(f)) for f in ("weekly", "monthly")]
    return present(rows[0].unionByName(rows[1]), ["frequency", "date", "n_picks"], ["weight", "gross_return", "net_return"])


QUERIES["portfolio_capped"] = q_portfolio_capped


def q_portfolio_capital(spark, sf_dir):
    """The capital option: a million over the monthly capped picks, returns taken as percent; logarithms, as products span magnitudes."""
    s = materialize(scored(spark, sf_dir).withColumn("ret", F.col("ret") / 100.0))
    curve = P.capital_curve(P.capped_returns(s, "ret", 3, 0.25, "monthly", score="p"), 1_000_000.0)
    return present(curve.withColumn("log_capital", F.ln("capital")), ["date", "n_picks"], ["net_return", "log_capital", "drawdown"])


QUERIES["portfolio_capital"] = q_portfolio_capital


# ---------------------------------------------------------------- step 13 (small operators on their own)
from barlake.operators.lookups import number_pages, page_ranges  # noqa: E402


def q_requested_bars(spark, sf_dir):
    """all bars of the requested symbols."""
    return present(fx.all_bars(spark, sf_dir).join(F.broadcast(requested_symbols(spark, REQUEST)), "symbol", "left_semi"), ["symbol", "date"], ["close"])


def q_instrument_pages(spark, sf_dir):
    """O1-O3: every page of seven instruments, in order, with the number of pages."""
    return number_pages(materialize(catalogue(spark, sf_dir)), 7).select("page", "symbol", "total", "pages")


#: Window lists beyond the defaults; the sliding frames of the long ones cost no more than those of the short ones.
PRICE_WINDOWS, VOLUME_WINDOWS, SLIDING_WINDOWS = (5, 20, 60, 300), (5, 20, 250), (5, 60, 250, 1000)


def q_feature_windows(spark, sf_dir):
    """The feature build with configured window lists."""
    settings = FeatureSettings(market_index_symbol=fx.INDEX_SYMBOL, price_windows=PRICE_WINDOWS, volume_windows=VOLUME_WINDOWS)
    f = build_feature_frame(fx.all_bars(spark, sf_dir), settings)
    names = [*[f"{c}_{n}d" for n in PRICE_WINDOWS for c in ("returns", "log_returns", "volatility")], *[f"volume_zscore_{n}d" for n in VOLUME_WINDOWS], "returns_20d_rank"]
    return present(f, ["symbol", "date"], names)


def q_sliding_frames(spark, sf_dir):
    """Mean, deviation, least and largest logarithm of the close over trailing windows of 5 to 1,000 bars."""
    specs = [(agg, "level", n, f"{agg}_{n}") for n in SLIDING_WINDOWS for agg in T.SLIDING]
    return present(T.add_sliding(fx.all_bars(spark, sf_dir).withColumn("level", F.ln("close")), specs), ["symbol", "date"], [s[3] for s in specs])


def q_instrument_page_ranges(spark, sf_dir):
    """The range of keys of each page of four stocks."""
    return page_ranges(materialize(catalogue(spark, sf_dir)), 4, asset_type="stock")


def q_fill_zero(spark, sf_dir):
    f = features(spark, sf_dir).select("symbol", "date", *INPUT_FLOATS)
    return present(PP.fill_zero(f, INPUT_FLOATS), ["symbol", "date"], INPUT_FLOATS)


def q_impute_median(spark, sf_dir):
    """Missing values take the column's exact median over the training rows."""
    from barlake.plans.train import fitted_medians, impute_medians

    f = materialize(features(spark, sf_dir).select("symbol", "date", *[finite_or_null(F.col(c)).alias(c) for c in INPUT_FLOATS]))
    filled = impute_medians(INPUT_FLOATS, fitted_medians(_train_rows(f), INPUT_FLOATS)).transform(f)
    return present(filled.select("symbol", "date", *[F.col(f"{c}__imp").alias(c) for c in INPUT_FLOATS]), ["symbol", "date"], INPUT_FLOATS)


def q_drop_sparse(spark, sf_dir):
    """The columns left without those that miss over 30 % of their values, and how many values each has."""
    left = PP.drop_sparse_columns(materialize(features(spark, sf_dir).select(*MISSING_COLS)), MISSING_COLS, 0.3)
    pairs = ", ".join(f"'{c}', count(nullif(CAST(`{c}` AS DOUBLE), CAST('NaN' AS DOUBLE)))" for c in left.columns)
    return left.selectExpr(f"stack({len(left.columns)}, {pairs}) AS (column_name, n_values)")


def q_test_range(spark, sf_dir):
    """Rows of each role with a held-out range from 2000 on."""
    f = materialize(features(spark, sf_dir).select("symbol", "date"))
    a = FO.assign_folds(f, FO.with_test_range(data_folds(f), "2000-01-01"))
    return a.groupBy("fold", "role").agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def q_latest_run(spark, sf_dir):
    """The newest finished run of a model, over a run table with one row for each event."""
    from barlake.plans.train import latest_finished_run

    e = fx.table(spark, sf_dir, "events")
    runs = e.select(F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("model_name"), "ts",
                    F.when(F.col("event_id") % 3 == 0, "FAILED").otherwise("FINISHED").alias("status"), F.concat(F.lit("models/"), F.col("event_id")).alias("model_path"))
    found = [latest_finished_run(runs, m) for m in ("click", "purchase", "no such model")]
    return reduce(DataFrame.unionByName, found).select("model_name", "run_id", "model_path")


QUERIES.update({
    "requested_bars": q_requested_bars,
    "instrument_pages": q_instrument_pages,
    "instrument_page_ranges": q_instrument_page_ranges,
    "feature_windows": q_feature_windows,
    "sliding_frames": q_sliding_frames,
    "fill_zero": q_fill_zero,
    "impute_median": q_impute_median,
    "drop_sparse": q_drop_sparse,
    "test_range": q_test_range,
    "latest_run": q_latest_run,
})
