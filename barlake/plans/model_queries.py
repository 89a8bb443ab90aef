"""Registered queries that check model fits, scores and records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.numeric import out
from barlake.operators.folds import assign_folds
from barlake.plans import model_tables as MT
from barlake.plans import train as TR
from barlake.plans.features import input_columns
from barlake.plans.queries import GBT_PARAMS, _now, _split_dates, catalogue, data_folds, features
from barlake.session import materialize, scratch_path

LABEL = "label_direction_5d"
#: Inputs of the small fit that SQL repeats; its C; and a tolerance at which both solvers agree to four digits.
SMALL_INPUTS = ("returns_20d_rank", "rsi_14", "volume_zscore_20d")
SMALL_PARAMS = {"C": 0.01, "max_iter": 1000, "tol": 1e-13}
#: Largest entry of the gradient at a fit that counts as its optimum.
FLAT = 1e-3


def fold_rows(spark, sf_dir, cols) -> DataFrame:
    """(fold, symbol, date, inputs, label) of the training rows of each fold, stored."""
    f = features(spark, sf_dir)
    return materialize(assign_folds(TR.prepare(f, list(cols), LABEL), data_folds(f)).where(F.col("role") == "train"))


def folds_of(rows: DataFrame) -> list[int]:
    return sorted(r.fold for r in rows.select("fold").distinct().collect())


def fitted_tables(spark, rows: DataFrame, fold: int, cols, params=None):
    """A fold's training rows with their weights, its fit as a table and the penalty."""
    train = rows.where(F.col("fold") == fold)
    use = TR.usable_features(train, list(cols))
    medians = TR.fitted_medians(train, use)
    model = TR.fit("logreg", train, use, params, medians=medians)
    weighted, n = TR.with_class_weights(train, "logreg")
    c = (params or {}).get("C", 1.0)
    return weighted, MT.export_logreg(spark, model, use, medians), 1.0 / (c * n), model


def q_logreg_coefficients(spark, sf_dir):
    """The fit itself: coefficients of a small model for each fold, which the SQL fits by gradient steps of its own."""
    rows, found = fold_rows(spark, sf_dir, SMALL_INPUTS), None
    for k in folds_of(rows):
        t = fitted_tables(spark, rows, k, SMALL_INPUTS, SMALL_PARAMS)[1]
        t = t.select(F.lit(k).alias("fold"), "feature", out(F.col("coefficient"), 4).alias("coefficient"))
        found = t if found is None else found.unionByName(t)
    return found


def q_logreg_gradient(spark, sf_dir):
    """Certificate of the full fits: the gradient of the penalised loss is flat in every direction, over all training rows."""
    rows, found = fold_rows(spark, sf_dir, input_columns()), None
    for k in folds_of(rows):
        weighted, t, reg, _ = fitted_tables(spark, rows, k, input_columns())
        g = MT.logreg_gradient(weighted, t, reg).select(F.lit(k).alias("fold"), "feature", "n_rows", (F.abs("gradient") < FLAT).alias("flat"))
        found = g if found is None else found.unionByName(g)
    return found


def latest_rows(spark, sf_dir) -> DataFrame:
    """The newest feature row of each symbol, prepared for scoring."""
    from barlake.functions.numeric import finite_or_null
    from barlake.operators.lookups import latest_row

    latest = latest_row(features(spark, sf_dir, drop_unlabelled=False).select("symbol", "date", *input_columns()))
    return materialize(latest.select("symbol", "date", *[finite_or_null(F.col(c)).alias(c) for c in input_columns()]))


def q_logreg_table_scores(spark, sf_dir):
    """Every symbol's newest row scored by the model and, by plain expressions, from its exported table."""
    train = materialize(TR.prepare(features(spark, sf_dir), input_columns(), LABEL))
    use = TR.usable_features(train, input_columns())
    medians = TR.fitted_medians(train, use)
    model = TR.fit("logreg", train, use, medians=medians)
    table = MT.export_logreg(spark, model, use, medians)
    rows = latest_rows(spark, sf_dir)
    scored = model.transform(rows.withColumn("own", MT.logreg_probability(table))).withColumn("p", TR.probability_column())
    return scored.select("symbol", F.col("date").alias("prediction_date"), F.col("p").between(0.0, 1.0).alias("is_probability"),
                         (F.abs(F.col("p") - F.col("own")) < 1e-9).alias("same"))


def q_gbt_table_scores(spark, sf_dir):
    """All labelled rows scored by the boosted trees and from their table of nodes."""
    rows = materialize(TR.prepare(features(spark, sf_dir), input_columns(), LABEL))
    use = TR.usable_features(rows, input_columns())
    medians = TR.fitted_medians(rows, use)
    model = TR.fit("gbt", rows, use, GBT_PARAMS, medians=medians)
    nodes = materialize(MT.export_trees(spark, model, use, scratch_path(spark, f"trees-{uuid.uuid4().hex}")))
    scored = materialize(model.transform(rows).withColumn("p", TR.probability_column()).select("symbol", "date", *[f"{c}__imp" for c in use], "p"))
    own = MT.score_trees(scored, nodes.withColumn("feature", F.concat("feature", F.lit("__imp"))), [f"{c}__imp" for c in use])
    return own.groupBy("symbol").agg(F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("p") - F.col("probability")) < 1e-9).alias("n_same"))


def q_run_records(spark, sf_dir):
    """Both models and one that does not exist, trained side by side: run records and metrics by fold."""
    f = materialize(features(spark, sf_dir))
    root = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    models = {"logreg": {"params": {"max_iter": 20}}, "gbt": {"params": {"n_estimators": 2, "max_depth": 2}}, "no such model": {}, "off": {"enabled": False}}
    TR.train_all(spark, f, root, _split_dates(spark, f), models, parallelism=3)
    runs = spark.read.parquet(f"{root}/runs")
    m = spark.read.parquet(f"{root}/run_metrics").where("metric in ('val_positive_rate', 'val_baseline_majority_accuracy')")
    m = m.groupBy("run_id", "fold").pivot("metric", ["val_positive_rate", "val_baseline_majority_accuracy"]).agg(F.first("value"))
    return runs.join(m, "run_id", "left").select(
        "model_name", "status", F.col("n_features").cast("bigint").alias("n_features"), F.col("model_path").isNotNull().alias("has_model"), "fold",
        out(F.col("val_positive_rate")).alias("positive_rate"), out(F.col("val_baseline_majority_accuracy")).alias("majority"))


def q_predict_store(spark, sf_dir):
    """M9: the newest row of all symbols scored and stored twice; the second run replaces the first's rows."""
    train = materialize(TR.prepare(features(spark, sf_dir), input_columns(), LABEL))
    use = TR.usable_features(train, input_columns())
    model = TR.fit("logreg", train, use, {"max_iter": 20})
    everything = materialize(features(spark, sf_dir, drop_unlabelled=False).select("symbol", "date", *use))
    cat, path = materialize(catalogue(spark, sf_dir)), scratch_path(spark, f"predictions-{uuid.uuid4().hex}")
    some = cat.where("asset_type = 'index'").select("symbol")
    TR.predict_and_store(everything, model, "logreg", use, cat, path, "run1")
    TR.predict_and_store(everything, model, "logreg", use, cat, path, "run2", symbols=some)
    stored = spark.read.parquet(path)
    return stored.select("ticker_id", "prediction_date", "horizon_days", "model_name", "run_id",
                         (F.col("predicted_class") == (F.col("predicted_probability") >= 0.5).cast("int")).alias("class_follows"),
                         F.col("actual_class").isNull().alias("open"))


QUERIES = {
    "logreg_coefficients": q_logreg_coefficients,
    "logreg_gradient": q_logreg_gradient,
    "logreg_table_scores": q_logreg_table_scores,
    "gbt_table_scores": q_gbt_table_scores,
    "run_records": q_run_records,
    "predict_store": q_predict_store,
}
