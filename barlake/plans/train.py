"""Model training, scoring and run records on MLlib.

* Registry (M4): a table of model name -> stages and defaults; unknown names raise.
* ``logreg``: exact median imputation -> standardisation -> L2 logistic regression
  with balanced class weights; ``regParam = 1 / (C * N)`` makes MLlib's
  mean-loss objective the reference's ``C``-scaled sum objective.
* ``gbt``: gradient-boosted trees with ``scale_pos_weight`` as instance
  weights; NaN/inf are imputed first (MLlib trees reject NaN).
* Training (M5): per walk-forward fold fit on train rows, score validation
  rows, exact metrics (V1-V6) per fold; then refit on train_start..val_end.
  The prepared frame is written once to the checkpoint folder and shared by
  every fold (short lineage for the iterative solvers, survives executor loss).
* Runs (M10, M11): ``runs`` and ``run_metrics`` tables; the newest FINISHED
  run of a model is found with ``max_by``.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from queue import Queue
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.numeric import finite_or_null
from barlake.operators.folds import walk_forward_splits
from barlake.operators.metrics import compute_metrics, metrics_long
from barlake.operators.preprocessing import fit_quantiles
from barlake.operators.upsert import symbol_ids
from barlake.plans.features import input_columns
from barlake.plans.ingest import write_predictions
from barlake.session import materialize

def _imputed(cols: list[str]) -> list[str]:
    return [f"{c}__imp" for c in cols]


def impute_medians(cols: list[str], medians: dict[str, float]) -> SQLTransformer:
    """NULL -> the training median (0 for a column without values), as a stage that is saved with the model."""
    filled = ", ".join(f"coalesce(`{c}`, CAST('{medians.get(c) or 0.0!r}' AS DOUBLE)) AS `{c}__imp`" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def logreg_stages(cols: list[str], params: dict) -> list:
    return [
        VectorAssembler(inputCols=_imputed(cols), outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                           regParam=1.0 / (params["C"] * max(params["n_rows"], 1)), elasticNetParam=0.0,
                           standardization=False, maxIter=int(params["max_iter"]), tol=float(params["tol"])),
    ]


def gbt_stages(cols: list[str], params: dict) -> list:
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                          maxIter=int(params["n_estimators"]), maxDepth=int(params["max_depth"]),
                          stepSize=float(params["learning_rate"]), subsamplingRate=float(params["subsample"]),
                          featureSubsetStrategy=str(params["colsample"]), minInstancesPerNode=int(params["min_child_weight"]),
                          validationTol=float(params["validation_tol"]), seed=42)
    if params["validated"]:  # training stops when a further tree no longer helps the validation rows
        trees = trees.setValidationIndicatorCol("is_val")
    return [VectorAssembler(inputCols=_imputed(cols), outputCol="features", handleInvalid="keep"), trees]


# Name -> (stages after imputation, default parameters).
MODELS: dict[str, tuple[Callable[[list[str], dict], list], dict]] = {
    "logreg": (logreg_stages, {"C": 1.0, "max_iter": 1000, "tol": 1e-4}),
    "gbt": (gbt_stages, {"n_estimators": 500, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8,
                         "colsample": 0.8, "min_child_weight": 5, "validation_tol": 0.01}),
}


def prepare(df: DataFrame, feature_cols: list[str], label_col: str) -> DataFrame:
    """M1: drop unlabelled rows, +-inf/NaN -> NULL (imputed later), label as double."""
    return df.where(F.col(label_col).isNotNull()).select(
        "symbol", "date",
        *[finite_or_null(F.col(c)).alias(c) for c in feature_cols],
        F.col(label_col).cast("double").alias("label"),
    )


def usable_features(train: DataFrame, feature_cols: list[str]) -> list[str]:
    """Columns with at least one value on the training side (MLlib's Imputer rejects all-NULL columns)."""
    row = train.agg(*[F.count(c).alias(c) for c in feature_cols]).first()
    return [c for c in feature_cols if row[c] > 0]


def fitted_medians(train: DataFrame, cols: list[str]) -> dict[str, float]:
    """The exact median of each column (its lower one for an even count)."""
    return {r.column_name: r.median for r in fit_quantiles(train, cols, {"median": 0.5}).collect()}


def class_weights(model_name: str, n: int, pos: float) -> tuple[float, float]:
    """A4: (weight of 0, weight of 1): balanced N / (2 N_class) for logreg, neg / pos on positives for gbt."""
    neg = n - pos
    if model_name == "gbt":
        return 1.0, neg / pos if pos else 1.0
    return (n / (2 * neg) if neg else 1.0), (n / (2 * pos) if pos else 1.0)


def with_class_weights(train: DataFrame, model_name: str) -> tuple[DataFrame, int]:
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
    zero, one = class_weights(model_name, row["n"], float(row["pos"] or 0.0))
    return train.withColumn("weight", F.when(F.col("label") == 1.0, F.lit(one)).otherwise(F.lit(zero))), row["n"]


def probability_column() -> Column:
    """M7: probability of the positive class (not the predicted label)."""
    return vector_to_array(F.col("probability")).getItem(1)


def fit(model_name: str, train: DataFrame, feature_cols: list[str], params: dict | None = None,
        validation: DataFrame | None = None, medians: dict[str, float] | None = None) -> PipelineModel:
    """``medians``: those of the training rows, if they are known already."""
    if model_name not in MODELS:
        raise KeyError(f"unknown model {model_name!r}; there are {sorted(MODELS)}")
    stages, defaults = MODELS[model_name]
    data, n = with_class_weights(train, model_name)
    validated = validation is not None and model_name == "gbt"
    if validated:
        data = data.withColumn("is_val", F.lit(False)).unionByName(validation.withColumns({"weight": F.lit(1.0), "is_val": F.lit(True)}))
    own = {**defaults, **(params or {}), "n_rows": n, "validated": validated}
    medians = fitted_medians(train, feature_cols) if medians is None else medians
    return Pipeline(stages=[impute_medians(feature_cols, medians), *stages(feature_cols, own)]).fit(data)


def score_frame(model: PipelineModel, df: DataFrame, model_name: str, threshold: float = 0.5,
                horizon_days: int = 5) -> DataFrame:
    """M7: (symbol, date, horizon, model, probability, class) for every row of ``df``."""
    scored = model.transform(df).withColumn("predicted_probability", probability_column())
    return scored.select(
        "symbol", F.col("date").alias("prediction_date"), F.lit(horizon_days).alias("horizon_days"),
        F.lit(model_name).alias("model_name"), "predicted_probability",
        (F.col("predicted_probability") >= threshold).cast("int").alias("predicted_class"),
        *([F.col("label")] if "label" in df.columns else []),
    )


def side_by_side(spark: SparkSession, tasks: list[Callable[[], Any]], parallelism: int) -> list[Any]:
    """The results of ``tasks``, ``parallelism`` of which run at a time.

    Each worker's jobs go to a scheduler pool of its own (fair between pools where
    ``spark.scheduler.mode`` is FAIR), so that the tails of one fit leave no executor idle.
    """
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    pools: Queue[str] = Queue()
    for i in range(parallelism):
        pools.put(f"fit-{i}")

    def run(task: Callable[[], Any]) -> Any:
        pool = pools.get()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        try:
            return task()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
            pools.put(pool)

    with ThreadPoolExecutor(parallelism) as workers:
        running = [workers.submit(inheritable_thread_target(spark)(partial(run, t))) for t in tasks]
        return [r.result() for r in running]


@dataclass
class TrainResult:
    run_id: str
    model: PipelineModel | None
    metrics: DataFrame | None
    feature_cols: list[str]


def train_one_model(spark: SparkSession, features: DataFrame, model_name: str, train_start, train_end, val_start,
                    val_end, n_splits: int = 1, embargo_days: int = 5, horizon_days: int = 5,
                    params: dict | None = None, expanding: bool = True, parallelism: int = 1) -> TrainResult:
    """M5: walk-forward folds -> fit/score/metrics per fold -> final refit.

    ``parallelism`` of these fits run at a time; the result does not depend on it.
    """
    label_col = f"label_direction_{horizon_days}d"
    feature_cols = input_columns()
    folds = walk_forward_splits(spark, train_start, train_end, val_start, val_end, n_splits, embargo_days, expanding)
    bounds = [r.asDict() for r in folds.orderBy("fold").collect()]  # n_splits rows of parameters
    # written once to the checkpoint folder: every fold, every solver iteration
    # and the refit read a short lineage instead of the feature pipeline
    data = materialize(prepare(features, feature_cols, label_col))
    d = F.col("date")

    def one_fold(b: dict) -> DataFrame | None:
        train = data.where(d.between(F.lit(b["train_start"]), F.lit(b["train_end"])))
        val = data.where(d.between(F.lit(b["val_start"]), F.lit(b["val_end"])))
        if train.isEmpty() or val.isEmpty():
            return None
        cols = usable_features(train, feature_cols)
        model = fit(model_name, train, cols, params, validation=val)
        scored = score_frame(model, val, model_name, horizon_days=horizon_days)
        m = compute_metrics(scored.withColumn("fold", F.lit(b["fold"])), ["fold"], score="predicted_probability", label="label")
        return materialize(m.withColumn("model_name", F.lit(model_name)))  # computed here, beside the other folds

    def refit() -> PipelineModel | None:
        full = data.where(d.between(F.lit(bounds[-1]["train_start"]), F.lit(bounds[-1]["val_end"])))
        return fit(model_name, full, usable_features(full, feature_cols), params) if not full.isEmpty() else None

    run_id = uuid.uuid4().hex
    if not bounds:
        return TrainResult(run_id, None, None, feature_cols)
    *per_fold, final = side_by_side(spark, [*[partial(one_fold, b) for b in bounds], refit], parallelism)
    per_fold = [m for m in per_fold if m is not None]
    metrics = reduce(DataFrame.unionByName, per_fold) if per_fold else None
    return TrainResult(run_id, final, metrics, feature_cols)


def run_metrics_table(result: TrainResult) -> DataFrame:
    """Long (run_id, model_name, fold, metric, value) rows."""
    long = metrics_long(result.metrics, ["model_name", "fold"], prefix="val_")
    return long.withColumn("run_id", F.lit(result.run_id)).select("run_id", "model_name", "fold", "metric", "value")


def record_run(spark: SparkSession, runs_root: str, model_name: str, result: TrainResult | None, params: dict,
               status: str, model_path: str | None = None, error: str | None = None) -> None:
    """Append one run row (flattened params, feature count and names as JSON, failure text) and its metrics."""
    run_id = result.run_id if result else uuid.uuid4().hex
    features = result.feature_cols if result else []
    row = [(run_id, model_name, status, json.dumps(_flat(params), sort_keys=True, default=str), len(features), json.dumps(features), model_path, error)]
    spark.createDataFrame(row, "run_id string, model_name string, status string, params string, n_features int, features string, model_path string, error string") \
        .withColumn("ts", F.current_timestamp()) \
        .write.mode("append").parquet(os.path.join(runs_root, "runs"))
    if result is not None and result.metrics is not None:
        run_metrics_table(result).withColumn("ts", F.current_timestamp()) \
            .write.mode("append").parquet(os.path.join(runs_root, "run_metrics"))


def _flat(d: dict, prefix: str = "") -> dict:
    out = {}
    for k, v in d.items():
        key = f"{prefix}{k}"
        if isinstance(v, dict):
            out.update(_flat(v, key + "."))
        else:
            out[key] = v
    return out


def latest_finished_run(runs: DataFrame, model_name: str) -> DataFrame:
    """Newest FINISHED run of ``model_name`` (one row)."""
    done = runs.where((F.col("status") == "FINISHED") & (F.col("model_name") == model_name))
    return done.groupBy("model_name").agg(F.max_by(F.struct("run_id", "model_path", "ts"), "ts").alias("r")) \
        .select("model_name", "r.run_id", "r.model_path", "r.ts")


def train_all(spark: SparkSession, features: DataFrame, runs_root: str, split: dict, models: dict[str, dict],
              horizon_days: int = 5, parallelism: int = 1) -> dict[str, str | None]:
    """M6: train every enabled model; one model's failure is recorded, not raised.

    ``parallelism`` models are trained at a time, and so many fits of each; their records
    are written one after another when all have ended.
    """
    enabled = {name: spec for name, spec in models.items() if spec.get("enabled", True)}

    def train(name: str, spec: dict) -> tuple[TrainResult | None, str | None, str | None]:
        try:
            res = train_one_model(spark, features, name, horizon_days=horizon_days, params=spec.get("params"), parallelism=parallelism, **split)
            path = None
            if res.model is not None:
                path = os.path.join(runs_root, "models", res.run_id)
                res.model.write().overwrite().save(path)
            return res, path, None
        except Exception as e:  # noqa: BLE001 - isolate one model's failure (reference behaviour)
            return None, None, f"{type(e).__name__}: {e}"[:2000]

    out: dict[str, str | None] = {}
    found = side_by_side(spark, [partial(train, name, spec) for name, spec in enabled.items()], parallelism)
    for (name, spec), (res, path, error) in zip(enabled.items(), found):
        asked = {"model": name, "horizon_days": horizon_days, **split, **(spec.get("params") or {})}
        record_run(spark, runs_root, name, res, asked, "FINISHED" if res else "FAILED", path, error)
        out[name] = res.run_id if res else None
    return out


def predict_latest(features_all: DataFrame, model: PipelineModel, model_name: str, feature_cols: list[str],
                   symbols: DataFrame | None = None, horizon_days: int = 5) -> DataFrame:
    """M8/M9: score each symbol's newest feature row (built with unlabelled rows kept).

    ``symbols`` is a one-column DataFrame of requested symbols (semi-join);
    None scores every symbol, set-based.
    """
    from barlake.operators.lookups import latest_row

    df = features_all if symbols is None else features_all.join(symbols, "symbol", "left_semi")
    latest = latest_row(df.select("symbol", "date", *feature_cols))
    prepared = latest.select("symbol", "date", *[finite_or_null(F.col(c)).alias(c) for c in feature_cols])
    return score_frame(model, prepared, model_name, horizon_days=horizon_days)


def predict_and_store(features_all: DataFrame, model: PipelineModel, model_name: str, feature_cols: list[str], catalogue: DataFrame,
                      path: str, run_id: str, symbols: DataFrame | None = None, horizon_days: int = 5) -> DataFrame:
    """M9: score the newest row of all (or the given) symbols, upsert into the predictions table, return the scores.

    Scores of symbols that the catalogue lacks are returned, but not stored.
    """
    scored = materialize(predict_latest(features_all, model, model_name, feature_cols, symbols, horizon_days))
    known, _ = symbol_ids(catalogue, scored)
    write_predictions(known.select("ticker_id", "prediction_date", "horizon_days", "model_name", F.lit(run_id).alias("run_id"), "predicted_probability",
                                   "predicted_class", F.lit(None).cast("int").alias("actual_class"), F.current_timestamp().alias("created_at")), path)
    return scored
