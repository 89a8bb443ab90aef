"""Persisted jobs: feature build (B2/P3), predictions upsert (U3), train_all + run records."""

from __future__ import annotations

import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from barlake.plans import train as TR
from barlake.plans.features import PARTITION_COLUMN, FeatureSettings, build_features
from barlake.plans.ingest import write_predictions, write_silver
from barlake.sources.fixtures import all_bars


def test_build_features_job_writes_year_partitions(spark, sf_small):
    work = tempfile.mkdtemp(prefix="feat-")
    silver, processed = os.path.join(work, "silver"), os.path.join(work, "processed")
    write_silver(all_bars(spark, sf_small), silver)
    build_features(spark, silver, processed, market="jp", settings=FeatureSettings(market_index_symbol="^MKT"))
    out = spark.read.parquet(processed)
    assert PARTITION_COLUMN in out.columns and "year" in out.columns
    assert out.where(F.col(PARTITION_COLUMN) != F.col("year")).count() == 0
    assert out.where(F.col("label_direction_5d").isNull()).count() == 0
    kept = out.select("symbol").distinct().count()
    counts = all_bars(spark, sf_small).groupBy("symbol").count()
    assert kept == counts.where(F.col("count") >= 250).count()
    limited = os.path.join(work, "limited")
    build_features(spark, silver, limited, market="jp", settings=FeatureSettings(min_history_days=250, market_index_symbol="^MKT", symbols=3))
    names = {r.symbol for r in spark.read.parquet(limited).select("symbol").distinct().collect()}
    assert names == {r.symbol for r in counts.where("count >= 250").orderBy("symbol").limit(3).collect()}  # symbols with enough history count
    with pytest.raises(RuntimeError):
        build_features(spark, silver, limited, market="jp", settings=FeatureSettings(min_history_days=10**6))
    with pytest.raises(FileNotFoundError):
        build_features(spark, silver, limited, market="us")


def test_write_predictions_idempotent_and_keeps_actual(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pred-"), "predictions")
    schema = ("ticker_id long, prediction_date date, horizon_days int, model_name string, run_id string, "
              "predicted_probability double, predicted_class int, actual_class int, created_at timestamp")
    first = spark.createDataFrame([(1, date(2024, 1, 2), 5, "m", "r1", 0.7, 1, 1, None),
                                   (2, date(2024, 4, 2), 5, "m", "r1", 0.2, 0, None, None)], schema)
    write_predictions(first, path)
    upd = spark.createDataFrame([(1, date(2024, 1, 2), 5, "m", "r2", 0.4, 0, None, None)], schema)
    write_predictions(upd, path)
    write_predictions(upd, path)
    rows = {r.ticker_id: r for r in spark.read.parquet(path).collect()}
    assert len(rows) == 2
    assert rows[1].run_id == "r2" and rows[1].predicted_probability == 0.4 and rows[1].actual_class == 1
    assert rows[2].run_id == "r1"


def test_train_all_records_runs(spark, sf_small):
    from barlake.plans.queries import features

    f = features(spark, sf_small)
    runs = tempfile.mkdtemp(prefix="runs-")
    split = {"train_start": "1995-01-01", "train_end": "1999-12-31", "val_start": "2000-01-10", "val_end": "2001-12-31",
             "n_splits": 1, "embargo_days": 5}
    out = TR.train_all(spark, f, runs, split, {"logreg": {"enabled": True}, "lightgbm": {"enabled": False},
                                               "nope": {"enabled": True}})
    assert out["logreg"] is not None and out["nope"] is None and "lightgbm" not in out
    recs = spark.read.parquet(os.path.join(runs, "runs"))
    assert {r.model_name: r.status for r in recs.collect()} == {"logreg": "FINISHED", "nope": "FAILED"}
    latest = TR.latest_finished_run(recs, "logreg").first()
    assert latest.run_id == out["logreg"] and os.path.isdir(latest.model_path)
    metrics = spark.read.parquet(os.path.join(runs, "run_metrics"))
    assert metrics.where(F.col("metric") == "val_roc_auc").count() == 1


def test_remove_scratch(spark):
    import os

    from barlake import session

    kept = list(session._SCRATCH)
    session._SCRATCH.clear()
    df = session.materialize(spark.range(3))
    folder = df.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    session.scratch_path(spark, "never-written")
    assert os.path.isdir(folder) and session.remove_scratch(spark) == 1 and not os.path.exists(folder)
    assert session.remove_scratch(spark) == 0
    session._SCRATCH.extend(kept)
