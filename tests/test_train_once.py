"""The training queries build their features once."""

from __future__ import annotations

from barlake.plans import queries as Q
from barlake.plans import train as T


def test_training_reads_features_built_once(spark, monkeypatch):
    bars = "SELECT concat('S', id % 3) AS symbol, date_add(DATE'2020-01-01', CAST(id DIV 3 AS INT)) AS date FROM range(90)"
    seen = []
    monkeypatch.setattr(Q, "features", lambda *a, **k: spark.sql(bars).withColumn("built", Q.F.uuid()))
    monkeypatch.setattr(Q, "_split_dates", lambda spark, f: seen.append(f) or {})
    monkeypatch.setattr(T, "train_one_model", lambda spark, f, name, params=None: seen.append(f))
    monkeypatch.setattr(T, "run_metrics_table", lambda result: spark.createDataFrame([("r", "m", 1, "x", 0.5)], "run_id string, model_name string, fold int, metric string, value double"))
    Q._train(spark, "none", "gbt")
    bounds, fitted = [{r.built for r in f.collect()} for f in seen]
    assert len(bounds) == 90 and bounds == fitted
    assert "parquet" in seen[0]._jdf.queryExecution().executedPlan().toString().lower()
