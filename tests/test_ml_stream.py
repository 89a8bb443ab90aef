"""MLlib models on a planted signal, streaming ingest, preprocessing."""

from __future__ import annotations

import os
import tempfile
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.operators import preprocessing as PP
from barlake.operators.metrics import compute_metrics
from barlake.plans import train as TR
from barlake.streaming.ingest import start_ingest_stream


def planted(spark, n=1500, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x1, x2 = float(rng.normal()), float(rng.normal())
        y = float(x1 + 0.3 * rng.normal() > 0)
        rows.append((f"S{i % 7}", date(2020, 1, 1) + timedelta(days=i // 7), x1, x2 if i % 11 else None, y))
    return spark.createDataFrame(rows, "symbol string, date date, x1 double, x2 double, label double")


@pytest.mark.parametrize("name,params", [("logreg", None), ("gbt", {"n_estimators": 10, "max_depth": 3})])
def test_models_learn_planted_signal(spark, name, params):
    df = planted(spark)
    train, val = df.where(F.col("date") < date(2020, 4, 1)), df.where(F.col("date") >= date(2020, 4, 1))
    model = TR.fit(name, train, ["x1", "x2"], params, validation=val)
    scored = TR.score_frame(model, val, name)
    m = compute_metrics(scored.withColumn("g", F.lit(0)), ["g"], score="predicted_probability", label="label").first()
    assert m.roc_auc > 0.8 and 0 <= m.accuracy <= 1


def test_model_table(spark):
    with pytest.raises(KeyError):
        TR.fit("nope", planted(spark), ["x1"])
    assert sorted(TR.MODELS) == ["gbt", "logreg"]


def test_medians_and_weights(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 1.0, None, float("nan"), 9.0)], "x double").withColumn("none", F.lit(None).cast("double"))
    medians = TR.fitted_medians(df, ["x", "none"])
    assert medians["x"] == 5.0
    filled = TR.impute_medians(["x", "none"], medians).transform(df.where("x is null")).first()
    assert (filled["x__imp"], filled["none__imp"]) == (5.0, 0.0)
    assert TR.class_weights("logreg", 10, 4.0) == (10 / 12, 10 / 8) and TR.class_weights("gbt", 10, 4.0) == (1.0, 1.5)
    assert TR.class_weights("gbt", 10, 0.0) == (1.0, 1.0)


def test_streaming_two_batches_equal_one(spark):
    header = "<TICKER>,<PER>,<DATE>,<TIME>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>,<OPENINT>\n"
    raw = tempfile.mkdtemp(prefix="stream-raw-")
    d = os.path.join(raw, "jp", "tse stocks")
    os.makedirs(d)
    with open(os.path.join(d, "7203.jp.txt"), "w") as fh:
        fh.write(header + "7203.JP,D,20240102,000000,10,11,9,10,5,0\n")
    work = tempfile.mkdtemp(prefix="stream-out-")
    silver, ckpt = os.path.join(work, "bars"), os.path.join(work, "ckpt")
    q = start_ingest_stream(spark, raw, "jp", silver, ckpt)
    q.awaitTermination()
    with open(os.path.join(d, "9984.jp.txt"), "w") as fh:
        fh.write(header + "9984.JP,D,20240102,000000,20,21,19,20,5,0\n9984.JP,D,20240103,000000,21,22,20,21,5,0\n")
    q = start_ingest_stream(spark, raw, "jp", silver, ckpt)
    q.awaitTermination()
    got = sorted((r.symbol, r.date) for r in spark.read.parquet(silver).collect())
    assert got == [("7203.JP", date(2024, 1, 2)), ("9984.JP", date(2024, 1, 2)), ("9984.JP", date(2024, 1, 3))]


def test_preprocessing(spark):
    df = spark.createDataFrame([("A", date(2024, 1, i + 1), v) for i, v in enumerate([1.0, None, float("nan"), 4.0, 100.0])],
                               "symbol string, date date, x double")
    ff = [r.x for r in PP.forward_fill(df, ["x"]).orderBy("date").collect()]
    assert ff == [1.0, 1.0, 1.0, 4.0, 100.0]
    assert PP.missing_ratios(df, ["x"]).first().missing_ratio == pytest.approx(0.4)
    df = df.withColumn("y", -F.col("x"))
    b = PP.fit_quantile_bounds(df, ["x", "y"], 0.0, 0.5)
    clipped = PP.winsorize(df, b).orderBy("date").collect()
    assert [r.x for r in clipped] == [1.0, None, None, 4.0, 4.0]  # NaN stays missing
    assert [r.y for r in clipped] == [-4.0, None, None, -4.0, -100.0]
    iqr = PP.fit_iqr_bounds(df, ["x"]).first()
    assert (iqr.lo, iqr.hi) == (1 - 1.5 * 99, 100 + 1.5 * 99)
    scaled = [r.x for r in PP.scale(df, PP.fit_standard_scale(df, ["x"])).orderBy("date").collect()]
    assert scaled[1] is None and scaled[2] is None and sum(v for v in scaled if v is not None) == pytest.approx(0)
    assert [r.x for r in PP.scale(df, PP.fit_robust_scale(df, ["x"])).orderBy("date").collect()][3] == 0
    assert PP.date_bounds(df, "2024-01-02", "2024-01-04").count() == 3 and PP.date_bounds(df).count() == 5


def test_predict_and_store(spark):
    from barlake.operators.instruments import initial_catalogue

    df = planted(spark, 700)
    model = TR.fit("logreg", df, ["x1", "x2"], {"max_iter": 5})
    inst = spark.createDataFrame([(f"S{i}", "jp", "stock", None, date(2020, 1, 1)) for i in range(6)],
                                 "symbol string, market string, asset_type string, sector_code string, listed_at date")
    cat = initial_catalogue(spark, inst, F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    path = os.path.join(tempfile.mkdtemp(prefix="pred-"), "predictions")
    for run in ("r1", "r2"):
        scored = TR.predict_and_store(df, model, "logreg", ["x1", "x2"], cat, path, run)
        assert scored.count() == 7  # S6 is not in the catalogue: scored, not stored
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 6 and {r.run_id for r in rows} == {"r2"}
    only = TR.predict_and_store(df, model, "logreg", ["x1", "x2"], cat, path, "r3", symbols=spark.createDataFrame([("S2",)], "symbol string"))
    assert [r.symbol for r in only.collect()] == ["S2"]
    assert sorted(r.run_id for r in spark.read.parquet(path).collect()) == ["r2"] * 5 + ["r3"]
