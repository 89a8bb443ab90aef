"""Models as tables, side-by-side fits, run records."""

from __future__ import annotations

import os
import tempfile
import threading
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ml_stream import planted

from barlake.plans import model_tables as MT
from barlake.plans import train as TR

COLS = ["x1", "x2"]


def test_logreg_table_scores_and_gradient(spark):
    df = planted(spark, 600)
    medians = TR.fitted_medians(df, COLS)
    model = TR.fit("logreg", df, COLS, {"tol": 1e-10}, medians=medians)
    table = MT.export_logreg(spark, model, COLS, medians)
    assert sorted(r.feature for r in table.collect()) == ["intercept", "x1", "x2"]
    both = model.transform(df.withColumn("own", MT.logreg_probability(table))).withColumn("p", TR.probability_column())
    assert both.where(F.abs(F.col("own") - F.col("p")) > 1e-12).count() == 0
    weighted, n = TR.with_class_weights(df, "logreg")
    g = {r.feature: r.gradient for r in MT.logreg_gradient(weighted, table, 1.0 / n).collect()}
    assert max(map(abs, g.values())) < 1e-6
    # away from the optimum the gradient shows it; checked against plain numpy
    moved = table.withColumn("coefficient", F.col("coefficient") + 0.3)
    g = {r.feature: r.gradient for r in MT.logreg_gradient(weighted, moved, 1.0 / n).collect()}
    rows, t = weighted.collect(), {r.feature: r for r in moved.collect()}
    x = np.array([[(t[c].median if r[c] is None else r[c]) - t[c].mean for c in COLS] for r in rows]) / [t[c].deviation for c in COLS]
    w, y = np.array([r.weight for r in rows]), np.array([r.label for r in rows])
    b = np.array([t[c].coefficient for c in COLS])
    off = w * (1 / (1 + np.exp(-(x @ b + t["intercept"].coefficient))) - y) / w.sum()
    assert np.allclose([g["intercept"], *[g[c] for c in COLS]], [off.sum(), *(off @ x + b / n)], atol=1e-12)
    assert max(map(abs, g.values())) > 1e-2


def test_constant_input_scores_as_the_model(spark):
    df = planted(spark, 200).withColumn("x2", F.lit(3.0))
    medians = TR.fitted_medians(df, COLS)
    model = TR.fit("logreg", df, COLS, medians=medians)
    own = MT.logreg_probability(MT.export_logreg(spark, model, COLS, medians))
    assert model.transform(df.withColumn("own", own)).where(F.abs(F.col("own") - TR.probability_column()) > 1e-12).count() == 0


def descend(nodes, x):
    """Margin of one row by plain recursion over the node table."""
    at = {(n.tree, n.node): n for n in nodes}

    def down(t, k):
        n = at[t, k]
        return n.value if n.left is None else down(t, n.left if x[n.feature] <= n.threshold else n.right)

    return sum(w * down(t, 0) for t, w in {(n.tree, n.weight) for n in nodes})


def test_trees_as_a_table(spark):
    df = planted(spark, 500)
    medians = TR.fitted_medians(df, COLS)
    model = TR.fit("gbt", df, COLS, {"n_estimators": 6, "max_depth": 4, "colsample": "all"}, medians=medians)
    nodes = MT.export_trees(spark, model, [f"{c}__imp" for c in COLS], os.path.join(tempfile.mkdtemp(prefix="trees-"), "t"))
    scored = model.transform(df).withColumn("p", TR.probability_column()).select("symbol", "date", "x1__imp", "x2__imp", "p")
    own = MT.score_trees(scored, nodes, ["x1__imp", "x2__imp"]).collect()
    assert len(own) == 500 and max(abs(r.p - r.probability) for r in own) < 1e-12
    table = nodes.collect()
    assert all((n.feature is None) == (n.left is None) == (n.right is None) for n in table)
    for r in own[:40]:
        assert descend(table, r.asDict()) == pytest.approx(r.margin, abs=1e-12)


def test_single_leaf_tree(spark):
    nodes = spark.createDataFrame([(0, 0, None, None, None, None, 0.25, 2.0)], MT.TREES_SCHEMA)
    got = MT.score_trees(spark.createDataFrame([(1.0,)], "x double"), nodes, ["x"]).first()
    assert got.margin == 0.5


def test_side_by_side(spark):
    at_once, most, lock = [0], [0], threading.Lock()
    gate = threading.Barrier(3, timeout=30)

    def task(i):
        def run():
            with lock:
                at_once[0] += 1
                most[0] = max(most[0], at_once[0])
            gate.wait()
            pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            n = spark.range(10 + i).count()
            with lock:
                at_once[0] -= 1
            return n, pool
        return run

    found = TR.side_by_side(spark, [task(i) for i in range(6)], 3)
    assert [n for n, _ in found] == [10, 11, 12, 13, 14, 15] and most[0] == 3  # results in the order of the tasks
    assert {p for _, p in found} <= {"fit-0", "fit-1", "fit-2"} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    with pytest.raises(ZeroDivisionError):
        TR.side_by_side(spark, [lambda: 1, lambda: 1 / 0], 2)


def feature_like(spark, n_days=160):
    """Rows that look like features: all inputs, one of which tells the label."""
    from barlake.plans.features import input_columns

    rng = np.random.default_rng(5)
    rows = []
    for d in range(n_days):
        for s in range(6):
            x = [float(v) for v in rng.normal(size=len(input_columns()))]
            rows.append((f"S{s}", date(2020, 1, 1) + timedelta(days=d), *x, int(x[0] + 0.5 * rng.normal() > 0)))
    names = ", ".join(f"`{c}` double" for c in input_columns())
    return spark.createDataFrame(rows, f"symbol string, date date, {names}, label_direction_5d int")


def test_train_all_is_the_same_side_by_side(spark):
    f = feature_like(spark)
    split = dict(train_start="2020-01-01", train_end="2020-03-20", val_start="2020-03-27", val_end="2020-06-08", n_splits=2)
    models = {"logreg": {}, "gbt": {"params": {"n_estimators": 2, "max_depth": 2}}, "nope": {}, "off": {"enabled": False}}
    seen = []
    for parallelism in (1, 4):
        root = tempfile.mkdtemp(prefix="runs-")
        found = TR.train_all(spark, f, root, split, models, parallelism=parallelism)
        assert set(found) == {"logreg", "gbt", "nope"} and found["nope"] is None
        runs = {r.model_name: r for r in spark.read.parquet(f"{root}/runs").collect()}
        assert (runs["nope"].status, runs["logreg"].status, runs["gbt"].status) == ("FAILED", "FINISHED", "FINISHED") and "nope" in runs["nope"].error
        m = spark.read.parquet(f"{root}/run_metrics")
        assert m.groupBy("model_name", "fold").count().count() == 4
        seen.append(sorted((r.model_name, r.fold, r.metric, round(r.value, 9)) for r in m.collect()))
        assert TR.latest_finished_run(spark.read.parquet(f"{root}/runs"), "logreg").first().run_id == found["logreg"]
    assert seen[0] == seen[1]
