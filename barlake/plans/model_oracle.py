"""DuckDB SQL for ``model_queries``.

``logreg_coefficients`` fits the model itself, by gradient steps in a
recursive query.  The other fits can't be repeated in SQL; there it states
which rows there must be and that the check each of them carries holds.
"""

from __future__ import annotations

from barlake.plans.model_queries import SMALL_INPUTS, SMALL_PARAMS
from barlake.plans.oracle import CAT, FOLD_TRAIN, MODEL_INPUTS, ROLES, bounds_cte, feature_query, folds_cte
from barlake.plans.sqltext import out

#: Steps of the fit in SQL: the loss is smooth enough for steps of length 1.
STEPS = 400

_N = len(SMALL_INPUTS)
_FINITE = ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS x{i}" for i, c in enumerate(SMALL_INPUTS, 1))
_FILLED = ", ".join(f"coalesce(x{i}, quantile_disc(x{i}, 0.5) OVER (PARTITION BY fold)) AS x{i}" for i in range(1, _N + 1))
_SCALED = ", ".join(f"(x{i} - avg(x{i}) OVER f) / stddev_samp(x{i}) OVER f AS x{i}" for i in range(1, _N + 1))
_Z = " + ".join(["b0", *[f"b{i} * x{i}" for i in range(1, _N + 1)]])
_OFF = f"w * (1.0 / (1.0 + exp(-({_Z}))) - y)"
_STEP = ", ".join([f"any_value(b0) - sum({_OFF}) / sum(w)", *[f"any_value(b{i}) - sum({_OFF} * x{i}) / sum(w) - any_value(reg) * any_value(b{i})" for i in range(1, _N + 1)]])

_COEFFICIENTS = [f"""
small AS (SELECT fold, CAST(label_direction_5d AS DOUBLE) AS y, {_FINITE} FROM tr)""", f"""
filled AS (SELECT fold, y, {_FILLED} FROM small)""", f"""
scaled AS MATERIALIZED (
  SELECT fold, y, {_SCALED}, count(*) OVER f / (2.0 * CASE WHEN y = 1 THEN sum(y) OVER f ELSE count(*) OVER f - sum(y) OVER f END) AS w,
         1.0 / ({SMALL_PARAMS["C"]!r} * count(*) OVER f) AS reg
  FROM filled WINDOW f AS (PARTITION BY fold))""", f"""
fit AS (
  SELECT DISTINCT fold, 0 AS step, {", ".join(f"0.0::DOUBLE AS b{i}" for i in range(_N + 1))} FROM scaled
  UNION ALL
  SELECT fit.fold, step + 1, {_STEP} FROM fit JOIN scaled ON fit.fold = scaled.fold WHERE step < {STEPS} GROUP BY fit.fold, step)"""]

_SCORED = "SELECT symbol, max(date) AS date FROM features GROUP BY symbol"
_EACH_FOLD = [bounds_cte("features"), folds_cte(), ROLES]

ORACLE = {
    "logreg_coefficients": feature_query(
        " UNION ALL ".join(f"SELECT fold, '{c}' AS feature, {out(f'b{i}', 4)} AS coefficient FROM fit WHERE step = {STEPS}" for i, c in enumerate(("intercept", *SMALL_INPUTS))),
        extra=[*FOLD_TRAIN, *_COEFFICIENTS]).replace("WITH ", "WITH RECURSIVE ", 1),
    "logreg_gradient": feature_query(
        f"SELECT fold, feature, count(*) AS n_rows, true AS flat FROM tr, unnest({[*MODEL_INPUTS, 'intercept']}) u(feature) GROUP BY fold, feature", extra=FOLD_TRAIN),
    "logreg_table_scores": feature_query(f"SELECT symbol, date AS prediction_date, true AS is_probability, true AS same FROM ({_SCORED})", drop_unlabelled=False),
    "gbt_table_scores": feature_query("SELECT symbol, count(*) AS n_rows, count(*) AS n_same FROM features GROUP BY symbol"),
    "run_records": feature_query(f"""
SELECT model_name, 'FINISHED' AS status, CAST({len(MODEL_INPUTS)} AS BIGINT) AS n_features, true AS has_model, fold, {out('rate')} AS positive_rate, {out('greatest(rate, 1 - rate)')} AS majority
FROM (SELECT fold, avg(CAST(label_direction_5d AS DOUBLE)) AS rate FROM features f JOIN roles r ON r.role = 'val' AND f.date BETWEEN r.rs AND r.re GROUP BY fold),
     (VALUES ('logreg'), ('gbt')) m(model_name)
UNION ALL SELECT 'no such model', 'FAILED', 0, false, NULL, NULL, NULL""", extra=_EACH_FOLD),
    "predict_store": feature_query(f"""
SELECT id AS ticker_id, date AS prediction_date, 5 AS horizon_days, 'logreg' AS model_name, CASE WHEN asset_type = 'index' THEN 'run2' ELSE 'run1' END AS run_id,
       true AS class_follows, true AS open
FROM ({_SCORED}) JOIN cat USING (symbol)""", drop_unlabelled=False, extra=[CAT]),
}
