"""Classification metrics as grouped aggregates (V1-V6).

Every metric is computed per group (model, fold, ...) in one distributed
pass; AUC and average precision use the bucketed prefix sums in ``ordered``
so a huge validation fold is never one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.numeric import fdiv
from barlake.operators.ordered import ordered_prefix_sums, score_label_table

METRIC_NAMES = [
    "roc_auc", "average_precision", "log_loss", "accuracy", "precision", "recall", "f1",
    "positive_rate", "baseline_always_positive_accuracy", "baseline_majority_accuracy",
]


def confusion_metrics(scored: DataFrame, keys: list[str], score: str = "p", label: str = "y", threshold: float = 0.5) -> DataFrame:
    """V1 + V5: accuracy, precision, recall, F1 (0 on zero division) and baselines."""
    y = F.col(label).cast("int")
    pred = (F.col(score) >= F.lit(threshold)).cast("int")
    agg = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("pos"),
        F.sum(pred * y).alias("tp"),
        F.sum(pred * (1 - y)).alias("fp"),
        F.sum((1 - pred) * y).alias("fn"),
        F.sum((1 - pred) * (1 - y)).alias("tn"),
    )
    tp, fp, fn = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("fn").cast("double")
    zero = F.lit(0.0)
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(zero)
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(zero)
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(zero)
    pos_rate = fdiv(F.col("pos"), F.col("n"))
    return agg.select(
        *keys,
        "n",
        F.col("pos").cast("bigint").alias("positives"),
        fdiv(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        pos_rate.alias("positive_rate"),
        pos_rate.alias("baseline_always_positive_accuracy"),
        F.greatest(pos_rate, F.lit(1.0) - pos_rate).alias("baseline_majority_accuracy"),
    )


def log_loss(scored: DataFrame, keys: list[str], score: str = "p", label: str = "y", eps: float = 1e-7) -> DataFrame:
    """V4: mean binary cross-entropy with probabilities clipped to [eps, 1-eps]; NaN for one class."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    agg = scored.groupBy(*keys).agg(
        F.avg(-(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))).alias("_ll"),
        F.sum(y).alias("_p"),
        F.count(F.lit(1)).alias("_n"),
    )
    both = (F.col("_p") > 0) & (F.col("_p") < F.col("_n"))
    return agg.select(*keys, F.when(both, F.col("_ll")).otherwise(F.lit(float("nan"))).alias("log_loss"))


def compute_metrics(scored: DataFrame, keys: list[str], score: str = "p", label: str = "y", threshold: float = 0.5) -> DataFrame:
    """V1-V5 in one row per group, from one pass over the scored rows.

    Everything follows from the positives and negatives at each distinct
    score and their running sums from the highest score down.
    """
    cum = ordered_prefix_sums(score_label_table(scored, keys, score, label), keys, score, ["pos", "neg"], descending=True)
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(1e-7)), F.lit(1.0 - 1e-7))
    hit = F.col(score) >= threshold
    a = cum.groupBy(*keys).agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0.0)).alias("_tp"), F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0.0)).alias("_fp"),
        F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)).alias("_u"),
        F.sum(F.col("pos") * fdiv(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("_ap"),
        F.sum(-(F.col("pos") * F.ln(p) + F.col("neg") * F.ln(1 - p))).alias("_ll"))
    pos, neg, tp, fp = (F.col(c) for c in ("_p", "_n", "_tp", "_fp"))
    n, both = pos + neg, (pos > 0) & (neg > 0)
    of_two = lambda v: F.when(both, v).otherwise(F.lit(float("nan")))
    rate = fdiv(pos, n)
    zero = F.lit(0.0)
    values = {
        "roc_auc": fdiv(F.col("_u"), pos * neg), "average_precision": of_two(fdiv(F.col("_ap"), pos)), "log_loss": of_two(fdiv(F.col("_ll"), n)),
        "accuracy": fdiv(tp + neg - fp, n), "precision": F.when(tp + fp > 0, fdiv(tp, tp + fp)).otherwise(zero),
        "recall": F.when(pos > 0, fdiv(tp, pos)).otherwise(zero), "f1": F.when(tp + fp + pos > 0, fdiv(2 * tp, tp + fp + pos)).otherwise(zero),
        "positive_rate": rate, "baseline_always_positive_accuracy": rate, "baseline_majority_accuracy": F.greatest(rate, 1 - rate),
    }
    return a.select(*keys, n.cast("bigint").alias("n"), *[values[m].alias(m) for m in METRIC_NAMES])


def metrics_long(metrics: DataFrame, keys: list[str], prefix: str = "") -> DataFrame:
    """V6: one row per (group, metric name) — the run-metrics table layout."""
    pairs = ", ".join(f"'{prefix}{m}', CAST(`{m}` AS DOUBLE)" for m in METRIC_NAMES)
    return metrics.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(METRIC_NAMES)}, {pairs}) AS (metric, value)")
