"""Preprocessing options the reference declares in its config (section 2.12).

All statistics are fitted on training rows only and applied to any frame.
Quantiles are exact and distributed; what is fitted is a row for each column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import fdiv
from barlake.operators.ordered import exact_quantiles


def missing_ratios(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing_ratio): share of NULL/NaN values per column, one pass."""
    n = F.count(F.lit(1))
    aggs = [(F.count(F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), 1)) / n).alias(c) for c in columns]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, missing_ratio)")


def drop_sparse_columns(df: DataFrame, columns: list[str], threshold: float = 0.3) -> DataFrame:
    """Drop columns whose missing ratio exceeds ``threshold`` (a one-row statistic drives the drop)."""
    ratios = {r.column_name: r.missing_ratio for r in missing_ratios(df, columns).collect()}
    return df.drop(*[c for c, r in ratios.items() if r > threshold])


def forward_fill(df: DataFrame, columns: list[str], symbol: str = "symbol", order: str = "date") -> DataFrame:
    """Last non-null value so far within the symbol (NaN counts as missing)."""
    w = Window.partitionBy(symbol).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in columns}
    return df.select(*[F.last(clean[c], ignorenulls=True).over(w).alias(c) if c in clean else F.col(c) for c in df.columns])


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0.0, subset=columns)


def _long(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """(keys, column_name, value) for each row and column."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    return df.selectExpr(*(keys or []), f"stack({len(columns)}, {pairs}) AS (column_name, value)")


def fit_quantiles(train: DataFrame, columns: list[str], probabilities: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """(keys, column_name, one column for each probability): exact quantiles of all columns in one grouped pass."""
    return exact_quantiles(_long(train, columns, keys), "value", probabilities, [*(keys or []), "column_name"])


def fit_quantile_bounds(train: DataFrame, columns: list[str], lower: float = 0.005, upper: float = 0.995) -> DataFrame:
    """(column_name, lo, hi): winsorisation bounds from training rows."""
    return fit_quantiles(train, columns, {"lo": lower, "hi": upper})


def fit_iqr_bounds(train: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """(column_name, lo, hi): quartiles widened by ``reach`` inter-quartile ranges."""
    q = fit_quantiles(train, columns, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select("column_name", (F.col("q1") - reach * iqr).alias("lo"), (F.col("q3") + reach * iqr).alias("hi"))


def fit_robust_scale(train: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, center, spread): median and inter-quartile range of training rows (exact)."""
    q = fit_quantiles(train, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return q.select("column_name", F.col("median").alias("center"), (F.col("q3") - F.col("q1")).alias("spread"))


def fit_standard_scale(train: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, center, spread): mean and population standard deviation of training rows."""
    v = _long(train, columns).where(~F.isnan("value"))
    return v.groupBy("column_name").agg(F.avg("value").alias("center"), F.stddev_pop("value").alias("spread"))


def _fitted(stats: DataFrame, first: str, second: str) -> dict[str, tuple]:
    """The fitted numbers by column (one row for each column of the matrix)."""
    return {r["column_name"]: (r[first], r[second]) for r in stats.collect()}


def _present(c: str):
    """A value, or NULL if it is missing; NaN counts as missing."""
    return F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))


def winsorize(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Clip each fitted column into [lo, hi]; NULL and NaN become NULL, a column without values stays."""
    fitted = {c: (lo, hi) for c, (lo, hi) in _fitted(bounds, "lo", "hi").items() if lo is not None}
    clip = {c: F.when(_present(c).isNotNull(), F.least(F.greatest(_present(c), F.lit(lo)), F.lit(hi))) for c, (lo, hi) in fitted.items()}
    return df.select(*[clip[c].alias(c) if c in clip else F.col(c) for c in df.columns])


def scale(df: DataFrame, stats: DataFrame) -> DataFrame:
    """(x - center) / spread for each fitted column; NULL and NaN become NULL."""
    fitted = {c: (m, s) for c, (m, s) in _fitted(stats, "center", "spread").items() if m is not None}
    return df.select(*[fdiv(_present(c) - F.lit(fitted[c][0]), F.lit(fitted[c][1])).alias(c) if c in fitted else F.col(c) for c in df.columns])


def date_bounds(df: DataFrame, start: str | None = None, end: str | None = None, date: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end``, both included; no bound on a side without one."""
    if start is not None:
        df = df.where(F.col(date) >= F.to_date(F.lit(start)))
    return df if end is None else df.where(F.col(date) <= F.to_date(F.lit(end)))
