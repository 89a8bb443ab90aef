"""DuckDB SQL for every registered query (the correctness oracle).

Written directly against the driver's views (lineitem, part, events, ...);
shares only the bar-view CTEs in ``sqltext``.  Floats are presented with the
same rule as the Spark side: NaN/inf -> NULL, then rounded to 6 digits.
"""

from __future__ import annotations

from barlake.plans import sqltext as s
from barlake.plans.sqltext import out

RETURN_PERIODS = (1, 5, 10, 20, 60)
_PRICE_WINDOWS, _VOLUME_WINDOWS, _SLIDING_WINDOWS = (5, 20, 60, 300), (5, 20, 250), (5, 60, 250, 1000)


def _o(col: str) -> str:
    return f"{out(col)} AS {col}"


def technical_ctes(source: str = "bars", min_history: int | None = None) -> list[str]:
    """CTEs computing the 26 indicators + calendar + lags + labels as ``tech``."""
    w = "WINDOW w AS (PARTITION BY symbol ORDER BY date)"
    base_from = source
    ctes = []
    if min_history is not None:
        ctes.append(
            f"kept AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n_bars FROM {source}) WHERE n_bars >= {min_history})"
        )
        base_from = "kept"
    rets = ",\n".join(
        f"close / lag(close, {n}) OVER w - 1 AS returns_{n}d, ln(close / lag(close, {n}) OVER w) AS log_returns_{n}d"
        for n in RETURN_PERIODS
    )
    ctes.append(f"""t1 AS (
  SELECT symbol, market, asset_type, date, open, high, low, close, volume, open_interest,
    {rets},
    CASE WHEN close - lag(close) OVER w > 0 THEN close - lag(close) OVER w ELSE 0.0 END AS gain,
    CASE WHEN close - lag(close) OVER w < 0 THEN lag(close) OVER w - close ELSE 0.0 END AS loss,
    greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr,
    CASE WHEN close > lag(close) OVER w THEN 1 WHEN close < lag(close) OVER w THEN -1 ELSE 0 END AS dir,
    {s.rolling('avg', 'close', 20)} AS bb_mid_20,
    {s.rolling('stddev_samp', 'close', 20)} AS bb_sd,
    100.0 * (close - {s.rolling('min', 'low', 14)}) / ({s.rolling('max', 'high', 14)} - {s.rolling('min', 'low', 14)}) AS stoch_k,
    (CAST(volume AS DOUBLE) - {s.rolling('avg', 'CAST(volume AS DOUBLE)', 20)}) / {s.rolling('stddev_samp', 'CAST(volume AS DOUBLE)', 20)} AS volume_zscore_20d,
    {s.ema('close', 12)} - {s.ema('close', 26)} AS macd
  FROM {base_from} {w})""")
    ctes.append(f"""t2 AS (
  SELECT *,
    100.0 - 100.0 / (1.0 + {s.rolling('avg', 'gain', 14)} / {s.rolling('avg', 'loss', 14)}) AS rsi_14,
    {s.ema('macd', 9)} AS macd_signal,
    bb_mid_20 + 2.0 * bb_sd AS bb_upper_20,
    bb_mid_20 - 2.0 * bb_sd AS bb_lower_20,
    {s.rolling('avg', 'tr', 14)} AS atr_14,
    sum(dir * volume) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obv,
    {s.rolling('avg', 'stoch_k', 3)} AS stoch_d,
    {s.rolling('stddev_samp', 'returns_1d', 20)} AS volatility_20d,
    {s.rolling('stddev_samp', 'returns_1d', 60)} AS volatility_60d
  FROM t1 {w})""")
    lag_cols = ",\n".join(
        f"lag({c}, {n}) OVER w AS {c}_lag_{n}"
        for c in ("returns_1d", "rsi_14", "macd_hist", "volume_zscore_20d")
        for n in (1, 2, 3, 5)
    )
    ctes.append(f"""t3 AS (
  SELECT *, macd - macd_signal AS macd_hist,
    (bb_upper_20 - bb_lower_20) / bb_mid_20 AS bb_width_20,
    (close - bb_lower_20) / (bb_upper_20 - bb_lower_20) AS bb_pct_20
  FROM t2)""")
    ctes.append(f"""tech AS (
  SELECT *,
    isodow(date) AS day_of_week, day(date) AS day_of_month, month(date) AS month, quarter(date) AS quarter,
    weekofyear(date) AS week_of_year, year(date) AS year,
    day(date) = 1 AS is_month_start, date = last_day(date) AS is_month_end,
    month(date) IN (3, 6, 9, 12) AS is_quarter_end_month,
    {lag_cols},
    lead(close, 5) OVER w / close - 1 AS label_return_5d,
    CASE WHEN lead(close, 5) OVER w / close - 1 IS NULL THEN NULL
         WHEN lead(close, 5) OVER w / close - 1 > 0.0 THEN 1 ELSE 0 END AS label_direction_5d
  FROM t3 {w})""")
    return ctes


RANKS = {"returns_5d": True, "returns_20d": True, "returns_60d": True, "volume_zscore_20d": True,
         "volatility_20d": False, "rsi_14": True}


def rank_sql(col: str, desc: bool) -> str:
    order = "DESC" if desc else "ASC"
    avg_rank = (f"(rank() OVER (PARTITION BY date ORDER BY {col} {order} NULLS LAST) "
                f"+ (count(*) OVER (PARTITION BY date, {col}) - 1) / 2.0)")
    n = f"CAST(count({col}) OVER (PARTITION BY date) AS DOUBLE)"
    return f"CASE WHEN {col} IS NOT NULL THEN ({n} - {avg_rank}) / ({n} - 1.0) END AS {col}_rank"


def feature_ctes(min_history: int = 250, market_symbol: str = "^MKT", drop_unlabelled: bool = True) -> list[str]:
    ranks = ",\n".join(rank_sql(c, d) for c, d in RANKS.items())
    where = "WHERE label_direction_5d IS NOT NULL" if drop_unlabelled else ""
    return technical_ctes("bars", min_history) + [
        f"ranked AS (SELECT *, {ranks} FROM tech)",
        f"""features AS (
  SELECT r.*, r.returns_5d - m.mkt_returns_5d AS excess_returns_5d
  FROM ranked r LEFT JOIN (SELECT date AS mdate, returns_5d AS mkt_returns_5d FROM tech WHERE symbol = '{market_symbol}') m
    ON r.date = m.mdate
  {where})""",
    ]


def bars_with(*extra: str) -> str:
    return s.with_(s.LINES, s.BRAND, s.INDEX, s.BARS, *extra)


def select_out(keys: list[str], floats: list[str], other: list[str] | None = None, source: str = "tech", where: str = "") -> str:
    cols = list(keys) + [_o(c) for c in floats] + list(other or [])
    return f"SELECT {', '.join(cols)} FROM {source} {where}"


def technical_query(floats: list[str], other: list[str] | None = None) -> str:
    return bars_with(*technical_ctes("bars")) + select_out(["symbol", "date"], floats, other)


def feature_query(select: str, min_history: int = 250, drop_unlabelled: bool = True, extra: list[str] | None = None) -> str:
    return bars_with(*feature_ctes(min_history, drop_unlabelled=drop_unlabelled), *(extra or [])) + select


# ---------------------------------------------------------------------------
# Query texts
# ---------------------------------------------------------------------------
_BAR_KEYS = ["symbol", "market", "asset_type", "date"]
_OHLC = ["open", "high", "low", "close"]

CLEAN_CTES = [s.RAW, """
valid AS (
  SELECT * FROM raw_bars
  WHERE date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
    AND open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low
)""", """
firsts AS (
  SELECT *, row_number() OVER (
    PARTITION BY symbol, date
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, px,
             market, asset_type, open NULLS FIRST, high NULLS FIRST, low NULLS FIRST, close NULLS FIRST,
             volume NULLS FIRST, open_interest NULLS FIRST) AS rn
  FROM valid
)""", """
cleaned AS (
  SELECT symbol, market, asset_type, date, open, high, low, close, COALESCE(volume, 0) AS volume, open_interest
  FROM firsts WHERE rn = 1
)"""]

TECH_COLS = [f"{p}_{n}d" for n in RETURN_PERIODS for p in ("returns", "log_returns")] + [
    "rsi_14", "macd", "macd_signal", "macd_hist", "bb_mid_20", "bb_upper_20", "bb_lower_20", "bb_width_20",
    "bb_pct_20", "atr_14", "stoch_k", "stoch_d", "volatility_20d", "volatility_60d", "volume_zscore_20d"]
LAG_COLS = [f"{c}_lag_{n}" for c in ("returns_1d", "rsi_14", "macd_hist", "volume_zscore_20d") for n in (1, 2, 3, 5)]

FEATURE_MATRIX_FLOATS = ["open", "high", "low", "close", *TECH_COLS, *LAG_COLS, "label_return_5d", *[f"{c}_rank" for c in RANKS], "excess_returns_5d"]

EVENT_TECH = """
ev1 AS (
  SELECT symbol, date, close, volume,
    close / lag(close, 1) OVER w - 1 AS returns_1d,
    close / lag(close, 5) OVER w - 1 AS returns_5d,
    CASE WHEN close - lag(close) OVER w > 0 THEN close - lag(close) OVER w ELSE 0.0 END AS gain,
    CASE WHEN close - lag(close) OVER w < 0 THEN lag(close) OVER w - close ELSE 0.0 END AS loss,
    (CAST(volume AS DOUBLE) - """ + s.rolling("avg", "CAST(volume AS DOUBLE)", 5) + ") / " + s.rolling("stddev_samp", "CAST(volume AS DOUBLE)", 5) + """ AS volume_zscore_5d
  FROM event_bars WINDOW w AS (PARTITION BY symbol ORDER BY date)
)""", """
ev2 AS (
  SELECT *, 100.0 - 100.0 / (1.0 + """ + s.rolling("avg", "gain", 5) + " / " + s.rolling("avg", "loss", 5) + """) AS rsi_5
  FROM ev1 WINDOW w AS (PARTITION BY symbol ORDER BY date)
)"""

ORACLE: dict[str, str] = {
    "bars_daily": s.with_(s.LINES, s.BRAND) + select_out(_BAR_KEYS, _OHLC, ["volume", "open_interest"], "brand_bars"),
    "index_bars": s.with_(s.LINES, s.INDEX) + select_out(_BAR_KEYS, _OHLC, ["volume", "open_interest"], "index_bars"),
    "returns": technical_query([f"returns_{n}d" for n in RETURN_PERIODS]),
    "log_returns": technical_query([f"log_returns_{n}d" for n in RETURN_PERIODS]),
    "cross_sectional_rank": bars_with(*technical_ctes("bars"),
        "ranked AS (SELECT *, " + ", ".join(rank_sql(c, True) for c in ("returns_5d", "returns_20d", "returns_60d")) + " FROM tech)")
        + select_out(["symbol", "date"], ["returns_5d", "returns_5d_rank", "returns_20d_rank", "returns_60d_rank"], source="ranked"),
    "cross_sectional_rank_spread": bars_with(*technical_ctes("bars"),
        "ranked AS (SELECT *, " + ", ".join(rank_sql(c, True) for c in ("returns_5d", "returns_20d", "returns_60d")) + " FROM tech)")
        + select_out(["symbol", "date"], ["returns_5d", "returns_5d_rank", "returns_20d_rank", "returns_60d_rank"], source="ranked"),
    "clean_bars": s.with_(s.LINES, *CLEAN_CTES) + select_out(["symbol", "date"], _OHLC, ["volume", "open_interest"], "cleaned"),
    "clean_report": s.with_(s.LINES, *CLEAN_CTES) + """
SELECT i.symbol, i.rows_in, i.rows_valid, COALESCE(o.rows_out, 0) AS rows_out, i.rows_in - COALESCE(o.rows_out, 0) AS rows_dropped
FROM (SELECT symbol, count(*) AS rows_in,
             count(*) FILTER (WHERE date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
               AND close IS NOT NULL AND open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low) AS rows_valid
      FROM raw_bars GROUP BY symbol) i
LEFT JOIN (SELECT symbol, count(*) AS rows_out FROM cleaned GROUP BY symbol) o ON i.symbol = o.symbol""",
    "dedupe_first": s.with_(s.LINES, *CLEAN_CTES) + """
SELECT f.symbol, f.date, c.n_copies, """ + ", ".join(_o(x) for x in _OHLC) + """, f.volume
FROM firsts f JOIN (SELECT symbol, date, count(*) AS n_copies FROM valid GROUP BY symbol, date HAVING count(*) > 1) c
  ON f.symbol = c.symbol AND f.date = c.date
WHERE f.rn = 1""",
    "min_history": bars_with("kept AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM bars) WHERE n >= 1500)")
        + select_out(["symbol", "date"], ["close"], source="kept"),
    "rsi": technical_query(["rsi_14"]),
    "bollinger": technical_query(["bb_mid_20", "bb_upper_20", "bb_lower_20", "bb_width_20", "bb_pct_20"]),
    "atr": technical_query(["atr_14"]),
    "obv": technical_query([], ["CAST(obv AS BIGINT) AS obv"]),
    "stochastic": technical_query(["stoch_k", "stoch_d"]),
    "volatility": technical_query(["volatility_20d", "volatility_60d"]),
    "volume_zscore": technical_query(["volume_zscore_20d"]),
    "macd": technical_query(["macd", "macd_signal", "macd_hist"]),
    "calendar": technical_query([], ["CAST(day_of_week AS INTEGER) AS day_of_week", "CAST(day_of_month AS INTEGER) AS day_of_month",
                                     "CAST(month AS INTEGER) AS month", "CAST(quarter AS INTEGER) AS quarter",
                                     "CAST(week_of_year AS INTEGER) AS week_of_year", "CAST(year AS INTEGER) AS year",
                                     "is_month_start", "is_month_end", "is_quarter_end_month"]),
    "lags": technical_query(LAG_COLS),
    "forward_labels": technical_query(["label_return_5d"]),
    "direction_labels": technical_query([], ["CAST(label_direction_5d AS INTEGER) AS label_direction_5d"]),
    "technical_stack": technical_query(TECH_COLS, ["CAST(obv AS BIGINT) AS obv"]),
    "event_features": s.with_(s.EVENT_BARS, *EVENT_TECH) + select_out(
        ["symbol", "date"], ["close", "returns_1d", "returns_5d", "rsi_5", "volume_zscore_5d"], source="ev2"),
    "excess_returns": bars_with(*technical_ctes("bars"), """
ex AS (SELECT t.symbol, t.date, t.returns_5d, t.returns_5d - m.r AS excess_returns_5d
       FROM tech t LEFT JOIN (SELECT date, returns_5d AS r FROM tech WHERE symbol = '^MKT') m ON t.date = m.date)""")
        + select_out(["symbol", "date"], ["returns_5d", "excess_returns_5d"], source="ex"),
    "feature_matrix": feature_query(select_out(
        ["symbol", "market", "asset_type", "date"], FEATURE_MATRIX_FLOATS,
        ["volume", "open_interest", "CAST(obv AS BIGINT) AS obv", *[f"CAST({c} AS INTEGER) AS {c}" for c in (
            "day_of_week", "day_of_month", "month", "quarter", "week_of_year", "year", "label_direction_5d")],
         "is_month_start", "is_month_end", "is_quarter_end_month"], source="features")),
    "feature_row_counts": feature_query("""
SELECT symbol, CAST(year AS INTEGER) AS year, count(*) AS n_rows, count(returns_60d) AS n_returns_60d,
       count(volatility_60d) AS n_volatility_60d, CAST(sum(label_direction_5d) AS BIGINT) AS n_up
FROM features GROUP BY symbol, year"""),
}


# ---------------------------------------------------------------------------
# Batch 2: folds, metrics, portfolio, upserts, lookups
# ---------------------------------------------------------------------------
SCORED = """
scored AS (
  SELECT symbol, date, returns_20d_rank AS p, CAST(label_direction_5d AS INTEGER) AS y, label_return_5d AS ret
  FROM features WHERE isfinite(returns_20d_rank)
)"""


def bounds_cte(source: str) -> str:
    return f"""
bounds AS (
  SELECT train_start, CAST(val_start - 7 AS DATE) AS train_end, val_start, val_end FROM (
    SELECT train_start, val_end, CAST(train_start + CAST(((val_end - train_start) * 3) // 5 AS INTEGER) AS DATE) AS val_start
    FROM (SELECT min(date) AS train_start, max(date) AS val_end FROM {source}))
)"""


def folds_cte(name: str = "folds", n: int = 3, expanding: bool = True, embargo: int = 5) -> str:
    if n <= 1:
        return f"{name} AS (SELECT 0 AS fold, train_start, train_end, val_start, val_end FROM bounds)"
    ts = "train_start" if expanding else \
        f"CAST(val_start + CAST(i * size AS INTEGER) - {embargo} - CAST(train_end - train_start AS INTEGER) AS DATE)"
    return f"""
{name} AS (
  SELECT CAST(i AS INTEGER) AS fold, {ts} AS train_start,
         CAST(val_start + CAST(i * size AS INTEGER) - {embargo} AS DATE) AS train_end,
         CAST(val_start + CAST(i * size AS INTEGER) AS DATE) AS val_start,
         CASE WHEN i = {n - 1} THEN val_end ELSE CAST(val_start + CAST((i + 1) * size AS INTEGER) AS DATE) END AS val_end
  FROM (SELECT *, greatest(1, (val_end - val_start) // {n}) AS size FROM bounds), range({n}) t(i)
)"""


ROLES = """
roles AS (
  SELECT fold, 'train' AS role, train_start AS rs, train_end AS re FROM folds
  UNION ALL SELECT fold, 'val', val_start, val_end FROM folds
)"""

VAL = "val AS (SELECT s.*, r.fold FROM scored s JOIN roles r ON s.date BETWEEN r.rs AND r.re WHERE r.role = 'val')"

CONFUSION = """
conf AS (
  SELECT fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
    CAST(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
    CAST(sum(CASE WHEN p >= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
    CAST(sum(CASE WHEN p < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
    CAST(sum(CASE WHEN p < 0.5 AND y = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn
  FROM val GROUP BY fold
)""", """
cm AS (
  SELECT fold, n, positives,
    (tp + tn) / n AS accuracy,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
    CAST(positives AS DOUBLE) / n AS positive_rate,
    CAST(positives AS DOUBLE) / n AS baseline_always_positive_accuracy,
    greatest(CAST(positives AS DOUBLE) / n, 1.0 - CAST(positives AS DOUBLE) / n) AS baseline_majority_accuracy
  FROM conf
)"""

AUC = """
auc AS (
  SELECT fold,
    (sum(ar) FILTER (WHERE y = 1) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2.0)
      / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) AS roc_auc
  FROM (SELECT fold, y, rank() OVER (PARTITION BY fold ORDER BY p) + (count(*) OVER (PARTITION BY fold, p) - 1) / 2.0 AS ar FROM val)
  GROUP BY fold
)"""

AP = """
ap_t AS (SELECT fold, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM val GROUP BY fold, p)""", """
ap AS (
  SELECT fold, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * tp / (tp + fp)) / sum(pos) ELSE CAST('nan' AS DOUBLE) END AS average_precision
  FROM (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tp,
                  sum(neg) OVER (PARTITION BY fold ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS fp FROM ap_t)
  GROUP BY fold
)"""

LOGLOSS = """
ll AS (
  SELECT fold, CASE WHEN sum(y) > 0 AND sum(y) < count(*) THEN
      avg(-(y * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7))))
    ELSE CAST('nan' AS DOUBLE) END AS log_loss
  FROM val GROUP BY fold
)"""

EVAL_CTES = [SCORED, bounds_cte("scored"), folds_cte(), ROLES, VAL]


def eval_query(select: str, *extra: str) -> str:
    return feature_query(select, extra=EVAL_CTES + list(extra))


METRIC_NAMES = ["roc_auc", "average_precision", "log_loss", "accuracy", "precision", "recall", "f1",
                "positive_rate", "baseline_always_positive_accuracy", "baseline_majority_accuracy"]

GRID = "grid AS (SELECT CAST(k AS INTEGER) AS top_k, CAST(b AS DOUBLE) AS cost_bps FROM (VALUES (3, 5.0), (3, 10.0), (5, 5.0), (5, 10.0)) g(k, b))"
PICKS = "picks AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY p DESC, symbol ASC) AS pick_rank FROM scored)"
DAILY = """
daily AS (
  SELECT top_k, cost_bps, date, avg(ret) AS gross_return, avg(ret) - 2.0 * cost_bps / 10000.0 AS net_return
  FROM picks JOIN grid ON pick_rank <= top_k GROUP BY top_k, cost_bps, date
)""", """
curve AS (
  SELECT *, (equity - peak) / peak AS drawdown FROM (
    SELECT *, max(equity) OVER (PARTITION BY top_k, cost_bps ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM (
      SELECT *, product(1 + net_return) OVER (PARTITION BY top_k, cost_bps ORDER BY date ROWS UNBOUNDED PRECEDING) AS equity
      FROM daily))
)"""

_F = 252.0 / 5
_SQ = _F ** 0.5

# catalogue (all bar symbols), gold bars, predictions
CAT = """
cat AS (
  SELECT row_number() OVER (ORDER BY symbol) AS id, symbol, CAST(NULL AS VARCHAR) AS name, market, asset_type,
         CASE WHEN asset_type = 'stock' AND regexp_matches(symbol, '^[0-9][0-9a-zA-Z]{3}') THEN substr(symbol, 1, 1) || '000' END AS sector_code,
         listed_at, CAST(NULL AS DATE) AS delisted_at, TRUE AS is_active
  FROM (SELECT symbol, market, asset_type, min(date) AS listed_at FROM bars GROUP BY symbol, market, asset_type)
)"""


def dec(c: str) -> str:
    return f"CAST(CAST(CAST({c} AS DOUBLE) AS VARCHAR) AS DECIMAL(18,6))"


def gold(source: str) -> str:
    return (f"SELECT c.id AS ticker_id, b.date, {dec('b.open')} AS open, {dec('b.high')} AS high, {dec('b.low')} AS low, "
            f"{dec('b.close')} AS close, CAST(COALESCE(b.volume, 0) AS BIGINT) AS volume, b.open_interest "
            f"FROM {source} b JOIN cat c ON b.symbol = c.symbol")


PREDS = """
preds AS (
  SELECT c.id AS ticker_id, f.symbol, f.date AS prediction_date, 5 AS horizon_days, m.model_name, 'run1' AS run_id,
         m.p AS predicted_probability, CAST(m.p >= 0.5 AS INTEGER) AS predicted_class,
         CAST(f.label_direction_5d AS INTEGER) AS actual
  FROM features f
  JOIN cat c ON f.symbol = c.symbol
  CROSS JOIN LATERAL (SELECT 'rank20' AS model_name, f.returns_20d_rank AS p UNION ALL SELECT 'rank5', f.returns_5d_rank) m
  WHERE isfinite(m.p)
)"""

# the two ranks that predictions are made of, without the other indicators; stored holds what was there, fresh what comes
RANK_SCORES = ["""
closes AS MATERIALIZED (SELECT * FROM (SELECT symbol, date, close, count(*) OVER (PARTITION BY symbol) AS n FROM bars) WHERE n >= 250)""", """
moves AS (
  SELECT symbol, date, close / lag(close, 5) OVER w - 1 AS returns_5d, close / lag(close, 20) OVER w - 1 AS returns_20d, lead(close, 5) OVER w IS NOT NULL AS labelled
  FROM closes WINDOW w AS (PARTITION BY symbol ORDER BY date))""", f"""
two_ranks AS MATERIALIZED (SELECT symbol, date, labelled, {rank_sql('returns_5d', True)}, {rank_sql('returns_20d', True)} FROM moves)""", """
scores AS MATERIALIZED (
  SELECT id AS ticker_id, date AS prediction_date, 'rank20' AS model_name, returns_20d_rank AS p FROM two_ranks JOIN cat USING (symbol) WHERE labelled AND isfinite(returns_20d_rank)
  UNION ALL
  SELECT id, date, 'rank5', returns_5d_rank FROM two_ranks JOIN cat USING (symbol) WHERE labelled AND isfinite(returns_5d_rank))""", """
stored AS MATERIALIZED (SELECT *, CASE WHEN prediction_date < DATE '1998-01-01' THEN 1 END AS actual_class FROM scores WHERE prediction_date < DATE '1999-01-01')""", """
fresh AS MATERIALIZED (SELECT * FROM scores WHERE prediction_date >= DATE '1998-06-01')"""]

GOLD_OUT = "SELECT ticker_id, date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume, open_interest"

ORACLE.update({
    "walk_forward_folds": feature_query(
        "SELECT 'expanding' AS mode, *, CAST(val_start - train_end AS INTEGER) AS gap_days FROM folds "
        "UNION ALL SELECT 'rolling', *, CAST(val_start - train_end AS INTEGER) FROM folds_r "
        "UNION ALL SELECT 'single', *, CAST(val_start - train_end AS INTEGER) FROM folds_1",
        extra=[bounds_cte("features"), folds_cte(), folds_cte("folds_r", 3, False), folds_cte("folds_1", 1)]),
    "fold_assignment": feature_query(
        "SELECT r.fold, r.role, count(*) AS n_rows, count(DISTINCT f.symbol) AS n_symbols, min(f.date) AS first_date, max(f.date) AS last_date "
        "FROM features f JOIN roles r ON f.date BETWEEN r.rs AND r.re GROUP BY r.fold, r.role",
        extra=[bounds_cte("features"), folds_cte(), ROLES]),
    "class_metrics": eval_query(select_out(["fold", "n", "positives"], [
        "accuracy", "precision", "recall", "f1", "positive_rate", "baseline_always_positive_accuracy",
        "baseline_majority_accuracy"], source="cm"), *CONFUSION),
    "roc_auc": eval_query(select_out(["fold"], ["roc_auc"], source="auc"), AUC),
    "average_precision": eval_query(select_out(["fold"], ["average_precision"], source="ap"), *AP),
    "log_loss": eval_query(select_out(["fold"], ["log_loss"], source="ll"), LOGLOSS),
    "run_metrics": eval_query(
        "SELECT 'rank20' AS model_name, fold, 'val_' || metric AS metric, " + out("value") + " AS value FROM (UNPIVOT (SELECT cm.fold, "
        + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in METRIC_NAMES)
        + " FROM cm JOIN auc USING (fold) JOIN ap USING (fold) JOIN ll USING (fold)) ON "
        + ", ".join(METRIC_NAMES) + " INTO NAME metric VALUE value)",
        *CONFUSION, AUC, *AP, LOGLOSS),
    "topk_picks": feature_query(
        select_out(["date", "symbol", "CAST(pick_rank AS INTEGER) AS pick_rank"], ["p", "ret"], source="picks", where="WHERE pick_rank <= 3"),
        extra=[SCORED, PICKS]),
    "portfolio_stats": feature_query(f"""
SELECT top_k, cost_bps, CAST(count(*) * top_k AS BIGINT) AS n_trades,
  {out('product(1 + net_return) - 1')} AS cumulative_return,
  {out(f'avg(net_return) * {_F!r}')} AS annualised_return,
  {out(f'coalesce(stddev_samp(net_return), 0.0) * {_SQ!r}')} AS annualised_volatility,
  {out(f'CASE WHEN coalesce(stddev_samp(net_return), 0.0) * {_SQ!r} > 1e-12 THEN avg(net_return) * {_F!r} / (coalesce(stddev_samp(net_return), 0.0) * {_SQ!r}) ELSE 0.0 END')} AS sharpe_ratio,
  {out('min(drawdown)')} AS max_drawdown,
  {out('avg(CASE WHEN net_return > 0 THEN 1.0 ELSE 0.0 END)')} AS win_rate
FROM curve GROUP BY top_k, cost_bps""", extra=[SCORED, PICKS, GRID, *DAILY]),
    "equity_curve": feature_query(
        select_out(["top_k", "cost_bps", "date"], ["gross_return", "net_return", "equity", "drawdown"], source="curve",
                   where="WHERE top_k = 3 AND cost_bps = 5.0"),
        extra=[SCORED, PICKS, GRID, *DAILY]),
    "latest_row": bars_with() .replace("WITH", "WITH", 1) + (
        "SELECT symbol, max(date) AS date, " + out("arg_max(close, date)") + " AS close, arg_max(volume, date) AS volume FROM bars GROUP BY symbol"),
    "upsert_instruments": bars_with("""
old AS (
  SELECT row_number() OVER (ORDER BY symbol) AS id, symbol, symbol || ' Co' AS name, market, asset_type,
         CAST(NULL AS VARCHAR) AS sector_code, listed_at, CAST(NULL AS DATE) AS delisted_at, TRUE AS is_active
  FROM (SELECT symbol, market, asset_type, min(date) AS listed_at FROM brand_bars WHERE date < DATE '1998-01-01'
        GROUP BY symbol, market, asset_type)
)""", """
upd AS (SELECT symbol, market, asset_type,
          CASE WHEN asset_type = 'stock' AND regexp_matches(symbol, '^[0-9][0-9a-zA-Z]{3}') THEN substr(symbol, 1, 1) || '000' END AS sector_code,
          min(date) AS listed_at
        FROM bars WHERE date >= DATE '1997-01-01' GROUP BY symbol, market, asset_type)""", """
newids AS (SELECT symbol, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY symbol) AS id
           FROM upd WHERE symbol NOT IN (SELECT symbol FROM old))""") + """
SELECT CAST(COALESCE(o.id, n.id) AS BIGINT) AS id, COALESCE(o.symbol, u.symbol) AS symbol, o.name,
  CASE WHEN u.symbol IS NOT NULL THEN u.market ELSE o.market END AS market,
  CASE WHEN u.symbol IS NOT NULL THEN u.asset_type ELSE o.asset_type END AS asset_type,
  CASE WHEN u.symbol IS NOT NULL THEN u.sector_code ELSE o.sector_code END AS sector_code,
  CASE WHEN o.symbol IS NOT NULL AND u.symbol IS NOT NULL THEN least(o.listed_at, u.listed_at)
       WHEN u.symbol IS NOT NULL THEN u.listed_at ELSE o.listed_at END AS listed_at,
  o.delisted_at,
  CASE WHEN u.symbol IS NOT NULL THEN TRUE ELSE o.is_active END AS is_active,
  u.symbol IS NOT NULL AS touched
FROM old o FULL OUTER JOIN upd u ON o.symbol = u.symbol LEFT JOIN newids n ON u.symbol = n.symbol""",
    "upsert_bars": s.with_(s.LINES, s.BRAND, s.INDEX, s.BARS, CAT, *CLEAN_CTES,
                           f"target AS ({gold('bars')} WHERE b.date < DATE '1999-01-01')",
                           f"upd AS ({gold('cleaned')} WHERE b.date >= DATE '1998-07-01')",
                           "merged AS (SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.ticker_id = t.ticker_id AND u.date = t.date) UNION ALL SELECT * FROM upd)")
        + GOLD_OUT + " FROM merged",
    "upsert_predictions": bars_with(CAT.replace("cat AS (", "cat AS MATERIALIZED (", 1), *RANK_SCORES) + f"""
SELECT t.ticker_id, t.prediction_date, 5 AS horizon_days, t.model_name, 'run1' AS run_id, {out('t.p')} AS predicted_probability,
  CAST(t.p >= 0.5 AS INTEGER) AS predicted_class, t.actual_class, false AS inserted
FROM stored t ANTI JOIN fresh u USING (ticker_id, prediction_date, model_name)
UNION ALL
SELECT u.ticker_id, u.prediction_date, 5, u.model_name, 'run2', {out('u.p * 0.5 + 0.25')},
  CAST(u.p >= 0.5 AS INTEGER), t.actual_class, t.ticker_id IS NULL
FROM fresh u LEFT JOIN stored t USING (ticker_id, prediction_date, model_name)""",
    "actual_class_fill": feature_query("""
SELECT model_name, CAST(year(prediction_date) AS INTEGER) AS year, count(*) AS n, count(ac) AS n_known,
  CAST(sum(ac) AS BIGINT) AS n_up, CAST(sum(CASE WHEN ac = predicted_class THEN 1 ELSE 0 END) AS BIGINT) AS n_hit
FROM (SELECT *, COALESCE(CASE WHEN prediction_date < DATE '1998-01-01' THEN 0 END, actual) AS ac FROM preds)
GROUP BY model_name, year(prediction_date)""", extra=[CAT, PREDS]),
    "purge_symbols": bars_with(CAT, f"g AS ({gold('bars')})") + """
SELECT ticker_id, count(*) AS n_bars, max(date) AS last_date FROM g
WHERE ticker_id NOT IN (SELECT id FROM cat WHERE asset_type = 'index') GROUP BY ticker_id""",
    "instrument_lookup": bars_with(CAT) + "SELECT CAST(id AS BIGINT) AS id, symbol, market, asset_type, listed_at FROM cat WHERE symbol = '^MKT'",
    "instrument_search": bars_with(CAT) + """
SELECT CAST(id AS BIGINT) AS id, symbol, market, asset_type, (SELECT count(*) FROM cat WHERE is_active AND symbol ILIKE '%BRAND#1%') AS total
FROM cat WHERE is_active AND symbol ILIKE '%BRAND#1%' ORDER BY symbol LIMIT 500""",
    "instrument_page": bars_with(CAT) + """
SELECT CAST(id AS BIGINT) AS id, symbol, listed_at,
  (SELECT count(*) FROM cat WHERE market = 'jp' AND asset_type = 'stock' AND is_active) AS total
FROM cat WHERE market = 'jp' AND asset_type = 'stock' AND is_active ORDER BY symbol LIMIT 5 OFFSET 5""",
    "last_n_bars": bars_with() + "SELECT symbol, date, CAST(recency AS INTEGER) AS recency, " + out("close") + """ AS close
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS recency FROM bars) WHERE recency <= 10""",
    "predictions_on_date": feature_query(
        select_out(["CAST(ticker_id AS BIGINT) AS ticker_id", "symbol", "model_name"], ["predicted_probability"], ["predicted_class"],
                   source="preds", where="WHERE prediction_date = DATE '1999-03-15'"), extra=[CAT, PREDS]),
    "latest_predictions": feature_query("""
SELECT CAST(r.pos AS INTEGER) AS pos, r.symbol, l.date, """ + out("l.p") + """ AS predicted_probability, l.c AS predicted_class
FROM (SELECT symbol, max(prediction_date) AS date, arg_max(predicted_probability, prediction_date) AS p,
             arg_max(predicted_class, prediction_date) AS c FROM preds WHERE model_name = 'rank20' GROUP BY symbol) l
JOIN (VALUES (0, 'Brand#13'), (1, 'Brand#21'), (2, '^MKT'), (3, 'Brand#99'), (4, 'Brand#5'), (5, 'Brand#42')) r(pos, symbol)
  ON l.symbol = r.symbol""", extra=[CAT, PREDS]),
})


# ---------------------------------------------------------------------------
# Batch 3: config-declared preprocessing options
# ---------------------------------------------------------------------------
INPUTS = [*TECH_COLS, *LAG_COLS]
MISSING_COLS = [*INPUTS, "obv", *[f"{c}_rank" for c in RANKS], "excess_returns_5d"]


TRAIN_ROWS = [bounds_cte("features"), "train AS (SELECT * FROM features WHERE date <= (SELECT train_end FROM bounds))"]
LONG = ["long AS (SELECT col, v FROM (UNPIVOT (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in INPUTS)
        + " FROM train) ON COLUMNS(*) INTO NAME col VALUE v) WHERE NOT isnan(v))"]


def quantile_ctes(**quantiles: float) -> list[str]:
    """Exact lower quantiles of each input: smallest v with count(x <= v) >= q * n (NULL/NaN ignored)."""
    picks = ", ".join(f"min(v) FILTER (cum >= CAST({q!r} AS DOUBLE) * n) AS {name}" for name, q in quantiles.items())
    return [*TRAIN_ROWS, *LONG, f"""fit AS (SELECT col, {picks} FROM (
  SELECT col, v, sum(count(*)) OVER (PARTITION BY col ORDER BY v) AS cum, sum(count(*)) OVER (PARTITION BY col) AS n FROM long GROUP BY col, v) GROUP BY col)"""]


def applied(expr: str, **stats: str) -> str:
    """``expr`` for each input, with {x} its value and the named statistics from ``fit``."""
    def one(c: str) -> str:
        values = {k: f"(SELECT {v} FROM fit WHERE col = '{c}')" for k, v in stats.items()}
        return out(expr.format(x=f"(CASE WHEN NOT isnan({c}) THEN {c} END)", **values)) + f" AS {c}"

    return "SELECT symbol, date, " + ", ".join(map(one, INPUTS)) + " FROM features"


CLIP = "CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, {lo}), {hi}) END"

ORACLE.update({
    "missing_ratio": feature_query(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {out(f'avg(CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) THEN 1.0 ELSE 0.0 END)')} AS missing_ratio FROM features"
        for c in MISSING_COLS)),
    "forward_fill": feature_query("SELECT symbol, date, " + ", ".join(
        out(f"last_value(CASE WHEN NOT isnan({c}) THEN {c} END IGNORE NULLS) OVER "
            f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)") + f" AS {c}"
        for c in INPUTS) + " FROM features"),
    "winsorize": feature_query(applied(CLIP, lo="lo", hi="hi"), extra=quantile_ctes(lo=0.005, hi=0.995)),
    "clip_iqr": feature_query(applied(CLIP, lo="q1 - 1.5 * (q3 - q1)", hi="q3 + 1.5 * (q3 - q1)"), extra=quantile_ctes(q1=0.25, q3=0.75)),
    "robust_scale": feature_query(applied("({x} - {m}) / {s}", m="median", s="q3 - q1"), extra=quantile_ctes(q1=0.25, median=0.5, q3=0.75)),
    "standard_scale": feature_query(applied("({x} - {m}) / {s}", m="m", s="s"), extra=[
        *TRAIN_ROWS, *LONG, "fit AS (SELECT col, avg(v) AS m, stddev_pop(v) AS s FROM long GROUP BY col)"]),
    "date_bounds": bars_with() + "SELECT symbol, count(*) AS n_bars, min(date) AS first_date, max(date) AS last_date FROM bars "
                                 "WHERE date BETWEEN DATE '1996-02-29' AND DATE '1999-12-31' GROUP BY symbol",
})


_FWD = "(w ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)"
ORACLE["forward_volatility"] = bars_with(*technical_ctes("bars")) + (
    "SELECT symbol, date, " + out(f"CASE WHEN count(returns_1d) OVER {_FWD} >= 5 THEN stddev_samp(returns_1d) OVER {_FWD} END")
    + " AS label_volatility_5d FROM tech WINDOW w AS (PARTITION BY symbol ORDER BY date)")


ORACLE["portfolio_rebalanced"] = feature_query(f"""
SELECT CAST(3 AS INTEGER) AS top_k, CAST(5.0 AS DOUBLE) AS cost_bps, CAST(count(*) * 3 AS BIGINT) AS n_trades,
  {out('product(1 + net_return) - 1')} AS cumulative_return,
  {out(f'avg(net_return) * {_F!r}')} AS annualised_return,
  {out(f'coalesce(stddev_samp(net_return), 0.0) * {_SQ!r}')} AS annualised_volatility,
  {out(f'CASE WHEN coalesce(stddev_samp(net_return), 0.0) * {_SQ!r} > 1e-12 THEN avg(net_return) * {_F!r} / (coalesce(stddev_samp(net_return), 0.0) * {_SQ!r}) ELSE 0.0 END')} AS sharpe_ratio,
  {out('min((equity - peak) / peak)')} AS max_drawdown,
  {out('avg(CASE WHEN net_return > 0 THEN 1.0 ELSE 0.0 END)')} AS win_rate
FROM (SELECT *, max(equity) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM (
        SELECT *, product(1 + net_return) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS equity FROM (
          SELECT date, avg(ret) - 2.0 * CAST(5.0 AS DOUBLE) / 10000.0 AS net_return
          FROM (SELECT s.*, row_number() OVER (PARTITION BY s.date ORDER BY s.p DESC, s.symbol ASC) AS pick_rank
                FROM scored s JOIN (SELECT date, row_number() OVER (ORDER BY date) AS rn FROM (SELECT DISTINCT date FROM scored)) d
                  ON s.date = d.date
                WHERE (d.rn - 1) % 5 = 0)
          WHERE pick_rank <= 3 GROUP BY date)))""", extra=[SCORED])


MODEL_INPUTS = [*TECH_COLS, "obv", "day_of_week", "day_of_month", "month", "quarter", "week_of_year", "year", *LAG_COLS, *[f"{c}_rank" for c in RANKS], "excess_returns_5d"]
FOLD_TRAIN = [bounds_cte("features"), folds_cte(), ROLES, "tr AS (SELECT r.fold, f.* FROM features f JOIN roles r ON r.role = 'train' AND f.date BETWEEN r.rs AND r.re)"]
ORACLE["model_medians"] = feature_query(
    f"SELECT fold, col AS column_name, {out('min(v) FILTER (cum >= 0.5 * n)')} AS median FROM ("
    "SELECT fold, col, v, sum(count(*)) OVER (PARTITION BY fold, col ORDER BY v) AS cum, sum(count(*)) OVER (PARTITION BY fold, col) AS n "
    "FROM (UNPIVOT (SELECT fold, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_INPUTS)
    + " FROM tr) ON COLUMNS(* EXCLUDE (fold)) INTO NAME col VALUE v) WHERE NOT isnan(v) GROUP BY fold, col, v) GROUP BY fold, col", extra=FOLD_TRAIN)
ORACLE["model_weights"] = feature_query(f"""
SELECT fold, model_name, n AS n_rows, {out("CASE WHEN model_name = 'gbt' THEN 1.0 ELSE n / (2.0 * (n - pos)) END")} AS weight_0,
       {out("CASE WHEN model_name = 'gbt' THEN (n - pos) / CAST(pos AS DOUBLE) ELSE n / (2.0 * pos) END")} AS weight_1
FROM (SELECT fold, count(*) AS n, sum(label_direction_5d) AS pos FROM tr GROUP BY fold), (VALUES ('logreg'), ('gbt')) m(model_name)""", extra=FOLD_TRAIN)

ORACLE["portfolio_capped"] = feature_query(f"""
SELECT frequency, date, count(*) AS n_picks, {out('least(1.0 / count(*), 0.25)')} AS weight,
       {out('least(1.0, 0.25 * count(*)) * avg(ret)')} AS gross_return, {out('least(1.0, 0.25 * count(*)) * (avg(ret) - 0.001)')} AS net_return
FROM (SELECT f.frequency, s.*, row_number() OVER (PARTITION BY f.frequency, s.date ORDER BY s.p DESC, s.symbol) AS rk
      FROM scored s JOIN (SELECT 'weekly' AS frequency, min(date) AS day FROM scored GROUP BY date_trunc('week', date)
                          UNION ALL SELECT 'monthly', min(date) FROM scored GROUP BY date_trunc('month', date)) f ON s.date = f.day)
WHERE rk <= 3 GROUP BY frequency, date""", extra=[SCORED])

ORACLE["portfolio_capital"] = feature_query(f"""
SELECT date, n_picks, {out('net')} AS net_return, {out('ln(1000000.0 * equity)')} AS log_capital, {out('equity / max(equity) OVER (ORDER BY date) - 1')} AS drawdown
FROM (SELECT *, product(1 + net) OVER (ORDER BY date) AS equity FROM (
  SELECT date, count(*) AS n_picks, least(1.0, 0.25 * count(*)) * (avg(ret / 100.0) - 0.001) AS net
  FROM (SELECT s.*, row_number() OVER (PARTITION BY s.date ORDER BY s.p DESC, s.symbol) AS rk
        FROM scored s JOIN (SELECT min(date) AS day FROM scored GROUP BY date_trunc('month', date)) f ON s.date = f.day)
  WHERE rk <= 3 GROUP BY date))""", extra=[SCORED])

_BAD = "{c} IS NULL OR isnan(CAST({c} AS DOUBLE))"
ORACLE |= {
    "requested_bars": bars_with() + f"SELECT symbol, date, {out('close')} AS close FROM bars WHERE symbol IN ('Brand#13', 'Brand#21', '^MKT', 'Brand#99', 'Brand#5', 'Brand#42')",
    "feature_windows": bars_with("""
kept AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n_bars FROM bars) WHERE n_bars >= 250)""", f"""
daily AS (SELECT *, close / lag(close, 1) OVER w - 1 AS r1, lead(close, 5) OVER w AS later, CAST(volume AS DOUBLE) AS v FROM kept WINDOW w AS (PARTITION BY symbol ORDER BY date))""", f"""
wide AS (
  SELECT symbol, date, later, {", ".join(f"close / lag(close, {n}) OVER w - 1 AS returns_{n}d, ln(close / lag(close, {n}) OVER w) AS log_returns_{n}d, {s.rolling('stddev_samp', 'r1', n)} AS volatility_{n}d" for n in _PRICE_WINDOWS)},
         {", ".join(f"(v - {s.rolling('avg', 'v', n)}) / {s.rolling('stddev_samp', 'v', n)} AS volume_zscore_{n}d" for n in _VOLUME_WINDOWS)}
  FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY date))""", f"ranked AS (SELECT *, {rank_sql('returns_20d', True)} FROM wide)")
        + select_out(["symbol", "date"], [*[f"{c}_{n}d" for n in _PRICE_WINDOWS for c in ("returns", "log_returns", "volatility")],
                                          *[f"volume_zscore_{n}d" for n in _VOLUME_WINDOWS], "returns_20d_rank"], source="ranked", where="WHERE later IS NOT NULL"),
    "sliding_frames": bars_with("slid AS (SELECT symbol, date, " + ", ".join(
        f"{s.rolling(sql, 'ln(close)', n)} AS {agg}_{n}" for n in _SLIDING_WINDOWS for agg, sql in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")))
        + " FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date))") + select_out(["symbol", "date"], [f"{agg}_{n}" for n in _SLIDING_WINDOWS for agg in ("mean", "std", "min", "max")], source="slid"),
    "instrument_page_ranges": bars_with(CAT) + """
SELECT page, min(symbol) AS first_symbol, max(symbol) AS last_symbol, count(*) AS n_rows
FROM (SELECT symbol, CAST((row_number() OVER (ORDER BY symbol) - 1) // 4 + 1 AS INTEGER) AS page FROM cat WHERE asset_type = 'stock') GROUP BY page""",
    "instrument_pages": bars_with(CAT) + "SELECT CAST((id - 1) // 7 + 1 AS INTEGER) AS page, symbol, count(*) OVER () AS total, CAST(ceil(count(*) OVER () / 7.0) AS INTEGER) AS pages FROM cat",
    "fill_zero": feature_query("SELECT symbol, date, " + ", ".join(out(f"CASE WHEN {_BAD.format(c=c)} THEN 0.0 ELSE {c} END") + f" AS {c}" for c in INPUTS) + " FROM features"),
    "impute_median": feature_query(applied("CASE WHEN isfinite({x}) THEN {x} ELSE {m} END", m="median"), extra=quantile_ctes(median=0.5)),
    "drop_sparse": feature_query(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (NOT ({_BAD.format(c=c)})) AS n_values FROM features HAVING avg(CASE WHEN {_BAD.format(c=c)} THEN 1.0 ELSE 0.0 END) <= 0.3"
        for c in MISSING_COLS)),
    "test_range": feature_query(
        "SELECT r.fold, r.role, count(*) AS n_rows, min(f.date) AS first_date, max(f.date) AS last_date FROM features f JOIN ("
        "SELECT fold, role, rs, re FROM roles UNION ALL SELECT fold, 'test', DATE '2000-01-01', DATE '9999-12-31' FROM folds) r "
        "ON f.date BETWEEN r.rs AND r.re GROUP BY r.fold, r.role", extra=[bounds_cte("features"), folds_cte(), ROLES]),
    "latest_run": """
SELECT event_type AS model_name, CAST(arg_max(event_id, ts) AS VARCHAR) AS run_id, 'models/' || arg_max(event_id, ts) AS model_path
FROM events WHERE event_type IN ('click', 'purchase') AND event_id % 3 <> 0 GROUP BY event_type""",
}
