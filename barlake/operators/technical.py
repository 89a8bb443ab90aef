"""Per-symbol technical indicators as Spark window expressions.

Every function takes a long DataFrame keyed by ``(symbol, date)`` (any number
of symbols) and returns it with indicator columns appended.  All windows use
``partitionBy(symbol).orderBy(date)``, so one hash exchange on ``symbol`` feeds
every indicator; after cleaning, ``(symbol, date)`` is unique, so a symbol's
partition holds at most one row per calendar day.

Semantics (fixed by the reference behaviour):

* rolling aggregates are NULL until the trailing frame holds ``n`` non-null
  values; rolling standard deviations are sample (ddof = 1);
* a first-row difference counts as "no gain, no loss" (0, not NULL);
* float division is IEEE (``fdiv``): a zero range gives NaN/inf, not an error;
* the true range of the first bar is ``high - low`` (``greatest`` skips NULL);
* EMAs are ``adjust=False`` with ``alpha = 2 / (span + 1)`` seeded with the
  first value, computed without Python (see ``add_ema``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.numeric import fdiv, rolling

RETURN_PERIODS = (1, 5, 10, 20, 60)


def symbol_window(symbol: str = "symbol", order: str | list[str] = "date") -> WindowSpec:
    return Window.partitionBy(symbol).orderBy(order)


# --------------------------------------------------------------------------
# Staging rule: every window function is computed exactly once, into a
# column, by a select; arithmetic on window results (fdiv repeats its
# operands) happens in the next select.  Spark does not de-duplicate repeated
# window expressions, so writing ``fdiv(avg().over(w), ...)`` would evaluate
# the frame aggregate once per occurrence.
# --------------------------------------------------------------------------
def _lag_cols(w: WindowSpec, periods, price: str = "close") -> list[Column]:
    return [F.lag(price, n).over(w).alias(f"_lag{n}") for n in periods]


def _returns_from_lags(periods, price: str = "close") -> list[Column]:
    cols = []
    for n in periods:
        ratio = fdiv(F.col(price), F.col(f"_lag{n}"))
        cols.append((ratio - 1).alias(f"returns_{n}d"))
        cols.append(F.ln(ratio).alias(f"log_returns_{n}d"))
    return cols


def _guarded(agg, col: Column, w: WindowSpec, n: int, name: str) -> Column:
    """Window stage: the frame aggregate, NULL unless the frame holds ``n`` non-null values."""
    return rolling(agg, col, w, n).alias(name)


def _gain_loss() -> list[Column]:
    delta = F.col("close") - F.col("_lag1")
    return [
        F.when(delta > 0, delta).otherwise(F.lit(0.0)).alias("_gain"),
        F.when(delta < 0, -delta).otherwise(F.lit(0.0)).alias("_loss"),
    ]


def _rsi_from_means(avg_gain: Column, avg_loss: Column) -> Column:
    rs = fdiv(avg_gain, avg_loss)
    return F.lit(100.0) - fdiv(F.lit(100.0), F.lit(1.0) + rs)


def _true_range() -> Column:
    pc = F.col("_lag1")
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - pc), F.abs(F.col("low") - pc)).alias("_tr")


def _obv_direction() -> Column:
    pc = F.col("_lag1")
    return (F.when(F.col("close") > pc, F.lit(1)).when(F.col("close") < pc, F.lit(-1)).otherwise(F.lit(0))).alias("_dir")


def _bollinger_from_stats(window: int, n_std: float) -> list[Column]:
    mid, std = F.col(f"bb_mid_{window}"), F.col("_bb_sd")
    return [
        (mid + F.lit(n_std) * std).alias(f"bb_upper_{window}"),
        (mid - F.lit(n_std) * std).alias(f"bb_lower_{window}"),
    ]


def _bollinger_ratios(window: int) -> list[Column]:
    mid, up, lo = F.col(f"bb_mid_{window}"), F.col(f"bb_upper_{window}"), F.col(f"bb_lower_{window}")
    return [
        fdiv(up - lo, mid).alias(f"bb_width_{window}"),
        fdiv(F.col("close") - lo, up - lo).alias(f"bb_pct_{window}"),
    ]


def _stoch_k() -> Column:
    lo, hi = F.col("_ll"), F.col("_hh")
    return fdiv(F.lit(100.0) * (F.col("close") - lo), hi - lo).alias("stoch_k")


def _zscore(window: int) -> Column:
    return fdiv(F.col("volume").cast("double") - F.col(f"_vmean{window}"), F.col(f"_vsd{window}")).alias(f"volume_zscore_{window}d")




# --------------------------------------------------------------------------
# DataFrame-level operators (one per reference indicator)
# --------------------------------------------------------------------------
def add_returns(df: DataFrame, periods=RETURN_PERIODS, symbol="symbol", order="date") -> DataFrame:
    """Simple and log returns over trailing periods."""
    w = symbol_window(symbol, order)
    staged = df.select("*", *_lag_cols(w, periods))
    return staged.select(*df.columns, *_returns_from_lags(periods))


def add_rsi(df: DataFrame, window: int = 14, symbol="symbol", order="date") -> DataFrame:
    """Simple-mean RSI; both means 0 gives NaN, zero loss gives 100."""
    w = symbol_window(symbol, order)
    a = df.select("*", *_lag_cols(w, (1,)))
    b = a.select("*", *_gain_loss())
    c = b.select("*", _guarded(F.avg, F.col("_gain"), w, window, "_ag"), _guarded(F.avg, F.col("_loss"), w, window, "_al"))
    return c.select(*df.columns, _rsi_from_means(F.col("_ag"), F.col("_al")).alias(f"rsi_{window}"))


def add_bollinger_bands(df: DataFrame, window: int = 20, n_std: float = 2.0, symbol="symbol", order="date") -> DataFrame:
    """mid/upper/lower band, width and %B."""
    w = symbol_window(symbol, order)
    a = df.select("*", _guarded(F.avg, F.col("close"), w, window, f"bb_mid_{window}"),
                  _guarded(F.stddev_samp, F.col("close"), w, window, "_bb_sd"))
    b = a.select("*", *_bollinger_from_stats(window, n_std))
    names = [f"bb_mid_{window}", f"bb_upper_{window}", f"bb_lower_{window}"]
    return b.select(*df.columns, *names, *_bollinger_ratios(window))


def add_atr(df: DataFrame, window: int = 14, symbol="symbol", order="date") -> DataFrame:
    """Mean true range."""
    w = symbol_window(symbol, order)
    a = df.select("*", *_lag_cols(w, (1,)))
    b = a.select("*", _true_range())
    return b.select(*df.columns, _guarded(F.avg, F.col("_tr"), w, window, f"atr_{window}"))


def add_obv(df: DataFrame, symbol="symbol", order="date") -> DataFrame:
    """Running sum of sign(close change) * volume; first row 0."""
    w = symbol_window(symbol, order)
    a = df.select("*", *_lag_cols(w, (1,)))
    b = a.select("*", _obv_direction())
    obv = F.sum(F.col("_dir") * F.col("volume")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return b.select(*df.columns, obv.alias("obv"))


def add_stochastic(df: DataFrame, k_window: int = 14, d_window: int = 3, symbol="symbol", order="date") -> DataFrame:
    """%K over the trailing high/low range and its ``d_window`` mean %D."""
    w = symbol_window(symbol, order)
    a = df.select("*", _guarded(F.min, F.col("low"), w, k_window, "_ll"), _guarded(F.max, F.col("high"), w, k_window, "_hh"))
    b = a.select("*", _stoch_k())
    return b.select(*df.columns, "stoch_k", _guarded(F.avg, F.col("stoch_k"), w, d_window, "stoch_d"))


def add_volatility(df: DataFrame, windows=(20, 60), symbol="symbol", order="date") -> DataFrame:
    """Sample std of daily returns; adds ``returns_1d`` when absent."""
    w = symbol_window(symbol, order)
    base = df
    if "returns_1d" not in df.columns:
        a = df.select("*", *_lag_cols(w, (1,)))
        base = a.select(*df.columns, (fdiv(F.col("close"), F.col("_lag1")) - 1).alias("returns_1d"))
    r = F.col("returns_1d")
    return base.select("*", *[_guarded(F.stddev_samp, r, w, n, f"volatility_{n}d") for n in windows])


def add_volume_zscore(df: DataFrame, window: int = 20, symbol="symbol", order="date") -> DataFrame:
    """(volume - trailing mean) / trailing sample std."""
    w = symbol_window(symbol, order)
    vol = F.col("volume").cast("double")
    a = df.select("*", _guarded(F.avg, vol, w, window, f"_vmean{window}"), _guarded(F.stddev_samp, vol, w, window, f"_vsd{window}"))
    return a.select(*df.columns, _zscore(window))


# --------------------------------------------------------------------------
# Long trailing windows
# --------------------------------------------------------------------------
# A bounded sliding frame is aggregated anew for each row: its cost is rows x
# window.  Cut each symbol's rows into blocks of n by row index: the trailing n
# rows of a row are the end of one block and the beginning of the next (or one
# whole block).  Statistics of beginnings and ends of blocks are running
# aggregates, so a window of any length costs the same.  Two parts are put
# together from their counts, means and sums of squared deviations, so nothing
# is subtracted from a longer sum, and a NaN only counts while in the frame.
#: Statistics that ``add_sliding`` knows.
SLIDING = ("mean", "std", "min", "max")
#: Windows beyond this length are taken by ``add_sliding`` in the feature stack.
LONG_WINDOW = 128


def add_sliding(df: DataFrame, specs: list[tuple[str, str, int, str]], symbol: str = "symbol", order: str = "date") -> DataFrame:
    """Append trailing statistics, NULL until the frame holds ``n`` non-null values; ``specs`` = [(statistic, column, n, output)]."""
    if unknown := {s[0] for s in specs} - set(SLIDING):
        raise ValueError(f"unknown statistics {sorted(unknown)}; there are {SLIDING}")
    columns = df.columns
    out = add_row_index(df, symbol, order, "_row")
    for n in sorted({s[2] for s in specs}):
        out = _sliding(out, [s for s in specs if s[2] == n], n, symbol, order)
    return out.select(*columns, *[s[3] for s in specs])


def _sliding(df: DataFrame, specs: list[tuple[str, str, int, str]], n: int, symbol: str, order: str) -> DataFrame:
    columns, block = df.columns, F.floor(F.col("_row") / n)
    ends = Window.partitionBy(symbol, block)
    frame = (Window.unboundedPreceding, Window.currentRow)
    parts = {}  # what the statistics of each column need: (name, aggregate)
    for agg, c, _, _ in specs:
        x = F.col(c)
        parts.setdefault(c, {})["n"] = F.count(x)
        parts[c] |= {"mean": {"m": F.avg(x)}, "std": {"m": F.avg(x), "v": F.var_pop(x)}, "min": {"lo": F.min(x)}, "max": {"hi": F.max(x)}}[agg]
    named = [(f"{c}_{p}", a) for c, found in parts.items() for p, a in found.items()]
    begun = df.select("*", *[a.over(ends.orderBy(order).rowsBetween(*frame)).alias(f"_b_{p}") for p, a in named])
    both = begun.select("*", *[a.over(ends.orderBy(F.col(order).desc()).rowsBetween(*frame)).alias(f"_e_{p}") for p, a in named])
    # the end of the block before begins n - 1 rows ago; at a block's last row the block itself is the frame
    before = both.select("*", *[F.lag(f"_e_{p}", n - 1).over(symbol_window(symbol, order)).alias(f"_a_{p}") for p, _ in named])
    whole = (F.col("_row") + 1) % n == 0

    def value(agg: str, c: str) -> Column:
        a, b = (lambda p: F.col(f"_a_{c}_{p}")), (lambda p: F.col(f"_b_{c}_{p}"))
        count = F.when(whole, b("n")).otherwise(F.coalesce(a("n"), F.lit(0)) + b("n"))
        if agg in ("min", "max"):
            p, pick = ("lo", F.least) if agg == "min" else ("hi", F.greatest)
            found = F.when(whole, b(p)).otherwise(pick(a(p), b(p)))
        else:
            gap, weight = b("m") - a("m"), a("n") * b("n") / F.lit(float(n))
            if agg == "mean":
                found = F.when(whole, b("m")).otherwise(a("m") + gap * b("n") / F.lit(float(n)))
            else:
                squares = F.when(whole, b("v") * b("n")).otherwise(a("v") * a("n") + b("v") * b("n") + gap * gap * weight)
                found = F.sqrt(squares / F.lit(float(n - 1))) if n > 1 else F.lit(None).cast("double")
        return F.when(count >= n, found)

    return before.select(*columns, *[value(agg, c).alias(name) for agg, c, _, name in specs])


# --------------------------------------------------------------------------
# EMA without a recursive operator
# --------------------------------------------------------------------------
# With r = 1 - alpha the adjust=False recursion y_t = r*y_{t-1} + alpha*x_t,
# y_0 = x_0 unrolls to  y_t = r^t * (x_0 + alpha * sum_{i<=t} r^-i x_i).
# r^-i overflows for long histories, so rows are cut into chunks of B rows
# (per symbol, by row index) and the sum restarts in every chunk:
#
#   local(t) = r^p * sum_{rows i of t's chunk, i<=t} c_i r^-p_i x_i     (p = position in chunk)
#   y_t      = local(t) + r^(p+1) * Y_prev
#
# where Y_prev is y at the end of the previous chunk.  B is chosen so that
# r^B <= e^-60: the previous chunk's own carry then weighs less than 1e-26
# and Y_prev equals local() at the previous chunk's last row to double
# precision.  Every piece is a running sum or a "last non-null so far",
# evaluated incrementally by Spark (O(rows), JVM only), and all of them need
# the rows of a symbol by (chunk, date): one sort.
_EMA_LOG_RANGE = 60.0


def _ema_chunk_rows(spans: list[int]) -> int:
    rates = [-math.log(1.0 - 2.0 / (s + 1.0)) for s in spans if s > 1]
    if not rates:
        return 1
    return max(1, math.ceil(_EMA_LOG_RANGE / min(rates)))


def add_row_index(df: DataFrame, symbol="symbol", order="date", name="_idx") -> DataFrame:
    return df.select("*", (F.row_number().over(symbol_window(symbol, order)) - 1).alias(name))


def add_chunks(df: DataFrame, rows: int, symbol: str = "symbol", order: str = "date", idx_col: str = "_idx", name: str = "_chunk") -> DataFrame:
    """Each row's index (if it is not there) and its chunk of ``rows`` rows.

    The chunk never falls with the order, so windows over (chunk, order) run like those
    over the order alone, and share one sort with the windows inside chunks.
    """
    indexed = df if idx_col in df.columns else add_row_index(df, symbol, order, idx_col)
    return indexed.withColumn(name, F.floor(F.col(idx_col) / F.lit(rows)))


def add_ema(
    df: DataFrame,
    specs: list[tuple[str, int, str]],
    symbol: str = "symbol",
    order: str = "date",
    idx_col: str = "_idx",
    chunks: tuple[str, int] | None = None,
) -> DataFrame:
    """Append ``adjust=False`` EMAs; ``specs`` = [(input column, span, output)].

    Inputs must be non-null (cleaned bars guarantee it for prices).  All specs
    share one chunk length, so they share the chunk window.  ``chunks``: the chunk
    column and length of rows that have them already.
    """
    spans = [s for _, s, _ in specs]
    chunk_col, chunk_rows = chunks or ("_chunk", _ema_chunk_rows(spans))
    if not _one_chunk_length(spans, chunk_rows):
        for spec in specs:
            df = add_ema(df, [spec], symbol, order, idx_col)
        return df
    keep = [c for c in df.columns if c != chunk_col or chunks]
    if not chunks:
        df = add_chunks(df, chunk_rows, symbol, order, idx_col, chunk_col)
    idx, chunk = F.col(idx_col), F.col(chunk_col)
    pos = (idx - chunk * F.lit(chunk_rows)).cast("double")

    w_chunk = Window.partitionBy(symbol, chunk_col).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local_cols = []
    for col_name, span, out_name in specs:
        if span <= 1:
            local_cols.append(F.col(col_name).cast("double").alias(f"_loc_{out_name}"))
            continue
        alpha = 2.0 / (span + 1.0)
        rate = -math.log(1.0 - alpha)
        coef = F.when(idx == 0, F.lit(1.0)).otherwise(F.lit(alpha))
        term = coef * F.col(col_name).cast("double") * F.exp(pos * F.lit(rate))
        local = F.exp(-pos * F.lit(rate)) * F.sum(term).over(w_chunk)
        local_cols.append(local.alias(f"_loc_{out_name}"))
    df = df.select("*", *local_cols)

    w_before = Window.partitionBy(symbol).orderBy(chunk_col, order).rowsBetween(Window.unboundedPreceding, -1)
    is_end = pos == F.lit(float(chunk_rows - 1))
    final_cols = []
    for _, span, out_name in specs:
        loc = F.col(f"_loc_{out_name}")
        if span <= 1:
            final_cols.append(loc.alias(out_name))
            continue
        rate = -math.log(1.0 - 2.0 / (span + 1.0))
        carry = F.last(F.when(is_end, loc), ignorenulls=True).over(w_before)
        y = loc + F.coalesce(F.exp(-(pos + F.lit(1.0)) * F.lit(rate)) * carry, F.lit(0.0))
        final_cols.append(y.alias(out_name))
    return df.select(*keep, *final_cols)


def add_macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, symbol="symbol", order="date",
             chunks: tuple[str, int] | None = None) -> DataFrame:
    """MACD line (EMA fast - EMA slow), signal EMA and histogram."""
    own, rows = df.columns, macd_chunk_rows(fast, slow, signal)
    if not chunks and rows:
        df, chunks = add_chunks(df, rows, symbol, order), ("_chunk", rows)
    if "_idx" not in df.columns:
        df = add_row_index(df, symbol, order)
    df = add_ema(df, [("close", fast, "_ema_fast"), ("close", slow, "_ema_slow")], symbol, order, chunks=chunks)
    df = df.withColumn("macd", F.col("_ema_fast") - F.col("_ema_slow")).drop("_ema_fast", "_ema_slow")
    df = add_ema(df, [("macd", signal, "macd_signal")], symbol, order, chunks=chunks)
    return df.select(*own, "macd", "macd_signal", (F.col("macd") - F.col("macd_signal")).alias("macd_hist"))


def _one_chunk_length(spans: list[int], rows: int) -> bool:
    """Whether powers of the fastest decay stay finite over a chunk."""
    fastest = max((-math.log(1.0 - 2.0 / (s + 1.0)) for s in spans if s > 1), default=0.0)
    return (rows - 1) * fastest <= 600.0


def macd_chunk_rows(fast: int = 12, slow: int = 26, signal: int = 9) -> int | None:
    """A chunk length that suits all three averages; None if they are too far apart."""
    rows = _ema_chunk_rows([fast, slow, signal])
    return rows if _one_chunk_length([fast, slow, signal], rows) else None


# --------------------------------------------------------------------------
# Full stack (W11) in dependency layers over one symbol partitioning.
# --------------------------------------------------------------------------
def add_all_technical(df: DataFrame, symbol: str = "symbol", order: str = "date", price_windows: tuple[int, ...] | None = None,
                      volume_windows: tuple[int, ...] | None = None) -> DataFrame:
    """All indicator columns in the reference order (26 with the default windows).

    ``price_windows`` are those of returns and volatility, ``volume_windows``
    those of the volume z-score; None keeps the defaults.

    Alternating window stages and projections over one partitioning
    (``symbol``), so the plan has a single exchange; each stage's window
    functions share one Window operator and the sort order carries over: after
    the row index, all windows, those of the EMA chunks too, run over (chunk,
    date).  Windows beyond ``LONG_WINDOW`` are taken by ``add_sliding``.
    """
    base_cols = df.columns
    stack = technical_stack(df, symbol, order, price_windows, volume_windows)
    return stack.select(*base_cols, *technical_column_names(price_windows, volume_windows))


#: What orders a symbol's rows in the stack; ``CHUNK_COLUMN`` is added by ``add_chunks``.
CHUNK_COLUMN = "_chunk"


def technical_stack(df: DataFrame, symbol: str, order: str, price_windows: tuple[int, ...] | None, volume_windows: tuple[int, ...] | None) -> DataFrame:
    """``add_all_technical`` with its helper columns, the chunk among them."""
    returns, volatility, volume = window_lists(price_windows, volume_windows)
    short = lambda windows: [n for n in windows if n <= LONG_WINDOW]
    chunks = (CHUNK_COLUMN, macd_chunk_rows())
    df = add_chunks(df, chunks[1], symbol, order)
    w = Window.partitionBy(symbol).orderBy(CHUNK_COLUMN, order)
    cum = w.rowsBetween(Window.unboundedPreceding, 0)
    close, vol = F.col("close"), F.col("volume").cast("double")
    lagged = sorted({1, *returns})
    # stage 1 (windows over raw columns)
    s1 = df.select(
        "*",
        *_lag_cols(w, lagged),
        _guarded(F.avg, close, w, 20, "bb_mid_20"),
        _guarded(F.stddev_samp, close, w, 20, "_bb_sd"),
        _guarded(F.min, F.col("low"), w, 14, "_ll"),
        _guarded(F.max, F.col("high"), w, 14, "_hh"),
        *[c for n in short(volume) for c in (_guarded(F.avg, vol, w, n, f"_vmean{n}"), _guarded(F.stddev_samp, vol, w, n, f"_vsd{n}"))],
    )
    if long := [n for n in volume if n > LONG_WINDOW]:
        s1 = add_sliding(s1.withColumn("_vol", vol), [(a, "_vol", n, f"{p}{n}") for n in long for a, p in (("mean", "_vmean"), ("std", "_vsd"))], symbol, order)
    # projection
    s2 = s1.select(
        "*", *_returns_from_lags(sorted({1, *returns})), *_gain_loss(), _true_range(), _obv_direction(),
        *_bollinger_from_stats(20, 2.0), _stoch_k(), *[_zscore(n) for n in volume],
    )
    # stage 2 (windows over stage-1 results)
    r1 = F.col("returns_1d")
    s3 = s2.select(
        "*",
        *_bollinger_ratios(20),
        _guarded(F.avg, F.col("_gain"), w, 14, "_ag"),
        _guarded(F.avg, F.col("_loss"), w, 14, "_al"),
        _guarded(F.avg, F.col("_tr"), w, 14, "atr_14"),
        F.sum(F.col("_dir") * F.col("volume")).over(cum).alias("obv"),
        _guarded(F.avg, F.col("stoch_k"), w, 3, "stoch_d"),
        *[_guarded(F.stddev_samp, r1, w, n, f"volatility_{n}d") for n in short(volatility)],
    )
    if long := [n for n in volatility if n > LONG_WINDOW]:
        s3 = add_sliding(s3, [("std", "returns_1d", n, f"volatility_{n}d") for n in long], symbol, order)
    s4 = s3.select("*", _rsi_from_means(F.col("_ag"), F.col("_al")).alias("rsi_14"))
    return add_macd(s4, symbol=symbol, order=order, chunks=chunks)


def window_lists(price_windows: tuple[int, ...] | None, volume_windows: tuple[int, ...] | None) -> tuple[tuple[int, ...], tuple[int, ...], tuple[int, ...]]:
    """Windows of returns, volatility and volume z-score.  One-day returns are always there, as lags are made of them; so is the 20-day z-score."""
    returns = RETURN_PERIODS if price_windows is None else tuple(sorted({1, *price_windows}))
    volatility = (20, 60) if price_windows is None else tuple(sorted({n for n in price_windows if n > 1}))
    volume = (20,) if volume_windows is None else tuple(sorted({20, *volume_windows}))
    return returns, volatility, volume


def technical_column_names(price_windows: tuple[int, ...] | None = None, volume_windows: tuple[int, ...] | None = None) -> list[str]:
    returns, volatility, volume = window_lists(price_windows, volume_windows)
    names = []
    for n in returns:
        names += [f"returns_{n}d", f"log_returns_{n}d"]
    names += ["rsi_14", "macd", "macd_signal", "macd_hist"]
    names += ["bb_mid_20", "bb_upper_20", "bb_lower_20", "bb_width_20", "bb_pct_20"]
    names += ["atr_14", "obv", "stoch_k", "stoch_d"]
    return names + [f"volatility_{n}d" for n in volatility] + [f"volume_zscore_{n}d" for n in volume]
