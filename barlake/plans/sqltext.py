"""Shared DuckDB SQL text for the oracle queries.

The CTEs mirror ``barlake.sources.fixtures``: they define the same bar views
over the driver's tables with DuckDB's own aggregates (``arg_min``/``arg_max``
on a row key), so an oracle query is an independent formulation, not a
translation of the Spark plan.
"""

from __future__ import annotations

LINES = """
lines AS (
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice / l_quantity AS px, l_quantity, l_discount, l_tax,
         l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

_KEY = "row(l_orderkey, l_linenumber, l_partkey, l_suppkey, px)"

BRAND = f"""
brand_bars AS (
  SELECT symbol, 'jp' AS market, 'stock' AS asset_type, date,
         arg_min(px, {_KEY}) AS open, max(px) AS high, min(px) AS low,
         arg_max(px, {_KEY}) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume, CAST(NULL AS BIGINT) AS open_interest
  FROM lines GROUP BY symbol, date
)"""

INDEX = f"""
index_bars AS (
  SELECT '^MKT' AS symbol, 'jp' AS market, 'index' AS asset_type, date,
         arg_min(px, {_KEY}) AS open, max(px) AS high, min(px) AS low,
         arg_max(px, {_KEY}) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume, CAST(NULL AS BIGINT) AS open_interest
  FROM lines GROUP BY date
)"""

BARS = "bars AS (SELECT * FROM brand_bars UNION ALL SELECT * FROM index_bars)"

RAW = """
raw_bars AS (
  SELECT symbol, 'jp' AS market, 'stock' AS asset_type, date,
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE px END AS open,
         CASE WHEN l_linenumber = 6 THEN px * (1.0 - l_discount) ELSE px * (1.0 + l_tax) END AS high,
         CASE WHEN l_linenumber = 6 THEN px * (1.0 + l_tax) ELSE px * (1.0 - l_discount) END AS low,
         CASE WHEN l_linenumber = 5 AND l_linestatus = 'F' THEN -px ELSE px END AS close,
         CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS volume,
         CAST(NULL AS BIGINT) AS open_interest,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, px
  FROM lines
)"""

EVENT_BARS = """
event_bars AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, 'us' AS market, 'stock' AS asset_type,
         CAST(ts AS DATE) AS date,
         arg_min(value, row(ts, event_id, value)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, row(ts, event_id, value)) AS close,
         CAST(count(*) AS BIGINT) AS volume, CAST(NULL AS BIGINT) AS open_interest
  FROM events GROUP BY 1, 4
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"




def out(expr: str, digits: int = 6) -> str:
    """Presentation of a float: NaN/inf -> NULL, finite values rounded."""
    scale = f"CAST({float(10 ** digits)!r} AS DOUBLE)"
    return f"CASE WHEN isfinite(CAST({expr} AS DOUBLE)) THEN round(CAST({expr} AS DOUBLE) * {scale}) / {scale} + 0.0 END"




def rolling(agg: str, expr: str, n: int, window: str = "w") -> str:
    frame = f"({window} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"(CASE WHEN count({expr}) OVER {frame} >= {n} THEN {agg}({expr}) OVER {frame} END)"


def ema(expr: str, span: int, window: str = "w") -> str:
    a = 2.0 / (span + 1.0)
    return (
        f"list_reduce(list(CAST({expr} AS DOUBLE)) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"lambda acc, v: acc * CAST(1.0 - {a!r} AS DOUBLE) + v * CAST({a!r} AS DOUBLE))"
    )
