"""DuckDB SQL for ``lake_queries``."""

from __future__ import annotations

from barlake.plans.lake_queries import FOLDERS, HEADERS, INVALID, LIMIT, OTHER_SUFFIX
from barlake.plans.oracle import CAT, bars_with, dec, feature_query, gold
from barlake.plans.sqltext import out

_Q = lambda values: "[" + ", ".join("'" + v.replace("\r", "' || chr(13) || '") + "'" for v in values) + "]"

_CELLS = """CASE l_suppkey % 5
    WHEN 0 THEN concat_ws(',', 'T', 'D', d, '000000', o, h, l, c, v, '0') WHEN 1 THEN concat_ws(',', d, c, o, l, h, 'T')
    WHEN 2 THEN concat_ws(',', 'T', d, o, h, l, c, v) || chr(13) WHEN 3 THEN concat_ws(',', 'T', d, o)
    ELSE concat_ws(',', 'T', d, o, '-1', h, l, c, v, '7') END"""

_PARSED = f"""
WITH cells AS (
  SELECT l_suppkey, (l_orderkey * 7 + l_linenumber) % 50 AS f, trunc(l_extendedprice)::BIGINT AS px, trunc(l_quantity)::BIGINT AS q,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 50 = 2 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%Y%m%d') END AS d,
         CASE WHEN f = 3 THEN 'n/a' ELSE px::VARCHAR END AS o, (px + q)::VARCHAR AS h, (px - 1)::VARCHAR AS l, px::VARCHAR AS c,
         CASE WHEN f = 5 THEN '' ELSE q::VARCHAR END AS v
  FROM lineitem),
plain AS (SELECT *, {_CELLS} AS p FROM cells),
lines AS (
  SELECT l_suppkey, CASE WHEN f = 0 THEN array_to_string(string_split(p, ',')[1:2], ',') WHEN f = 1 THEN ' ' WHEN f = 4 THEN 'extra,' || p ELSE p END AS line,
         {_Q(HEADERS)}[l_suppkey % 5 + 1] AS head, {_Q(FOLDERS)}[l_suppkey % 6 + 1] AS folder, lpad(l_suppkey::VARCHAR, 4, '0') AS code
  FROM plain),
kinds AS (
  SELECT *, CASE lower(string_split(folder, '/')[1]) WHEN 'tse stocks' THEN 'stock' WHEN 'tse etfs' THEN 'etf' WHEN 'tse indices' THEN 'index' WHEN 'tse futures' THEN 'future' END AS asset_type,
         [trim(replace(x, chr(13), '')) FOR x IN string_split(head, ',')] AS names, [trim(replace(x, chr(13), '')) FOR x IN string_split(line, ',')] AS vals
  FROM lines WHERE trim(line) <> ''),
fields AS (
  SELECT *, {", ".join(f"nullif(vals[nullif(list_position(names, '<{h}>'), 0)], '') AS raw_{h.lower()}" for h in ("TICKER", "DATE", "OPEN", "HIGH", "LOW", "CLOSE", "VOL", "OPENINT"))}
  FROM kinds WHERE asset_type IS NOT NULL),
parsed AS (
  SELECT 'hdfs://lake:8020/data/raw/jp/' || folder || '/' || code || '.jp.TXT' AS file_path, code || '.JP' AS symbol, 'jp' AS market, asset_type,
         CASE WHEN regexp_full_match(raw_date, '[0-9]{{8}}') THEN strptime(raw_date, '%Y%m%d')::DATE END AS date, TRY_CAST(raw_open AS DOUBLE) AS open, TRY_CAST(raw_high AS DOUBLE) AS high,
         TRY_CAST(raw_low AS DOUBLE) AS low, TRY_CAST(raw_close AS DOUBLE) AS close, TRY_CAST(raw_vol AS DOUBLE)::BIGINT AS volume, TRY_CAST(raw_openint AS DOUBLE)::BIGINT AS open_interest, line,
         CASE WHEN NOT list_has_all(names, ['<TICKER>', '<DATE>', '<OPEN>', '<HIGH>', '<LOW>', '<CLOSE>']) THEN 'missing required columns'
              WHEN len(vals) <> len(names) THEN 'field count differs from header' WHEN date IS NULL THEN 'unparseable date'
              WHEN raw_open IS NOT NULL AND open IS NULL THEN 'unparseable number' END AS reason
  FROM fields)
"""

_FILES = _PARSED + f""",
files AS (
  SELECT symbol, market, asset_type, date, open, high, low, close, volume, open_interest FROM parsed
  WHERE reason IS NULL AND CAST(regexp_extract(symbol, '[0-9]+') AS INTEGER) % 7 <> {OTHER_SUFFIX}
  UNION ALL
  SELECT lpad(l_suppkey::VARCHAR, 4, '0') || 'X.JP', 'jp', 'stock', l_shipdate::DATE, 1, 1, 2, 1, 5, 0 FROM lineitem WHERE l_suppkey % 9 = {INVALID})
"""

_DROPS = """
drops AS (
  SELECT 1 AS n, upper(symbol) AS symbol, asset_type, date, open, high, low, close, volume FROM bars WHERE asset_type = 'stock' AND date >= DATE '1996-07-01'
  UNION ALL SELECT 2, upper(symbol), asset_type, date, open, high, low, close, volume FROM bars WHERE asset_type = 'stock' AND date < DATE '1996-07-01'
  UNION ALL SELECT 3, upper(symbol), asset_type, date, open, high, low, close + 1, volume FROM bars WHERE asset_type = 'stock' AND date >= DATE '1998-01-01'
  UNION ALL SELECT 3, symbol, asset_type, date, open, high, low, close, volume FROM bars WHERE asset_type = 'index'),
seen AS (SELECT symbol, min(n) AS first_n, max(n) AS last_n, min(date) AS listed_at, any_value(asset_type) AS asset_type FROM drops GROUP BY symbol),
numbered AS (SELECT *, row_number() OVER (ORDER BY first_n, symbol) AS ticker_id FROM seen),
newest AS (SELECT symbol, date, arg_max(struct_pack(open := open, high := high, low := low, close := close, volume := volume), n) AS b FROM drops GROUP BY symbol, date)
"""

ORACLE = {
    "bronze_files": _FILES + "SELECT * FROM files",
    "bronze_ingest": _FILES + f""",
asked AS (SELECT DISTINCT symbol FROM files ORDER BY symbol LIMIT {LIMIT})
SELECT symbol, min(market) AS market, min(asset_type) AS asset_type, CASE WHEN min(asset_type) = 'stock' THEN symbol[1] || '000' END AS sector_code, min(date) AS listed_at,
       count(DISTINCT CASE WHEN open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low THEN date END) AS n_bars
FROM files SEMI JOIN asked USING (symbol) GROUP BY symbol HAVING n_bars > 0""",
    "stream_ingest": bars_with(_DROPS) + f"""
SELECT ticker_id, symbol, asset_type, listed_at, '2025-01-0' || first_n AS created, '2025-01-0' || last_n AS updated, date,
       {", ".join(f"CAST({dec('b.' + c)} AS DOUBLE) AS {c}" for c in ("open", "high", "low", "close"))}, b.volume AS volume, {out("b.close")} AS silver_close
FROM newest JOIN numbered USING (symbol)""",
    "bronze_parse": _PARSED + "SELECT symbol, market, asset_type, date, open, high, low, close, volume, open_interest FROM parsed WHERE reason IS NULL",
    "bronze_rejects": _PARSED + "SELECT file_path, line, reason FROM parsed WHERE reason IS NOT NULL",
    "bronze_instruments": _PARSED + """
SELECT symbol, min(market) AS market, min(asset_type) AS asset_type, CASE WHEN min(asset_type) = 'stock' THEN symbol[1] || '000' END AS sector_code,
       min(date) AS listed_at, nullif(count(DISTINCT CASE WHEN open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low THEN date END), 0) AS n_bars
FROM parsed WHERE reason IS NULL GROUP BY symbol""",
    "silver_roundtrip": bars_with() + f"""
SELECT symbol, market, asset_type, date, {out("(close + CASE WHEN asset_type = 'index' THEN 1 ELSE 0 END)")} AS close, volume, open_interest FROM bars""",
    "load_twice": bars_with(CAT, f"loaded AS ({gold('bars')})") + """
SELECT ticker_id, symbol, listed_at, '2025-01-01' AS created, '2025-01-02' AS updated, date, CAST(open AS DOUBLE) AS open,
       CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume, open_interest
FROM loaded JOIN cat ON loaded.ticker_id = cat.id""",
    "loaded_rows": bars_with() + "SELECT symbol, count(*) AS rows_loaded FROM bars WHERE asset_type = 'stock' GROUP BY symbol",
    "processed_roundtrip": feature_query("""
SELECT symbol, CAST(year(date) AS INTEGER) AS year, count(*) AS n_rows, count(rsi_14) AS n_rsi, count(returns_60d_rank) AS n_rank,
       CAST(sum(CAST(label_direction_5d AS INTEGER)) AS BIGINT) AS n_up, min(date) AS first_date, max(date) AS last_date
FROM features GROUP BY ALL"""),
    "catalogue_scan": bars_with() + """
SELECT row_number() OVER (ORDER BY symbol) AS id, symbol, min(market) AS market, min(asset_type) AS asset_type, CAST(NULL AS VARCHAR) AS sector_code,
       min(date) AS listed_at, true AS is_active
FROM bars GROUP BY symbol""",
}
