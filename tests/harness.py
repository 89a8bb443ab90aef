"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else repr(f)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in records], sorted(columns)


SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "DateType": "DATE", "BooleanType": "BOOLEAN", "TimestampType": "TIMESTAMP", "ByteType": "TINYINT"}


def type_problems(spark_df, res):
    s_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in spark_df.schema.fields}
    d_types = dict(zip(res.columns, [str(t) for t in res.types]))
    return [f"type {c}: spark={s_types[c]} duck={d_types.get(c)}" for c in s_types if c in d_types and s_types[c] != d_types[c]]


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows, s_names = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.sql(sql)
    d_cols = res.columns
    d_rows, d_names = rows_of(d_cols, res.fetchall())
    problems = type_problems(spark_df, res)
    if s_names != d_names:
        problems.append(f"columns differ: spark={s_names} duck={d_names}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    cs, cd = Counter(s_rows), Counter(d_rows)
    only_s, only_d = cs - cd, cd - cs
    if only_s or only_d:
        problems.append(f"{sum(only_s.values())} rows only in spark, {sum(only_d.values())} only in duck")
        problems.append(f"  names: {s_names}")
        for r in list(only_s)[:3]:
            problems.append(f"  spark: {r}")
        for r in list(only_d)[:3]:
            problems.append(f"  duck : {r}")
    return problems
