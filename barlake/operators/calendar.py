"""Calendar columns derived from ``date`` (C1-C5); no window, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR_COLUMNS = [
    "day_of_week", "day_of_month", "month", "quarter", "week_of_year", "year",
    "is_month_start", "is_month_end", "is_quarter_end_month",
]


def calendar_columns(date: str = "date") -> list[Column]:
    d = F.col(date)
    return [
        (F.weekday(d) + 1).alias("day_of_week"),  # ISO: 1 = Monday ... 7 = Sunday
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_of_year"),  # ISO week
        F.year(d).alias("year"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),  # last calendar day, not last trading day
        F.month(d).isin(3, 6, 9, 12).alias("is_quarter_end_month"),
    ]


def add_calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    return df.select("*", *calendar_columns(date))
