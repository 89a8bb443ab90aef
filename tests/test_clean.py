"""Validation and first-wins dedupe (the reference's clean cases)."""

from __future__ import annotations

from datetime import date

from barlake.operators.clean import clean_bars, filter_min_history, quality_report

SCHEMA = ("symbol string, date date, open double, high double, low double, close double, volume bigint, "
          "open_interest bigint, src_pos bigint")


def bars(spark, rows):
    return spark.createDataFrame([("S",) + r + (i,) for i, r in enumerate(rows)], SCHEMA)


def test_empty(spark):
    assert clean_bars(spark.createDataFrame([], SCHEMA)).count() == 0


def test_validity_rules(spark):
    rows = [
        (date(2024, 1, 1), None, 11.0, 9.0, 10.0, 1, 0),   # null open
        (date(2024, 1, 2), 0.0, 11.0, 9.0, 10.0, 1, 0),    # zero open
        (date(2024, 1, 3), -1.0, 11.0, 9.0, 10.0, 1, 0),   # negative open
        (date(2024, 1, 4), 10.0, 8.0, 9.0, 10.0, 1, 0),    # high < low
        (date(2024, 1, 5), 10.0, 11.0, 9.0, 10.0, 1, 0),   # valid
    ]
    out = clean_bars(bars(spark, rows)).collect()
    assert [r.date for r in out] == [date(2024, 1, 5)]


def test_first_wins_and_sorted(spark):
    rows = [
        (date(2024, 1, 3), 10.0, 11.0, 9.0, 10.0, 1, 0),
        (date(2024, 1, 2), 10.0, 11.0, 9.0, 10.0, 1, 0),
        (date(2024, 1, 2), 99.0, 100.0, 98.0, 99.0, 1, 0),
    ]
    out = clean_bars(bars(spark, rows)).orderBy("date").collect()
    assert [r.date for r in out] == [date(2024, 1, 2), date(2024, 1, 3)]
    assert out[0].open == 10.0


def test_volume_filled_open_interest_kept(spark):
    rows = [(date(2024, 1, 1), 10.0, 11.0, 9.0, 10.0, None, None)]
    r = clean_bars(bars(spark, rows)).collect()[0]
    assert r.volume == 0 and r.open_interest is None


def test_quality_report_and_min_history(spark):
    rows = [(date(2024, 1, d), 10.0, 11.0, 9.0, 10.0, 1, 0) for d in (1, 2, 2, 3)] + [(date(2024, 1, 9), None, 1.0, 1.0, 1.0, 1, 0)]
    raw = bars(spark, rows)
    rep = quality_report(raw, clean_bars(raw)).collect()[0]
    assert (rep.rows_in, rep.rows_valid, rep.rows_out, rep.rows_dropped) == (5, 4, 3, 2)
    assert filter_min_history(clean_bars(raw), 3).count() == 3
    assert filter_min_history(clean_bars(raw), 4).count() == 0
