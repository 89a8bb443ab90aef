"""Registered queries vs their DuckDB oracle on the smallest driver tables.

The full comparison at sf0.01 is ``python tests/run_oracle.py``; this keeps a
representative subset of every family in the regular test run.
"""

from __future__ import annotations

import pytest
from harness import compare, duck

import __spark_entry__ as entry

SUBSET = [
    "bars_daily", "index_bars", "clean_bars", "dedupe_first", "technical_stack", "macd", "cross_sectional_rank",
    "feature_matrix", "walk_forward_folds", "roc_auc", "average_precision", "portfolio_stats", "upsert_instruments",
    "upsert_predictions", "instrument_page", "latest_predictions", "winsorize", "event_features",
    "bronze_files", "bronze_ingest", "stream_ingest", "cross_sectional_rank_spread", "sliding_frames", "instrument_page_ranges",
]


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    problems = compare(df, con, entry.oracle_sql()[name])
    assert not problems, "\n".join(problems)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
