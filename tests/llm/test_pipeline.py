"""The corpus pipeline end to end: every stage on awkward rows and an empty table, and the whole run against its parts."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import SF, awkward, docs_table, nothing

import corpus_pipeline as P
from barlake.llm import span_dedup

N_FILTERS = len(P.STAGES) - 1


def documents(spark):
    """Awkward rows with the columns of documents and more."""
    return awkward(spark).withColumnRenamed("score", "n_chars")


@pytest.mark.parametrize("stage", range(N_FILTERS))
def test_filtering_stages_on_awkward_rows(spark, stage):
    docs = documents(spark)
    out = P.STAGES[stage][1](spark, docs, SF)
    assert out.columns == docs.columns
    rows, known = out.collect(), {(r.doc_id, r.source) for r in docs.collect()}
    assert len(rows) <= docs.count() and {(r.doc_id, r.source) for r in rows} <= known


@pytest.mark.parametrize("stage", range(N_FILTERS))
def test_filtering_stages_on_an_empty_table(spark, stage):
    out = P.STAGES[stage][1](spark, nothing(spark), SF)
    assert out.columns == nothing(spark).columns and out.collect() == []


def test_packing_stage(spark):
    assert P.packing_stage(spark, nothing(spark), SF).collect() == []
    docs = documents(spark).where("doc_id > 1")  # ids that occur once
    lengths, tokens = {}, {}
    for p in P.packing_stage(spark, docs, SF).collect():
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
        tokens[p.doc_id] = p.doc_tokens
    assert lengths == tokens and set(lengths) == {r.doc_id for r in docs.collect()}


def test_whole_run(spark):
    """run() gives the pieces of what the stages leave one after another, and each stage does its work."""
    docs, left = docs_table(spark), []
    n = docs.count()
    for _, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        left.append(docs.count())
    assert n > left[0] >= left[1] > left[2] >= left[3] > n // 2
    kept = {r.doc_id: r.text for r in docs.collect()}
    pieces = P.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == set(kept)
    used = {}
    for p in pieces:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in used.values():  # gapless sequences of at most 2048 tokens
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *[m for _, m in places[:-1]]]).tolist() and sum(m for _, m in places) <= 2048
    # no span of the stage's own units is left twice
    spans = [h for text in kept.values() for h in set(span_dedup.spans_of(span_dedup.units_of(text, fine=True))[0].tolist())]
    assert len(spans) - len(set(spans)) < 0.01 * len(spans)
