"""Whitening by bidiagonalisation against numpy's eigenvectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import SF, nothing  # noqa: F401

from barlake.llm import whitening
from barlake.llm.queries import op11_whiten

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, k=32):
    """What whiten() should return for (vec_id, vector): numpy's eigendecomposition of the whole covariance."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    d = max(len(v) for _, v in kept)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (d - len(v)) for _, v in kept], np.int64)
    n, s = len(x), x.sum(0)
    centred = (n * x - s) / n
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1], w[:, ::-1]
    k = min(k, int((e > 1e-12 * e.sum()).sum()))
    return [i for i, _ in kept], n, ((n * x - s) ** 2).sum(1), centred @ w[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(df, rows, k=32):
    ids, n, deviation, white, explained = plain(rows, k)
    got = df.collect()
    assert len(got) == len(ids) * len(explained)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert all(r.n == n and r.identity_error < 1e-9 for r in got)
    assert np.allclose([next(r.explained for r in got if r.component == c + 1) for c in range(len(explained))], explained, rtol=1e-9)
    unique = len(set(ids)) == len(ids)
    for at, i in enumerate(ids):
        if unique:
            mine = sorted(by[i], key=lambda r: r.component)
            assert [r.component for r in mine] == list(range(1, len(explained) + 1))
            assert {r.deviation for r in mine} == {int(deviation[at])}
            assert np.allclose(np.abs([r.whitened for r in mine]), np.abs(white[at]), atol=1e-7)


def test_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = op11_whiten(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got, [(r.vec_id, r.embedding) for r in df.collect()])


def test_awkward_rows(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rnd.normal(0, 3, 5)]) for i in range(40)]
    rows += [(50, None), (51, []), (52, [1.0, None, 2.0, 0.0, 1.0]), (53, [float("nan")] * 5), (54, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (55, [1.5, -2.5])]
    df = spark.createDataFrame([(*r, "x", 1.0, 3) for r in rows], SCHEMA + ", x string, whitened double, n int").repartition(3)
    check(whitening.whiten(df), rows)
    twice = [(7, rows[0][1]), (7, rows[1][1]), (None, rows[2][1]), (None, rows[2][1])]
    got = whitening.whiten(spark.createDataFrame(twice, SCHEMA)).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["7", "7", "None", "None"] * 2)  # three different rows span two directions
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect() == []  # no variance


def test_many_blocks_and_second_stage(spark, monkeypatch):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rnd.normal(0, [9, 9, 1, 0.5], 4)]) for i in range(60)]
    monkeypatch.setattr(whitening, "PARTIAL_SUMS", 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        rows_of = whitening.CentredRows(spark.createDataFrame(rows, SCHEMA).repartition(9))
        assert rows_of.parts > 2
        check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(9), 3), rows, 3)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_too_large_entries_raise(spark):
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0])], SCHEMA))


@pytest.mark.parametrize("kind", ["flat", "steep", "low rank", "few rows", "equal"])
def test_bidiagonalisation(kind):
    rnd = np.random.default_rng(4)
    x = {"flat": rnd.normal(size=(300, 24)), "steep": rnd.normal(size=(300, 24)) * np.logspace(0, -5, 24), "low rank": np.repeat(rnd.normal(size=(300, 3)), 8, 1),
         "few rows": rnd.normal(size=(9, 24)), "equal": np.linalg.qr(rnd.normal(size=(300, 24)))[0]}[kind]
    right, small = whitening.bidiagonalise(lambda y: ((x @ y) @ x, float((x @ y) @ (x @ y))), 24, float((x * x).sum()))
    assert np.allclose(right.T @ right, np.eye(24), atol=1e-13)
    assert np.array_equal(small, np.triu(np.tril(small, 1)))
    assert np.allclose(np.linalg.svd(small)[1], np.linalg.svd(x @ right)[1][:24].tolist() + [0] * max(0, 24 - len(x)), atol=1e-9 * np.abs(x).max())
