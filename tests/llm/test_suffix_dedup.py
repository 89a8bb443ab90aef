"""Suffix-array dedup against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from helpers import awkward, docs_table, nothing

from barlake.llm import suffix_dedup
from barlake.llm.queries import op13_suffix_dedup


def order_of(doc_id, text):
    return (doc_id is None, doc_id or 0)


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row; ids are unique or their rows are equal."""
    first = {}
    docs = {(order_of(*r), r[1]): (r[1] or "").encode() for r in rows}
    for key in sorted(docs, key=lambda k: k[0]):
        b = docs[key]
        for i in range(len(b) - length + 1):
            first.setdefault(b[i:i + length], (key, i))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] != ((order_of(doc_id, text), text), i):
                gone[i:i + length] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:-1]).sum()) if len(b) else 0
        out.append((doc_id, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


@pytest.mark.parametrize("alphabet", ["ab", "the quick brown fox é日", "a"])
@pytest.mark.parametrize("depth", [8, 100])
def test_two_stage_sort(alphabet, depth):
    rnd = random.Random(len(alphabet) + depth)
    for n in (0, 1, 7, 60, 900):
        base = "".join(rnd.choice(alphabet) for _ in range(n // 3))
        text = (base + "".join(rnd.choice(alphabet) for _ in range(n // 4)) + "a" * (n // 5) + base + "b").encode()
        wanted = np.array([rnd.random() < 0.6 for _ in text])
        order = suffix_dedup.two_stage_sort(np.frombuffer(text, np.uint8), wanted, depth)
        assert sorted(order) == list(np.flatnonzero(wanted))
        assert [text[i:i + depth] for i in order] == sorted(text[i:i + depth] for i in np.flatnonzero(wanted))
        common = suffix_dedup.common_prefixes(np.frombuffer(text, np.uint8), order, depth)
        for a, b, c in zip(order[:-1], order[1:], common[1:]):
            x, y = text[a:a + depth], text[b:b + depth]
            assert c == next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))


def corpus(seed, n=60):
    rnd = random.Random(seed)
    word = ["".join(rnd.choice("abcdé日") for _ in range(rnd.randrange(1, 7))) for _ in range(300)]
    prose = lambda k: " ".join(rnd.choice(word) for _ in range(k))
    passages = [prose(k) for k in (10, 25, 40, 120)]
    rows = []
    for i in range(n):
        parts = [prose(rnd.randrange(30)) for _ in range(3)]
        for _ in range(rnd.choice([0, 1, 1, 2])):
            parts.insert(rnd.randrange(4), rnd.choice(passages))
        text = rnd.choice(["", " "]).join(parts)
        if rows and rnd.random() < 0.15:
            text = rnd.choice(rows)[1]
        rows.append((rnd.choice([1, -1]) * i, text))
    rows += [(1000, "x" * 700), (1001, "xy" * 300), (1002, "y" + "x" * 300), (1003, "")]
    return rows


@pytest.mark.parametrize("seed, block, hot, length", [(1, 1 << 21, 4096, 100), (2, 700, 4096, 100), (3, 500, 1, 100), (4, 300, 2, 40)])
def test_blocks_buckets_and_hot_anchors(spark, seed, block, hot, length):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(suffix_dedup.dedup(docs, length, 32 if length == 100 else 11, block, hot)) == brute(rows, length)


def test_long_text_over_many_chunks(spark, monkeypatch):
    rows = [(1, "".join(chr(97 + (i * i // 7) % 26) for i in range(5000))), (2, "z" * 300)]
    rows.append((3, rows[0][1][1000:3000] + rows[0][1][900:1500]))
    text = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    ends = np.cumsum([len(t) for _, t in rows])
    whole = suffix_dedup.runs_of(text, ends)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    cut = suffix_dedup.runs_of(text, ends)
    spread = lambda r: [(int(a), s + k) for a, s, m, _ in zip(*r) for k in range(m)]
    assert spread(whole) == spread(cut)
    assert suffix_dedup.two_stage_sort(text, np.ones(len(text), bool)).tolist()[:1] == [int(min(range(len(text)), key=lambda i: text.tobytes()[i:i + 100]))]


def test_documents(spark):
    docs = docs_table(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(d, n, g, s, hashlib.sha256(k).hexdigest()) for d, n, g, s, k in brute(rows, 100)]
    got = op13_suffix_dedup(spark, docs._jdf and "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 1000


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = found(suffix_dedup.dedup(docs))
    assert len(got) == docs.count()
    by = {g[0]: g for g in got if g[0] not in (1, None)}
    assert by[2][1:] == (0, 0, 0, b"") and by[3][1:] == (0, 0, 0, b"") and by[4][1:] == (4, 0, 0, b" \n\t ")
    assert by[8][2] == 49_999 and by[8][3] == 1  # a run of one byte: only its first window's first place stays
    assert suffix_dedup.dedup(nothing(spark)).collect() == []
