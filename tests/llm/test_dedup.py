"""Jaccard join and span dedup against brute force."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from helpers import awkward, docs_table, near_copies, nothing, words
from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm import graph, jaccard_join, span_dedup


def shingles(text):
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(d), len(s), str(least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def as_rows(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def test_join_on_documents(spark):
    docs = docs_table(spark)
    assert as_rows(jaccard_join.join_digest(docs)) == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_join_on_awkward_rows(spark):
    docs = awkward(spark)
    assert as_rows(jaccard_join.join_digest(docs)) == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert jaccard_join.join_digest(nothing(spark)).collect() == []


@pytest.mark.parametrize("leaf, pivots", [(1 << 21, 4), (500, 3)])
def test_regions_cells_and_blocks_lose_no_link(spark, leaf, pivots):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert as_rows(jaccard_join.similarity_components(docs, leaf, pivots)) == brute_components(rows)


def test_linked_sets_share_a_region_key():
    rnd = np.random.default_rng(2)
    for n in (7, 8, 13, 20, 47, 100, 300, 900):
        for _ in range(30):
            a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
            cut = int(len(a) * rnd.uniform(0, 0.16))
            grow = int(len(a) * rnd.uniform(0, 0.16))
            b = np.unique(np.concatenate([a[cut:], rnd.integers(0, 2**63, grow).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 85 * (len(a) + len(b) - shared) and len(a) != shared:
                place, key = jaccard_join.region_keys([a, b])
                assert set(key[place == 0]) & set(key[place == 1])


def test_local_join_by_pivots():
    rows = [(i, t) for i, t in near_copies(seed=8, members=150)]
    sets = [np.array(sorted(hash(s) % 2**62 for s in shingles(t)), np.uint64) for _, t in rows]
    a, b = jaccard_join.join_sets(np.arange(len(rows)), sets)
    root = {i: i for i in range(len(rows))} | dict(zip(a.tolist(), b.tolist()))
    assert sorted((str(i), len(sets[i]), str(root[i])) for i in root) == brute_components(rows)


def test_a_leaf_of_many_short_sets_is_not_quadratic():
    rnd = np.random.default_rng(0)
    common = rnd.integers(0, 2**62, 5).astype(np.uint64)
    sets = [np.unique(np.concatenate([common, rnd.integers(0, 2**62, 4).astype(np.uint64)])) for _ in range(16_000)]
    began = time.process_time()
    assert len(jaccard_join.join_sets(np.arange(len(sets)), sets)[0]) == 0
    assert time.process_time() - began < 2
    base, copies = rnd.integers(0, 2**62, 60).astype(np.uint64), []
    for _ in range(3_000):
        x = base.copy()
        x[rnd.integers(0, 60, 2)] = rnd.integers(0, 2**62, 2)
        copies.append(np.unique(x))
    began = time.process_time()
    assert len(jaccard_join.join_sets(np.arange(len(copies)), copies)[0]) == len(copies) - 1
    assert time.process_time() - began < 4


def test_one_of_each(spark):
    docs = docs_table(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({c for _, _, c in brute_components(rows)})
    left = jaccard_join.one_of_each(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert sum(r.doc_id == 1 for r in left.collect()) == 2  # two texts, one of them twice


def test_components_of_a_graph(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200)]
    got = {r.id: r.root for r in graph.components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 103: 100}


def brute_spans(rows):
    place = lambda i: span_dedup.LAST if i is None else i
    units, seen = {}, {}
    for i, t in sorted({(place(i), t) for i, t in rows}, key=lambda x: (x[0], x[1] or "")):
        u = units[i, t] = span_dedup.units_of(t)
        w = [x.lower().split() for x in u]
        for a in range(len(u)):
            b = n = 0
            b = a
            while b < len(u) and (b - a < span_dedup.UNITS or n < span_dedup.WORDS):
                n += len(w[b])
                b += 1
            if b - a >= span_dedup.UNITS and n >= span_dedup.WORDS:
                seen.setdefault(tuple(" ".join(x) for x in w[a:b] if x), []).append((i, t, a, b))
    drop = {}
    for places in seen.values():
        for i, t, a, b in sorted(places, key=lambda x: (x[0], x[2]))[1:]:
            drop.setdefault((i, t), set()).update(range(a, b))
    out = []
    for i, t in rows:
        gone = drop.get((place(i), t), set())
        out.append((str(i), None if t is None else "".join(u for k, u in enumerate(units[place(i), t]) if k not in gone), len(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("gather", [500, 500_000])
def test_spans_on_documents(spark, gather, monkeypatch):
    docs = docs_table(spark).repartition(4)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_spans(rows)
    assert sum(n > 0 for _, _, n in want) > 5
    monkeypatch.setattr(span_dedup, "GATHER", gather)
    assert sorted(((str(r.doc_id), r.text, r.n_removed) for r in span_dedup.dedup_digest(docs).collect()), key=str) == want


def test_spans_of_shared_passages(spark):
    passage = "alpha beta gamma delta epsilon. Zeta eta theta iota kappa, lambda mu nu xi chi. Omicron pi rho sigma tau."
    rows = [(1, f"one. {passage} end."), (2, f"Other words {passage.upper()} more."), (3, passage), (3, passage), (None, f"x {passage}"), (4, None), (5, ""), (6, "..,,\n"), (7, f"{passage}\n{passage}")]
    out = span_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    text = {r.doc_id: r.text for r in out}
    assert text[1] == f"one. {passage} end."
    assert text[2] == "Other words ALPHA BETA GAMMA DELTA EPSILON. more."
    assert text[3] == "" and text[4] is None and text[5] == "" and text[6] == "..,,\n" and text[7] == "" and "Zeta" not in text[None]


def test_span_stage_keeps_columns_and_drops_emptied_documents(spark):
    docs = awkward(spark)
    out = span_dedup.dedup_documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    full = docs_table(spark)
    left = span_dedup.dedup_documents(full.unionByName(full.withColumn("doc_id", full.doc_id + 10**6)))
    assert left.where("n_chars <> length(text)").count() == 0
    assert span_dedup.dedup_digest(nothing(spark)).collect() == []


def brute_kept(rows, n, percent):
    """The least doc_id of each component of near copies; doc_ids are distinct."""
    low = [[x.lower() for x in words(t)] for _, t in rows]
    sets = [{tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set() for w in low]
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    least = {}
    for (doc_id, _), c in zip(rows, comp):
        least[c] = min(least.get(c, doc_id), doc_id)
    return sorted(least.values())


def test_pipeline_stage_takes_five_words_and_four_fifths(spark):
    one = [f"w{i}" for i in range(50)]
    rows = [*near_copies(), (1000, " ".join(one)), (1001, " ".join([*one[:25], "other", *one[26:]]))]  # 0.843 on 4 words, 0.804 on 5
    want = brute_kept(rows, 5, 80)
    assert 1001 not in want and want != brute_kept(rows, 4, 85)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == want


@pytest.mark.parametrize("leaf, pivots", [(1 << 21, 4), (500, 3)])
def test_no_link_is_lost_at_other_settings(spark, leaf, pivots):
    rows = near_copies(seed=5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = jaccard_join.similarity_components(docs, leaf, pivots, 5, 80)
    assert sorted({r.component_id for r in got.collect()}) == brute_kept(rows, 5, 80)


def test_linked_sets_share_a_region_key_at_four_fifths():
    rnd = np.random.default_rng(6)
    for n in (5, 9, 13, 20, 47, 100, 300, 900):
        for _ in range(60):
            a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
            cut, grow = (int(len(a) * rnd.uniform(0, 0.22)) for _ in range(2))
            b = np.unique(np.concatenate([a[cut:], rnd.integers(0, 2**63, grow).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 80 * (len(a) + len(b) - shared) and (cut or grow):
                place, key = jaccard_join.region_keys([a, b], percent=80)
                assert set(key[place == 0]) & set(key[place == 1])


def test_few_sets_need_keys_of_single_shingles():
    rnd = np.random.default_rng(7)
    sets = [np.unique(rnd.integers(0, 2**63, n).astype(np.uint64)) for n in rnd.integers(200, 400, 200)]
    least = [len(s) - -(-80 * len(s) // 100) + 1 for s in sets]
    place, key = jaccard_join.region_keys(sets, percent=80)
    single = {int(x) for s, k in zip(sets, least) for x in jaccard_join._mix(s[:k] + jaccard_join._C)}
    assert len({p for p, k in zip(place.tolist(), key.tolist()) if k in single}) < len(sets) // 5


@pytest.mark.parametrize("sentences", [1, 2, 3])
def test_pipeline_stage_finds_passages_inside_long_sentences(spark, sentences):
    rnd = np.random.default_rng(sentences)
    rows, passages = [], {}
    for k in range(30):
        p = [f"p{k}x{i}" if k % 3 else f"p{k}x{rnd.integers(3)}" for i in range(51)]
        for i in range(1, sentences):
            p[51 * i // sentences] += ".,"[k % 2]
        for place in (0, 1):
            host = [[f"h{k}x{place}x{side}x{i}" for i in range(rnd.integers(0, 30))] for side in (0, 1)]
            rows.append((k + 100 * place, " ".join([*host[0], *p, *host[1]]) + "."))
            passages[k + 100 * place] = p, [x for h in host for x in h]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    left = {r.doc_id: r.text for r in corpus_pipeline.span_stage(spark, docs, "").collect()}
    for doc_id, text in rows:
        passage, host = passages[doc_id]
        kept = [w.rstrip(".") for w in left[doc_id].split()]
        assert [w for w in kept if w.startswith("h")] == host  # nothing goes but the passage
        if doc_id < 100 and doc_id % 3:
            assert left[doc_id] == text
        elif doc_id >= 100:
            assert sum(w.startswith("p") for w in kept) <= 2 * (2 * span_dedup.REACH - 1)


def test_fine_units_are_the_text():
    for t in ["", " \n", "  one  two\tthree" * 20 + ". x", "a " * 40, "第一句。第二句！第三句", "una.. dos, " * 9, "x\x1cy z " * 12]:
        units = span_dedup.units_of(t, fine=True)
        assert "".join(units) == t and max((len(u.split()) for u in units), default=0) <= span_dedup.REACH
    assert len(span_dedup.units_of("第一句。第二句！第三句", fine=True)) == 3


@pytest.mark.parametrize("members", [2, 7])
def test_sets_of_over_half_a_leaf_come_to_an_end(spark, members, monkeypatch):
    rnd = np.random.default_rng(4)
    common = rnd.integers(1, 2**62, 600)
    # neighbours differ in 10 % (0.18 apart), but 0 and 1, which are linked
    sets = [np.unique(np.concatenate([common, rnd.integers(1, 2**62, 66)]).astype(np.uint64)) for _ in range(members)]
    if members > 2:
        sets[1] = np.unique(np.concatenate([sets[0][:-20], rnd.integers(1, 2**62, 20).astype(np.uint64)]))
    rows = [(9, i, len(s), s.tobytes(), sum(map(len, sets))) for i, s in enumerate(sets)]
    levels, cells = [], jaccard_join._cells

    def counted(*given):
        levels.append(1)
        assert len(levels) <= members, "a level without progress"
        return cells(*given)

    monkeypatch.setattr(jaccard_join, "_cells", counted)
    links = jaccard_join.region_links(spark.createDataFrame(rows, "region bigint, id bigint, n bigint, shingles binary, weight bigint"), 1000, 2)
    assert {tuple(sorted(x)) for x in links.collect()} == ({(0, 1)} if members > 2 else set())


def test_chance_ties_do_not_multiply_rows(spark, monkeypatch):
    """Ties by chance put all sets in one region; sets without a link do not come to many blocks."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    passages = [[word() for _ in range(14)] for _ in range(60)]
    texts = [[*rnd.choice(passages), *rnd.choice(passages), *[word() for _ in range(30)]] for _ in range(300)]
    texts += [[*t[:-1], word()] for t in texts[::20]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    held, keep, tie = [], jaccard_join.stored, jaccard_join._members_and_ties

    def stored(df, name):
        out = keep(df, name)
        held.append(out.count() if "shingles" in df.columns else 0)
        return out

    def all_tied(*given):
        found = keep(tie(*given), "ties")
        sets = found.where("set is not null").select(F.col("set").alias("a")).distinct()
        return found.unionByName(sets.crossJoin(sets.agg(F.min("a").alias("b"))), allowMissingColumns=True)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    monkeypatch.setattr(jaccard_join, "_members_and_ties", all_tied)
    found = {r.doc_id: r.component_id for r in jaccard_join.similarity_components(docs, leaf=1000, words=5, percent=80).collect()}
    assert found == {i: i if i < 300 else 20 * (i - 300) for i in range(315)}
    assert sum(held) < 3 * len(texts), held
