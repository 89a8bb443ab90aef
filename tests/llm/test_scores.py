"""Quality rules, sharding, language identification, classifier and top-k search."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from harness import compare, duck
from helpers import SF, awkward, docs_table, nothing, words
from pyspark.sql import functions as F

from barlake.llm import language_id, quality_classifier, quality_rules, sharding, topk_search
from barlake.llm.oracle import ORACLE
from barlake.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) == []


# ------------------------------------------------------------ quality rules
def counts(text):
    w = words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    again = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(i, i + 5)} if len(w) < 3000 else set()
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_rule_counts_on_awkward_rows(spark):
    rows = [("a b c d e a b c d e x\nq\nq\n q",), ("a a a a a a",), ("# * $%& <|>    x",), ("\r\nA\vB\fC\n\nA",), (None,), ("",), ("\n\n \n",)]
    docs = spark.createDataFrame(rows, "text string").withColumns({"doc_id": F.monotonically_increasing_id(), "lang": F.lit(None).cast("string"), "source": F.lit("s")})
    got = quality_rules.judge(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    many = awkward(spark)
    judged = quality_rules.judge_digest(many)
    assert judged.count() == many.count() and judged.where("kept is null or base_failed and kept").count() == 0
    assert quality_rules.judge_digest(nothing(spark)).collect() == []


def test_sketches_merge_and_bound_the_error(spark):
    rng = np.random.default_rng(4)
    values = [("g", int(v)) for v in rng.integers(0, 100_000, 4000)] + [("h", int(v)) for v in rng.integers(0, 60, 500)]
    df = spark.createDataFrame(values, "g string, v bigint")
    parts = [quality_rules.sketch(df.where(F.col("v") % 3 == k), ["g"], ["v"]) for k in range(3)]
    merged = quality_rules.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["g"])
    whole = quality_rules.sketch(df, ["g"], ["v"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    for r in quality_rules.quantiles(whole, ["g"], {"low": 25, "high": 75}).collect():
        own = sorted(v for g, v in values if g == r.g)
        for q, est in ((25, r.low), (75, r.high)):
            exact = own[math.ceil(q * len(own) / 100) - 1]
            assert est <= exact <= est * (1 + 1 / 32) + 1e-9


def test_fences_adapt_to_the_group(spark):
    rows = [(i, " ".join(["plain"] * 3 + [f"word{i}x{k}" for k in range(30)]) + "".join(f" {k}#" for k in range(12 if s == "code" else 0)), "en", s) for i in range(400) for s in ("code", "prose")]
    rows.append((1000, " ".join(f"w{k}" for k in range(40)) + "".join(f" {k}#" for k in range(20)), "en", "prose"))
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"))
    assert got.where("source = 'code' and not kept").count() == 0
    assert [r.doc_id for r in got.where("source = 'prose' and not kept").collect()] == [1000]


def _lines(i, dup):
    """Ten lines of a word each, ``dup`` of them a repeat; and words enough to pass the fixed rules."""
    lines = ["menu" if k % 2 == 0 and k // 2 <= dup or k >= 2 * (9 - dup) else f"l{i}x{k}" for k in range(10)]
    assert len(lines) - len(set(lines)) == dup
    return "\n".join(lines) + " " + " ".join(f"w{i}x{k}" for k in range(30))


def _phrases(i, again):
    """A hundred words, five of them said again ``again`` times."""
    phrase = [f"p{i}x{k}" for k in range(5)]
    return " ".join(w for k in range(again + 1) for w in [*phrase, *(f"w{i}x{k}x{m}" for m in range(3))]) + " " + " ".join(f"v{i}x{k}" for k in range(100 - 8 * (again + 1)))


def _symbols(i, n):
    return " ".join(f"w{i}x{k}" for k in range(40)) + "".join(f" {k}#" for k in range(n))


@pytest.mark.parametrize("ratio, make, usual, odd", [("symbol_ratio", _symbols, 8, 9), ("dup_line_ratio", _lines, 4, 5), ("repeat_ratio", _phrases, 2, 2)])
def test_each_fence_rejects_in_one_group_what_another_keeps(spark, ratio, make, usual, odd):
    """An outlier that passes the fixed rules goes where it is unusual and stays where it is not; its fence alone decides."""
    rows = [(i, make(i, usual), "en", "often") for i in range(200)] + [(1000 + i, make(i, 0), "en", "never") for i in range(200)]
    rows += [(5000, make(9, odd), "en", "often"), (6000, make(9, odd), "en", "never")]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in got)
    assert [r.doc_id for r in got if not r.kept] == [6000]
    out = next(r for r in got if r.doc_id == 6000)
    assert out[ratio] > out[f"{ratio}_fence"]
    assert all(out[c] <= out[f"{c}_fence"] for c in quality_rules.RATIOS if c != ratio)
    assert len({r[f"{ratio}_fence"] for r in got}) == 2


def test_junk_in_a_tenth_of_a_group_does_not_move_its_fence(spark):
    rows = [(i, _symbols(i, 30 if i % 12 == 0 else 0), "en", "s") for i in range(600)]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if not r.kept} == {i for i in range(0, 600, 12)}


def test_rule_stage_keeps_columns(spark):
    docs = awkward(spark)
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want


# ----------------------------------------------------------------- sharding
def test_lookup_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(10)]
    table = sharding.lookup_table(names, 1009)
    share = np.bincount(table, minlength=10)
    assert share.max() - share.min() <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.25 * 1009
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 1009)


def test_assign(spark, tmp_path):
    docs = awkward(spark)
    out = sharding.assign(docs, "doc_id", ["a", "b", "c"], 101)
    assert out.columns == [*docs.columns, "slot", "shard"] and out.count() == docs.count()
    assert out.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    assert sharding.shard_documents(nothing(spark)).collect() == []
    again = sharding.assign(out, "doc_id", ["a"], 101)  # columns of these names are kept, the new ones get others
    assert again.columns == [*out.columns, "slot_", "shard_"] and {r.shard_ for r in again.collect()} == {0}
    sharding.write_shards(docs, "doc_id", ["a", "b", "c"], 101, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


# --------------------------------------------------------------- language id
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(own)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == own[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_ignores_lang_source_and_id_of_the_predicted_row(spark):
    docs = docs_table(spark)
    model = language_id.train(docs.select("lang", "text"))
    a = language_id.score(docs.select("doc_id", "text"), model, ["doc_id"])
    b = language_id.score(docs.select((F.col("doc_id") + 7).alias("doc_id"), "text"), model, ["doc_id"])
    assert sorted((r.doc_id + 7, r.lang_pred, r.score) for r in a.collect()) == sorted(map(lambda r: (r.doc_id, r.lang_pred, r.score), b.collect()))


def test_kneser_ney_probabilities_sum_to_one(spark):
    models = language_id.train(docs_table(spark).select("lang", "text"))
    model = models.block(models.blocks[0])
    for context in model.contexts[-1][:5].tolist() + [0, (5 << 12) | (63 << 6) | 62]:
        codes = (context << language_id.BITS) + np.arange(language_id.CLASSES)
        assert np.allclose(np.exp(model.of(codes)).sum(0), 1)


def plain_kneser_ney(texts, order=4):
    """P(symbol | context) of one language by the textbook: counts, continuation counts, discounts, interpolation."""
    counts = {order: {}}
    for t in texts:
        code, _ = language_id.grams([t])
        for c in code.tolist():
            gram = tuple((c >> 6 * k) & 63 for k in range(order - 1, -1, -1))
            counts[order][gram] = counts[order].get(gram, 0) + 1
    for k in range(order - 1, 0, -1):
        counts[k] = {}
        for gram in counts[k + 1]:
            counts[k][gram[1:]] = counts[k].get(gram[1:], 0) + 1

    def p(symbol, context):
        if not context and symbol is None:
            return 1 / 64
        k = len(context) + 1
        ones, twos = (sum(n == m for n in counts[k].values()) for m in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.75
        lower = p(symbol, context[1:]) if context else 1 / 64
        after = {g: n for g, n in counts[k].items() if g[:-1] == context}
        total = sum(after.values())
        if not total:
            return lower
        return max(after.get((*context, symbol), 0) - d, 0) / total + d * len(after) / total * lower

    return p


def test_kneser_ney_against_the_textbook(spark):
    texts = {"aa": ["banana bandana", "cabana nab", "b\u00e9 a"], "bb": ["xyzzy xyz zyx", "zzz yy x", "Xy Zx"]}
    rows = [(lang, t) for lang, ts in texts.items() for t in ts]
    models = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    model = models.block(models.blocks[0])
    rnd = np.random.default_rng(3)
    seen = np.unique(np.concatenate([language_id.grams(ts)[0] for ts in texts.values()]))
    codes = np.concatenate([seen, rnd.integers(0, 1 << 24, 40), (seen & ~np.uint32(63)) | 5]).astype(np.int64)
    got = np.exp(model.of(codes))
    for j, lang in enumerate(model.langs):
        p = plain_kneser_ney(texts[lang])
        want = [p(int(c) & 63, tuple(int(c) >> 6 * k & 63 for k in (3, 2, 1))) for c in codes]
        assert np.allclose(got[:, j], want, rtol=1e-9)


def test_score_entropy_and_rejection_by_hand(spark):
    """Lowest cross-entropy wins, the score is its posterior, and the limit follows the language's own training texts."""
    docs = docs_table(spark)
    rows = language_id.identify(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    models = language_id.train(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2").select("lang", "text"))
    model = models.block(models.blocks[0])
    for r in rows[:30]:
        code, bounds = language_id.grams([text[r.doc_id] or ""])
        if bounds[1]:
            ll = model.of(code.astype(np.int64)).sum(0)
            assert r.lang_pred == model.langs[int(ll.argmax())]
            assert r.score == pytest.approx(1 / np.exp(ll - ll.max()).sum(), abs=1e-3)
            assert r.cross_entropy == pytest.approx(-ll.max() / bounds[1], rel=1e-5)
    for own in set(lang.values()):
        right = sorted(r.cross_entropy for r in rows if not r.held_out and r.lang_pred == own == lang[r.doc_id])
        limit = right[math.ceil(0.995 * len(right)) - 1]
        assert all(r.rejected == (r.cross_entropy > limit) for r in rows if r.lang_pred == own)


def test_any_number_of_languages(spark):
    """80 languages in blocks give the results of one block."""
    rnd = np.random.default_rng(8)
    rows = []
    for k in range(80):
        words = ["".join(chr(97 + c) for c in (rnd.integers(0, 9, 5) * (k % 7 + 1) + k) % 26) for _ in range(12)]
        rows += [(100 * k + i, " ".join(rnd.choice(words, 9)), f"l{k:02}") for i in range(12)]
    rows += [(9000, None, "l00"), (9001, "123", "l01"), (9002, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    many = language_id.train(docs, block_languages=9)
    small = language_id.train(docs, block_codes=300)
    one = language_id.train(docs, block_languages=100)
    assert len(many.blocks) == 9 and len(small.blocks) > 9 and len(one.blocks) == 1
    assert [lang for b in many.blocks for lang in b] == one.blocks[0] == sorted(one.blocks[0])
    found = [{r.doc_id: (r.lang_pred, round(r.score, 9), r.cross_entropy) for r in language_id.score(docs, m, ["doc_id"]).collect()} for m in (one, many, small)]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    assert np.mean([found[0][i][0] == lang for i, _, lang in rows[:-3]]) > 0.95
    assert all(found[0][i][:2] == ("und", 0) for i in (9000, 9001, 9002))
    assert language_id.identify(docs).count() == len(rows)


def test_language_on_awkward_rows(spark):
    docs = awkward(spark)
    rows = language_id.identify(docs).collect()
    text = {}
    for r in docs.collect():
        text.setdefault(r.doc_id, []).append(r.text)
    assert len(rows) == docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in rows if not any(t and any(c.isalpha() for c in t) for t in text[r.doc_id]))
    assert language_id.identify(nothing(spark)).collect() == []
    unlabelled = docs_table(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


# ---------------------------------------------------------------- classifier
def brute_marginals(weights, steps, x):
    """All label rows of a short text, one by one."""
    n, total, good = len(x), 0.0, np.zeros(len(x))
    for code in range(2**n):
        y = [(code >> i) & 1 for i in range(n)]
        s = math.exp(sum(weights @ x[i] for i in range(n) if y[i]) + sum(steps[y[i - 1], y[i]] for i in range(1, n)))
        total += s
        good += s * np.array(y)
    return good / total


def test_forward_backward():
    rng = np.random.default_rng(3)
    chain = quality_classifier.Chain(4)
    chain.weights, chain.steps = rng.normal(size=4), rng.normal(size=(2, 2))
    x, bounds = rng.normal(size=(11, 4)), np.array([0, 5, 5, 6, 11])
    good, expected = chain.marginals(x, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        assert np.allclose(good[a:b], brute_marginals(chain.weights, chain.steps, x[a:b]))
    assert np.isclose(expected.sum(), 8)


def brute_likelihood(weights, steps, x, bounds, label):
    """Mean over lines of log P(all lines of a text have its label), less the ridge, by listing all label rows."""
    total = 0.0
    for a, b, y in zip(bounds[:-1], bounds[1:], label):
        scores = []
        for code in range(2 ** (b - a)):
            row = [(code >> i) & 1 for i in range(b - a)]
            scores.append(sum(weights @ x[a + i] for i in range(b - a) if row[i]) + sum(steps[row[i - 1], row[i]] for i in range(1, b - a)))
        top = max(scores)
        total += (scores[-1] if y else scores[0]) - top - math.log(sum(math.exp(s - top) for s in scores))
    return total / len(x) - quality_classifier.RIDGE / 2 * (weights @ weights + (steps * steps).sum())


def test_fit_climbs_the_likelihood_to_a_flat_place(monkeypatch):
    monkeypatch.setattr(quality_classifier, "STEPS", 1500)
    rng = np.random.default_rng(5)
    bounds, label = np.array([0, 3, 7, 8, 12, 15]), np.array([1, 0, 1, 0, 1])
    x = rng.normal(size=(15, 3)) + np.repeat(label, np.diff(bounds))[:, None] * 0.7
    chain = quality_classifier.Chain(3)
    at = lambda w, t: brute_likelihood(w, t, x, bounds, label)
    before = at(chain.weights, chain.steps)
    chain.fit(x, bounds, label)
    assert at(chain.weights, chain.steps) > before + 0.05
    for i in range(7):  # every direction, by finite differences of the brute-force likelihood
        d = np.zeros(7)
        d[i] = 1e-4
        slope = (at(chain.weights + d[:3], chain.steps + d[3:].reshape(2, 2)) - at(chain.weights - d[:3], chain.steps - d[3:].reshape(2, 2))) / 2e-4
        assert abs(slope) < 5e-3


def test_score_is_the_curve_of_length_weighted_marginals():
    texts = ["A good sentence stands here.\nAnother one follows it.", "### $$$ %%%\n@@@", "Plain words of a line.", "x9 ## x9\n\n<<>> ||", "", None, "One more good line, of some length.\n#"]
    label = np.array([1, 0, 1, 0, 1, 0, 1])
    x, size, bounds = quality_classifier.line_features(texts)
    model = quality_classifier.QualityModel(x, size, bounds, label)
    got = model.score(texts)
    wide = (quality_classifier.with_neighbours(x, bounds) - model.mean) / model.scale
    raw = []
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a == b:
            assert got[i] == 0
            continue
        good = brute_marginals(np.clip(model.chain.weights, -30, 30), model.chain.steps, wide[a:b])
        raw.append((sum(g * n for g, n in zip(good, size[a:b])) / size[a:b].sum(), label[i]))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(model.curve[0] + model.curve[1] * raw[-1][0]))), abs=1e-6)
    # the curve is the ridge logistic regression of the labels on these values: its gradient is zero
    z, y = np.array([[1, v] for v, _ in raw]), np.array([k for _, k in raw])
    p = 1 / (1 + np.exp(-z @ model.curve))
    assert np.allclose(z.T @ (y - p) - 1e-2 * model.curve, 0, atol=1e-5)


def test_classifier_on_held_out_documents(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    rows = quality_classifier.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    label = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(label[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_classifier_on_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 0), (7, None, 0), (5, 0, 1)], "doc_id bigint, quality int, toxic int")
    rows = quality_classifier.score_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = quality_classifier.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0, 0.5}
    assert quality_classifier.score_documents(nothing(spark), labels).collect() == []
    kept = quality_classifier.filter_documents(docs, quality_classifier.train(docs, labels))
    assert kept.columns == docs.columns


# -------------------------------------------------------------------- top-k
def brute_topk(rows, k=10):
    v = [(i, [math.floor(1024 * float(x)) for x in e]) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    dim = max((len(e) for _, e in v), default=0)
    v = [(i, e + [0] * (dim - len(e))) for i, e in v]
    out = set()
    for q in {i for i, _ in v if i % 100 == 0}:
        e = min(e for i, e in v if i == q)
        best = sorted((-sum(a * b for a, b in zip(e, f)), i) for i, f in v if i != q)[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def as_set(df):
    rows = [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_topk_on_embeddings(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert as_set(topk_search.search_embeddings(e)) == brute_topk([(r.vec_id, r.embedding) for r in e.collect()])


@pytest.mark.parametrize("rings, block", [(8, 2048), (40, 16)])
def test_topk_with_ties_copies_and_awkward_vectors(spark, monkeypatch, rings, block):
    monkeypatch.setattr(topk_search, "RING_ROWS", rings)
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", block)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=5) * rng.choice([0.1, 1, 30])]) for i in range(500)]
    rows += [(1000 + i, [0.5, 0.25, 0.0, -1.0, 2.0]) for i in range(300)] + [(3, [9.0, 1.0, 1.0, 1.0, 1.0]), (100, [0.0] * 5), (100, [0.0] * 5)]
    rows += [(5000, None), (5100, []), (5200, [1.0, None]), (5300, [float("nan"), 1.0]), (5400, [float("inf"), 1.0]), (None, [1.0] * 5), (5500, [1.0, 2.0])]
    e = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    assert as_set(topk_search.search_embeddings(e, n_pivots=7)) == brute_topk(rows)


def test_topk_keeps_wide_components(spark):
    """Components of 2^21 and more take part; a score that may leave 63 bits raises."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=3) * rng.choice([1, 2.0**17])]) for i in range(250)]
    rows += [(300, [2.0**21 + 5, 1.0, -3.0]), (301, [5.0, 2.0**22, 1.0])]
    e = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    assert as_set(topk_search.search_embeddings(e, n_pivots=5)) == brute_topk(rows)
    wide = spark.createDataFrame([(0, [2.0**40, 1.0]), (1, [2.0**40, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception):
        topk_search.search_embeddings(wide).collect()
    with pytest.raises(Exception):
        topk_search.search_embeddings(spark.createDataFrame([(0, [1e300, 1.0])], "vec_id bigint, embedding array<double>")).collect()


def test_topk_skips_what_the_bounds_rule_out(spark, monkeypatch):
    """Separate clusters: most rows are never compared, and the result is exact."""
    monkeypatch.setattr(topk_search, "RING_ROWS", 20)
    rng = np.random.default_rng(9)
    middle = rng.normal(size=(12, 6))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    rows = [(i, [float(x) for x in 5 * middle[i % 12] + rng.normal(size=6) * 0.02]) for i in range(3000)]
    e = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    vectors = e.select("vec_id", topk_search.quantised(F.col("embedding")).alias("v"))
    index = topk_search.PivotIndex(vectors, 24)
    found = index.search(vectors.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id"), 10)
    assert as_set(found) == brute_topk(rows)
    assert 0 < index.share_searched < 0.5


def test_topk_does_not_write_a_query_for_each_ring(spark, monkeypatch):
    """No table has more rows than the vectors or the results; the queries come in several parts."""
    monkeypatch.setattr(topk_search, "RING_ROWS", 4)
    monkeypatch.setattr(topk_search, "QUERY_BYTES", 1, raising=False)
    rnd = np.random.default_rng(7)
    rows = [(i, x.tolist()) for i, x in enumerate(rnd.integers(-50, 50, (700, 12)) / 16)]
    written, keep = [], topk_search.stored

    def stored(df, name):
        out = keep(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(topk_search, "stored", stored)
    e = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = as_set(topk_search.search_embeddings(e, k=2, every=1, n_pivots=20))
    assert max(n for _, n in written) <= 2 * len(rows), written
    ints = np.floor(np.array([x for _, x in rows]) * 1024).astype(np.int64)
    scores = ints @ ints.T
    want = {(i, j, scores[i, j]) for i in range(700) for j in [j for j in np.lexsort((np.arange(700), -scores[i])) if j != i][:2]}
    assert {(q, v, s) for q, _, v, s in got} == want


def test_topk_with_few_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert topk_search.search_embeddings(spark.createDataFrame([], schema)).collect() == []
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert as_set(topk_search.search_embeddings(spark.createDataFrame(rows, schema))) == brute_topk(rows)
