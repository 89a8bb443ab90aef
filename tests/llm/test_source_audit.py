"""Source divergence audit against counting every term in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from helpers import SCHEMA, awkward, nothing
from harness import compare, duck

from barlake.llm import source_audit
from barlake.llm.oracle import ORACLE
from barlake.llm.queries import op12_source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, top=200):
    rows = [(lang or "", source or "", Counter("".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or ""))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for g, _, c in rows if g == lang for t in c)
        kept = sorted((t for t, n in docs.items() if n >= 3), key=lambda t: t.encode())
        groups = {s: Counter() for g, s, _ in rows if g == lang}
        every = Counter()
        for g, s, c in rows:
            if g == lang:
                groups[s].update({t: c[t] for t in kept if t in c})
                every.update({t: c[t] for t in kept if t in c})
        share = lambda c, t: 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept))  # noqa: B023, E731
        price = lambda p, q: (p - q) ** 2 // q
        for s, c in groups.items():
            pairs = [(o, sum(price(share(c, t), share(groups[o], t)) for t in kept)) for o in groups if o != s]
            terms = [(t, price(share(c, t), share(every, t))) for t in kept if c[t] > 0 and share(c, t) > share(every, t)]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked[:most])]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def corpus(seed, n=150):
    rnd = random.Random(seed)
    words = ["The", "cat", "éa", "Zürich", "日本", "a1b", "x", "dog's"] + ["w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(120)]
    rows = []
    for _ in range(n):
        lang, source = rnd.choice(["en", "en", "de", None]), rnd.choice(["a", "a", "b", "é", None, "c"])
        bag = words if source == "a" else words[:40]
        rows.append((" ".join(rnd.choice(bag) for _ in range(rnd.choice([0, 1, 5, 60]))), lang, source))
    return [*rows, ("one lonely text", "xx", "s"), (None, "xx", "t"), ("", "xx", None)]


@pytest.mark.parametrize("terms, sources, tile, held", [(4096, 64, 1024, 300_000), (9, 2, 5, 20), (30, 64, 3, 1)])
def test_against_counting(spark, monkeypatch, terms, sources, tile, held):
    for name, value in (("CELL_TERMS", terms), ("CELL_SOURCES", sources), ("TILE", tile), ("HELD", held)):
        monkeypatch.setattr(source_audit, name, value)
    rows = corpus(terms)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(5)
    assert found(source_audit.audit(df)) == brute(rows)


def test_joint_tables(spark):
    rows = corpus(5, 60)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    audit = source_audit.Audit(df)
    of = {(r.lang, r.source, r.term): r.n for r in audit.counts.collect()}
    want = Counter()
    for (lang, source, term), n in of.items():
        for (g, other, t), m in of.items():
            if lang == g and term == t and source < other:
                want[lang, source, n, other, m] += 1
    assert {(r.lang, r.source, r.n, r.other, r.other_n): r.terms for r in audit.joint_tables().collect()} == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert found(source_audit.audit(docs)) == brute([(r.text, r.lang, r.source) for r in docs.collect()])
    assert source_audit.audit(nothing(spark)).collect() == []


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(op12_source_audit(spark, sf), duck(sf), ORACLE["op12_source_audit"]) == []
