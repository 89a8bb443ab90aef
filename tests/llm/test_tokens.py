"""Token store, packing and BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, docs_table, nothing
from tokenizers import Tokenizer

from barlake.llm import bpe, encoding, packing, perfect_hash, token_store
from barlake.llm.common import slices, texts_of, tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def hard_texts():
    rnd = random.Random(5)
    fixed = ["<|endoftext|>a<|startoftext|> b'sfoo's CAN'T ȩ́ İstanbul ǅ Σς ΑΣ", "日本語 テキスト 한국어 ٣٤ ½ ²", "\x00\x1c\x1d a\x1fb c d　e﻿",
             "aaaa. aaaaaaa! é, Éa. É. ÿ) ſ. x' x'. 's. a's.  a.'", "</w> <|x|> <| </w>x x</w>", "\U0001F600\U0001F468‍\U0001F469 ퟿", "", " ", "\n\t ",
             "hahahahaha lololol !!!!!!!! ======== ----", "x" * 3000, "<|ENDOFTEXT|> <|EndOfText|>."]
    return fixed + ["".join(rnd.choice("abcdehinorst'.-é<|w/>0 1A,!)\n") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, np.uint32).tobytes())


def test_chunk_encoder_equals_the_library(library, hard_texts):
    ids, bounds = encoding.encoder(PATH).encode(pa.array(hard_texts, pa.large_string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [ids_of(library, t) for t in hard_texts]


def test_speculative_coder_equals_the_library(library, hard_texts):
    ids, bounds, decoded = bpe.coder(PATH).encode(pa.array(hard_texts, pa.large_string()))
    for t, a, b, d in zip(hard_texts, bounds[:-1], bounds[1:], decoded.to_pylist()):
        want = ids_of(library, t)
        assert ids[a:b].tolist() == want
        assert d == library.decode(want, skip_special_tokens=False)


def test_speculation_fails_and_merging_mends(library):
    coder = bpe.coder(PATH)
    words = [w + bpe.END for w in ("thereinon", "thandinger", "hahahahaha", "aaaaaaa")]
    greedy = [coder._propose(w) for w in words]
    assert coder.encode_words(words) == coder.merge(words) == [ids_of(library, w[:-1]) for w in words]
    assert greedy != coder.merge(words)


def test_slices_keep_every_row_and_byte():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * (1 << 20), None, "", "é" * (3 << 20), "z"])], ["text"])
    cuts = list(slices(batch))
    assert [t for c in cuts for t in texts_of(c).to_pylist()] == [t or "" for t in batch.column("text").to_pylist()]
    assert len(cuts) > 1


@pytest.mark.parametrize("make", [docs_table, awkward])
def test_encode_digest(spark, library, make):
    docs = make(spark)
    want = sorted((str(r.doc_id), len(i := ids_of(library, r.text)), hashlib.sha256(np.array(i, np.uint32).tobytes()).hexdigest(),
                   hashlib.sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest()) for r in docs.collect())
    assert sorted((str(r.doc_id), *r[1:]) for r in bpe.encode_digest(docs).collect()) == want


@pytest.mark.parametrize("make", [docs_table, awkward])
def test_packing(spark, library, make):
    docs = make(spark)
    rows = packing.pack_digest(docs).collect()
    full = sorted((str(r.doc_id), len(ids_of(library, r.text)) + 1) for r in docs.collect())
    assert sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0) == full
    by_sequence = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
    assert sum(by_sequence.values()) == sum(n for _, n in full)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert all(n == packing.SEQUENCE_LENGTH for s, n in by_sequence.items() if s < len(by_sequence) - 1)


def test_packed_ids_are_the_documents(spark, library):
    docs = docs_table(spark)
    text = {r.doc_id: r.text for r in docs.collect()}
    pieces = packing.pack(docs, length=256)
    for r in pieces.collect():
        assert np.frombuffer(r.ids, np.uint32).tolist() == [*ids_of(library, text[r.doc_id]), 1][r.start:r.start + r.length]
    packed = packing.sequences(pieces).orderBy("sequence_id").collect()
    assert all(len(r.ids) == 256 * 4 for r in packed[:-1])
    assert sum(d.length for r in packed for d in r.documents) == sum(len(ids_of(library, t)) + 1 for t in text.values())


def test_perfect_hash_is_minimal_and_perfect():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 7000):
        h1, h2 = rnd.integers(0, 2**63, n).astype(np.uint64), rnd.integers(0, 2**63, n).astype(np.uint64)
        sizes, bits = perfect_hash.build(h1, h2)
        assert sorted(perfect_hash.slots(h1, h2, sizes, bits)) == list(range(n))
        packed = perfect_hash.pack(bits)
        assert np.array_equal(perfect_hash.packed_slots(h1, h2, sizes, *packed), perfect_hash.slots(h1, h2, sizes, bits))
        other = rnd.integers(0, 2**63, 500).astype(np.uint64)
        assert np.array_equal(perfect_hash.packed_slots(other, other, sizes, *packed), perfect_hash.slots(other, other, sizes, bits))


def test_lookup_reads_the_buckets_asked_for(spark, monkeypatch):
    """A key costs its own bucket; many keys, a semi-join.  Both find what a scan of all finds."""
    monkeypatch.setattr(token_store, "BUCKET_KEYS", 5)
    docs = docs_table(spark)
    store = token_store.TokenStore.write(docs)
    assert store._table("index").count() > 20
    whole = {r.doc_id: (r.start, r.n_tokens) for r in store.lookup(docs.select("doc_id")).collect()}
    one = spark.createDataFrame([(7,), (10**9,)], "doc_id bigint")
    plan = store.locate(one)._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan and ("IN (" in plan or "EqualTo(bucket" in plan or "In(bucket" in plan)
    assert [(r.doc_id, (r.start, r.n_tokens)) for r in store.lookup(one).collect()] == [(7, whole[7])]
    monkeypatch.setattr(token_store, "FEW_BUCKETS", 3)
    some = docs.where("doc_id % 3 = 0").select("doc_id")
    assert {r.doc_id: (r.start, r.n_tokens) for r in store.lookup(some).collect()} == {k: v for k, v in whole.items() if k % 3 == 0}


@pytest.mark.parametrize("make", [docs_table, awkward])
def test_token_store(spark, library, make, monkeypatch):
    docs = make(spark)
    rows = [(r.doc_id is not None, r.doc_id or 0, len(i := [*ids_of(library, r.text), 1]), crc(i)) for r in docs.collect()]
    got = sorted(token_store.store_digest(docs).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(rows)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_token_store_files_and_absent_keys(spark, library):
    docs = docs_table(spark)
    store = token_store.TokenStore.write(docs)
    manifest = store._table("manifest").collect()
    ids = b"".join(open(f"{store.folder}/ids/{m.name}.bin", "rb").read() for m in sorted(manifest, key=lambda m: m.first_id))
    text = sorted((r.doc_id, r.text) for r in docs.collect())
    assert np.frombuffer(ids, "<u2").tolist() == [i for _, t in text for i in [*ids_of(library, t), 1]]
    asked = spark.createDataFrame([(text[3][0],), (10**9,), (-1,), (None,), (text[3][0],)], "doc_id bigint")
    assert [(r.doc_id, np.frombuffer(r.ids, np.uint32).tolist()) for r in store.lookup(asked).collect()] == [(text[3][0], [*ids_of(library, text[3][1]), 1])]


def test_empty_tables(spark):
    assert token_store.store_digest(nothing(spark)).collect() == []
    assert packing.pack_digest(nothing(spark)).collect() == []
    assert bpe.encode_digest(nothing(spark)).collect() == []
