"""BPE encoding and decoding by speculate and verify.

A word's tokens are proposed by greedy longest match.  A proposal is the
word's BPE encoding exactly if every pair of adjacent tokens is compatible,
that is if no merge across their border would have come first.  All distinct
pairs of a slice are checked together on arrays; only words with an
incompatible pair go through exact merging.

Two tokens a, b meet at a border whose left side is, in turn, each symbol on
the right edge of a's merge tree, and whose right side is each symbol on the
left edge of b's.  A symbol lives from its own merge until the merge that
consumes it.  A merge (x, y) across the border happens exactly if its rank
comes before both consuming merges; with equal ranks the leftmost goes first,
so the one to the left of the border wins and the one to its right loses.
This needs ranks that grow towards the root of a merge tree and tokens that
encode to themselves; a token without both is never proposed.

Rows: a null text is the empty text, which has no tokens; rows with null or
repeated doc_id are encoded like any other; an empty table gives no rows.
Normalisation and word splitting are those of the vocabulary file, taken from
the library for all chunks that are not plain ASCII.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from barlake.llm.common import needed, slices, small_batches, spread, texts_of, tokenizer_file, worker_env
from barlake.llm.encoding import chunked

#: Distinct chunks, and as many words, remembered between slices of a task (speed only).
CACHE_CHUNKS = 300_000
END = "\x01"  # stands for the end-of-word suffix, as one character that the byte alphabet does not use
NEVER = np.int64(1) << 40

#: Fixed value: the word pattern of the vocabulary file, over lower-case ASCII.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
PLAIN = re.compile(r"[!-~]*\Z")

_CODERS: dict[str, "SpeculativeBpe"] = {}


class SpeculativeBpe:
    """Encoder and decoder for a BPE vocabulary file with an end-of-word suffix."""

    def __init__(self, path: str):
        worker_env()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        model = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        vocab, merges, suffix = model["model"]["vocab"], model["model"]["merges"], model["model"]["end_of_word_suffix"]
        text = lambda t: t[: -len(suffix)] + END if t.endswith(suffix) else t
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.size = size
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.rank = np.full(size, -1)
        self.product = np.zeros(len(merges), np.int64)
        pairs: dict[int, int] = {}
        for r, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = a + b
            x, y, t = vocab[a], vocab[b], vocab[whole]
            pairs[x * size + y] = r
            self.product[r] = t
            if self.rank[t] < 0:
                self.left[t], self.right[t], self.rank[t] = x, y, r
        self.merge_keys = np.sort(np.fromiter(pairs, np.int64, len(pairs)))
        self.merge_ranks = np.array([pairs[k] for k in self.merge_keys.tolist()], np.int64)
        self.right_edge, self.right_until = self._edge(self.right)
        self.left_edge, self.left_until = self._edge(self.left)
        usable = self._usable()
        self.symbols = {text(t): i for t, i in vocab.items() if len(text(t).rstrip(END)) == 1 and self.rank[i] < 0}
        self.proposed = self.symbols | {text(t): i for t, i in vocab.items() if usable[i]}
        self.longest = max(map(len, self.proposed))
        self.shown = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.pair_keys, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        self.known: dict[str, tuple[bytes, str]] = {}
        self.known_words: dict[str, list[int]] = {}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _edge(self, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each token the symbols on one edge of its merge tree, root first, and the rank that consumes each."""
        edge, until = [np.arange(self.size)], [np.full(self.size, NEVER)]
        while True:
            up = edge[-1]
            down = np.where(up >= 0, child[np.maximum(up, 0)], -1)
            if not (down >= 0).any():
                return np.stack(edge, 1), np.stack(until, 1)
            edge.append(down)
            until.append(np.where(down >= 0, self.rank[np.maximum(up, 0)], -1))

    def _crossed(self, a: np.ndarray, b: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether a merge of rank below ``before`` crosses the border of a and b."""
        out = np.zeros(len(a), bool)
        for i in range(self.right_edge.shape[1]):
            rows = np.flatnonzero((self.right_edge[a, i] >= 0) & ~out)
            if not len(rows):
                break
            for j in range(self.left_edge.shape[1]):
                rows = rows[self.left_edge[b[rows], j] >= 0]
                if not len(rows):
                    break
                r = self._ranks(self.right_edge[a[rows], i], self.left_edge[b[rows], j])
                out[rows] |= (r < before[rows]) & (r < self.right_until[a[rows], i]) & (r <= self.left_until[b[rows], j])
        return out

    def _usable(self) -> np.ndarray:
        """Merged tokens that encode to themselves, with ranks that grow towards the root."""
        made = np.flatnonzero(self.rank >= 0)
        x, y, r = self.left[made], self.right[made], self.rank[made]
        good = np.ones(self.size, bool)
        good[made] = (self.rank[x] < r) & (self.rank[y] < r) & ~self._crossed(x, y, r)
        for _ in range(self.right_edge.shape[1] + self.left_edge.shape[1]):
            good[made] &= good[x] & good[y]
        good[self.rank < 0] = False
        return good

    def _propose(self, word: str) -> list[int]:
        """Greedy longest match; a word ends with END."""
        tokens, p, n, find = [], 0, len(word), self.proposed.get
        while p < n:
            q = min(n, p + self.longest)
            while (t := find(word[p:q])) is None or q == n - 1:
                q -= 1
            tokens.append(t)
            p = q
        return tokens

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == key, self.merge_ranks[at], NEVER)

    def merge(self, words: list[str]) -> list[list[int]]:
        """Exact merging of all words side by side: in each step every word merges its pair of lowest rank, the leftmost of equals."""
        symbols = self.symbols
        start = [[*map(symbols.__getitem__, w[:-2]), symbols[w[-2:]]] for w in words]
        lens = np.fromiter(map(len, start), np.int64, len(start))
        tokens = np.fromiter((t for ts in start for t in ts), np.int64, int(lens.sum()))
        owner = np.repeat(np.arange(len(words)), lens)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(tokens), NEVER)  # of the pair that a token begins
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self._ranks(tokens[inner], tokens[inner + 1])
        while len(tokens):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(first, len(tokens)))
            lowest = np.repeat(np.minimum.reduceat(rank, first), sizes)
            over = lowest == NEVER
            if over.any():
                done.append((owner[over], tokens[over]))
                tokens, owner, rank, lowest = tokens[~over], owner[~over], rank[~over], lowest[~over]
                if not len(tokens):
                    break
            at = np.flatnonzero(rank == lowest)
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            tokens[at] = self.product[rank[at]]
            keep = np.ones(len(tokens), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # places after the removal: one token goes before each next word's place
            tokens, owner, rank = tokens[keep], owner[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                i = i[i + 1 < len(tokens)]
                same = owner[i] == owner[i + 1]
                rank[i[same]] = self._ranks(tokens[i[same]], tokens[i[same] + 1])
            ends = np.append(owner[1:] != owner[:-1], True)
            rank[ends] = NEVER
        out: list[list[int]] = [[] for _ in words]
        for who, what in done:
            cut = np.flatnonzero(who[1:] != who[:-1]) + 1
            for w, ts in zip(who[np.concatenate([[0], cut])], np.split(what, cut)):
                out[w] = ts.tolist()
        return out

    def _compatible(self, key: np.ndarray) -> np.ndarray:
        """Verdicts for pair keys (a * size + b); each distinct pair is checked once."""
        distinct, back = np.unique(key, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pair_keys, distinct), max(len(self.pair_keys) - 1, 0))
        new = distinct[self.pair_keys[at] != distinct] if len(self.pair_keys) else distinct
        if len(new):
            ok = ~self._crossed(new // self.size, new % self.size, np.full(len(new), NEVER))
            if len(self.pair_keys) > 2_000_000:
                self.pair_keys, self.pair_ok, new = np.zeros(0, np.int64), np.zeros(0, bool), distinct
                ok = ~self._crossed(new // self.size, new % self.size, np.full(len(new), NEVER))
            keys, oks = np.concatenate([self.pair_keys, new]), np.concatenate([self.pair_ok, ok])
            order = np.argsort(keys, kind="stable")
            self.pair_keys, self.pair_ok = keys[order], oks[order]
        return self.pair_ok[np.searchsorted(self.pair_keys, distinct)][back]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Tokens of words (byte alphabet, ending with END): propose all, verify all pairs, merge what fails."""
        tokens = [self._propose(w) for w in words]
        lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        if not len(lens):
            return []
        flat = np.fromiter((t for ts in tokens for t in ts), np.int64, int(lens.sum()))
        owner = np.repeat(np.arange(len(words)), lens)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        bad = ~self._compatible(flat[inner] * self.size + flat[inner + 1]) if len(inner) else np.zeros(0, bool)
        failing = np.unique(owner[inner[bad]])
        for i, exact in zip(failing, self.merge([words[i] for i in failing])):
            tokens[i] = exact
        return tokens

    def _words(self, chunk: str) -> list[str | int]:
        """A chunk's words in the byte alphabet, and the ids of special tokens standing between them."""
        out: list[str | int] = []
        for part in self.special_split.split(chunk) if self.special_split and "<|" in chunk else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif PLAIN.match(part):
                out += [w + END for w in ASCII_WORDS.findall(part.lower())]
            else:
                out += [w + END for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
        return out

    def encode_chunks(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        """For each chunk its ids (32-bit) and its decoded text."""
        known = self.known
        new = [c for c in chunks if c not in known]
        if len(known) + len(new) > CACHE_CHUNKS:
            known.clear()
            new = chunks
        parts = [self._words(c) for c in new]
        seen, shown = self.known_words, self.shown
        if len(seen) > CACHE_CHUNKS:
            seen.clear()
        fresh = list({w: None for ws in parts for w in ws if isinstance(w, str) and w not in seen})
        seen.update(zip(fresh, self.encode_words(fresh)))
        for c, ws in zip(new, parts):
            ids = [t for w in ws for t in (seen[w] if isinstance(w, str) else (w,))]
            known[c] = np.array(ids, np.uint32).tobytes(), self.decode(ids, shown)
        return [known[c] for c in chunks]

    @staticmethod
    def decode(ids: list[int], shown: dict[int, str]) -> str:
        """Without a decoder in the vocabulary file, tokens are joined by spaces."""
        return " ".join([shown[i] for i in ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """All ids one after another, each text's bounds in them, and each text's decoded form."""
        codes, chunks, bounds = chunked(texts)
        coded = self.encode_chunks(chunks)
        lens = np.fromiter((len(b) // 4 for b, _ in coded), np.int64, len(coded))
        flat = np.frombuffer(b"".join(b for b, _ in coded), np.uint32)
        ids, per_chunk = spread(flat, np.cumsum(lens) - lens, lens, codes)
        ends = np.concatenate([[0], np.cumsum(per_chunk)])
        some = per_chunk > 0
        upto = np.concatenate([[0], np.cumsum(some)])[bounds]
        forms = pa.array([s for _, s in coded], pa.large_string()).take(pa.array(codes[some]))
        return ids, ends[bounds], pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), forms), pa.scalar(" ", pa.large_string()))


def coder(path: str) -> SpeculativeBpe:
    """One coder for each Python worker and vocabulary."""
    if path not in _CODERS:
        _CODERS[path] = SpeculativeBpe(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids as little-endian 32-bit integers, decoded text) of every whole text."""
    return _mapped(docs, path, lambda ids, text: (ids, text.as_py()), "ids binary, decoded string", [pa.binary(), pa.string()])


def encode_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    return _mapped(docs, path, lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.as_buffer()).hexdigest()),
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string", [pa.int64(), pa.string(), pa.string()])


def _mapped(docs: DataFrame, path: str | None, give, columns: str, kinds: list[pa.DataType]) -> DataFrame:
    path = path or tokenizer_file("word_bpe_49k.json")
    small_batches(docs)
    names = ["doc_id", *[c.split(" ")[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            for cut in slices(batch):
                ids, bounds, decoded = bpe.encode(texts_of(cut))
                rows = [give(ids[a:b].tobytes(), t) for a, b, t in zip(bounds[:-1], bounds[1:], decoded)]
                yield pa.RecordBatch.from_arrays([cut.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names)

    src = needed(docs, "doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {columns}")
