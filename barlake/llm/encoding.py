"""Token ids of whole texts by the tokenizers library, each distinct chunk encoded once.

The vocabulary used here lower-cases, drops white space, never joins
characters across it, nor a letter with a sign after it.  So a text's ids are
the ids of its white-space separated chunks in order, and signs that end a
chunk after a letter are a chunk of their own.  Chunks repeat; a slice's
distinct chunks are found by Arrow and only those not seen lately go through
the library.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barlake.llm.common import spread, worker_env

#: Chunks remembered in each of two generations: a full one becomes the old one, which is searched too (speed only).
CACHE_CHUNKS = 200_000

_ENCODERS: dict[str, "ChunkEncoder"] = {}


#: Signs that end a chunk after a letter; a text with "<|", which may begin a special token, is left as it is.
ENDING = r"([A-Za-z\x{00df}-\x{00f6}\x{00f8}-\x{017f}])([-.,;:!?)*#$%&]+)(\s|$)"


def chunked(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Codes of all chunks, the distinct chunks, and each text's bounds in the codes."""
    # the new array of the replacement is lower-cased, as ascii_lower errs on arrays cut out of larger ones
    split = pc.ascii_lower(pc.replace_substring_regex(texts, ENDING, r"\1 \2\3"))
    lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, split))
    coded = pc.dictionary_encode(lists.flatten())
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), bounds - bounds[0]


class ChunkEncoder:
    """Encodes texts with the vocabulary file at ``path`` (without special tokens)."""

    def __init__(self, path: str):
        worker_env()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _packed(self, chunks: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_CHUNKS:
            self.known, self.old = {}, self.known
        known, find, find_old = self.known, self.known.get, self.old.get
        out = [find(c) or find_old(c) for c in chunks]
        new = [i for i, p in enumerate(out) if p is None]
        for i, e in zip(new, self.tokenizer.encode_batch_fast([chunks[i] for i in new], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        known.update(zip(chunks, out))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` one after another, and the bounds of each text in them."""
        codes, chunks, bounds = chunked(texts)
        packed = self._packed(chunks)
        lens = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
        flat = np.frombuffer(b"".join(packed), np.uint32)
        ids, per_chunk = spread(flat, np.cumsum(lens) - lens, lens, codes)
        ends = np.concatenate([[0], np.cumsum(per_chunk)])
        return ids, ends[bounds]


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
