"""Suffix-array dedup: every byte inside a repeated string of ``length`` bytes goes, but for its first place.

Texts are UTF-8 bytes.  A window is ``length`` bytes of one text; a window that
also starts earlier (smaller doc_id, or earlier in the same document) is a
repeat, and all bytes under repeats are removed.  Repeats are judged on the
input.

No task can hold all suffixes of a corpus, so they are dealt out by content:

1. The anchor of a window is its ``GRAM``-byte string of least hash (the first,
   if several have it).  Equal windows have equal anchors.  Neighbouring
   windows mostly share one, so a text falls into runs of windows with one
   anchor each.  Blocks of documents send the hashes of their anchors to
   buckets, and each bucket answers which ones occur in several places.
2. For these a block sends the text under the run, a piece, to the bucket of
   its anchor, with equal pieces merged into their first.  Windows of other
   anchors occur once in the corpus and travel no further.
3. A bucket sorts the suffixes of its pieces in two stages: suffixes smaller
   than their successors are sorted directly; the others are induced from them
   by one scan over the buckets of the first byte.  Only suffixes that start a
   window of the run, and those that the induction of these asks for, are
   sorted, and only as deep as a window.  Common prefixes of neighbours show
   which windows are equal; all but the first of each group are repeats.

A passage in very many hosts makes one anchor with many different pieces.
Beyond ``HOT`` of them its windows are sent one by one, each to a bucket by the
hash of all of it, so equal windows still meet and no bucket gets them all.
Blocks and buckets are bounded in size; their number follows the corpus.  All
three passes over the texts read one exchange of them by block.

Rows: a null text counts as empty; texts shorter than a window lose nothing.
Rows equal in doc_id and text count as one document and get the same result.
Different texts under one doc_id follow an order set by their hashes; a null
doc_id comes last.  Extra columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import give_back

LENGTH = 100
GRAM = 32
#: Bytes of text in a block and behind a bucket, about.
BLOCK_BYTES = 2 << 20
#: Different pieces of one anchor, beyond which its windows are dealt out one by one.
HOT = 4096
#: Window starts handled at once in a block.
CHUNK = (1 << 20) - (1 << 12)
LAST = np.int64(np.iinfo(np.int64).max)  # stands for a null doc_id

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, f, np.uint64))]) for f in (_FACTOR, inverse))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (np.arange(1, 257, dtype=np.uint64) * _FACTOR) ^ np.uint64(0x5851F42D4C957F2D)
        x = (x ^ (x >> np.uint64(30))) * _MIX
        return x ^ (x >> np.uint64(27))


def _hasher(text: np.ndarray):
    """A function (starts, ends) -> 64-bit hashes of those strings, for ``text`` of bytes."""
    room = 1 << max(16, int(len(text)).bit_length())
    power, inverse = _powers(room)
    with np.errstate(over="ignore"):
        upto = np.concatenate([[np.uint64(0)], np.cumsum(_byte_values()[text] * power[:len(text)], dtype=np.uint64)])

    def mixed(h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (h ^ (h >> np.uint64(31))) * _MIX
            return h ^ (h >> np.uint64(29))

    def strings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((upto[b] - upto[a]) * inverse[a])

    def every(size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((upto[size:] - upto[:-size]) * inverse[:len(upto) - size])

    strings.every = every
    return strings


def _window_hashes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Hashes of the ``depth`` bytes from each of the rising ``places``; zeros after the end."""
    out = np.empty(len(places), np.uint64)
    for at in range(0, len(text), CHUNK):
        a, b = np.searchsorted(places, [at, at + CHUNK])
        if b > a:
            part = text[at:at + CHUNK + depth]
            out[a:b] = _hasher(np.concatenate([part, np.zeros(depth, np.uint8)]))(places[a:b] - at, places[a:b] - at + depth)
    return out


def _least(v: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` values in a row."""
    size, m = 1, v
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    n = len(v) - w + 1
    return np.minimum(m[:n], m[w - size:][:n]) if size < w else m


def runs_of(text: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first start, number of starts, hash of the piece) of each run; ``ends`` of the texts within ``text``."""
    found = []
    n = len(text) - length + 1
    mask = np.uint64((1 << 21) - 1)
    for at in range(0, max(n, 0), CHUNK):
        part = text[at:at + CHUNK + length - 1]
        hashes = _hasher(part)
        grams = hashes.every(gram)
        key = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_least(key, length - gram + 1) & mask).astype(np.int64)
        start = np.arange(at, at + len(anchor))
        inside = start + length <= ends[np.searchsorted(ends, start, side="right")]
        anchor[~inside] = -1
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        size = np.diff(np.append(new, len(anchor)))
        size, new = size[anchor[new] >= 0], new[anchor[new] >= 0]
        found.append((grams[anchor[new]], new + at, size, hashes(new, new + size + length - 1)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def two_stage_sort(text: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The positions where ``wanted`` holds, in the order of their suffixes up to ``depth`` bytes (or more).

    Stage one sorts those suffixes directly that are smaller than their
    successors.  Stage two scans the buckets of the first byte upwards: a
    suffix larger than its successor starts with a byte no smaller than that
    one's, so it is put into its bucket in the order in which the scan meets
    its successor.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    step = np.concatenate([np.sign(np.diff(text.astype(np.int16))), [-1]]).astype(np.int8)
    place = np.arange(n)
    turn = np.minimum.accumulate(np.where(step != 0, place, n - 1)[::-1])[::-1]  # the next byte that differs decides
    smaller = step[turn] > 0
    # a suffix to be induced asks for its successor, and so on up to one that is sorted directly
    next_smaller = np.minimum.accumulate(np.where(smaller, place, n - 1)[::-1])[::-1]
    last = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
    reach = np.zeros(n + 1, np.int32)
    np.add.at(reach, last, 1)
    np.add.at(reach, next_smaller[last] + 1, -1)
    need = wanted | (np.cumsum(reach[:n]) > 0)

    direct = _sorted_directly(text, np.flatnonzero(need & smaller), depth)
    cut = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if need[n - 1]:
        induced[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        now = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        bucket = []
        while len(now):  # predecessors with the same byte follow, longer runs last
            bucket.append(now)
            now = now[now > 0] - 1
            now = now[need[now] & (text[now] == c)]
        bucket.append(direct[cut[c]:cut[c + 1]])
        bucket = np.concatenate(bucket)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[need[before] & (text[before] > c)]
        if len(before):
            before = before[np.argsort(text[before], kind="stable")]
            byte = text[before]
            for piece in np.split(before, np.flatnonzero(byte[1:] != byte[:-1]) + 1):
                induced[text[piece[0]]].append(piece)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def _words(text: np.ndarray, room: int) -> np.ndarray:
    """The 8 bytes from each position as a number; zeros after the end, for ``room`` more positions."""
    w = np.concatenate([text, np.zeros(room + 8, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        w = (w[:-size] << np.uint64(8 * size)) | w[size:]
    return w


def _sorted_directly(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` by their next ``depth`` bytes: eight at a time, and only where equal so far and not equal to the end."""
    words = _words(text, depth + 8)
    key = words[places]
    order = np.argsort(key, kind="stable")
    whole = _window_hashes(text, places, depth)[order]
    places, key = places[order], key[order]
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    active = np.arange(len(places))
    done = 8
    while done < depth and len(active):
        g, h = group[active], whole[active]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        size = np.diff(np.append(first, len(g)))
        mixed = np.add.reduceat((h != np.repeat(h[first], size)).astype(np.int64), first) > 0
        active = active[np.repeat(mixed, size)]
        if not len(active):
            break
        g, key = group[active], words[places[active] + done]
        order = np.lexsort((key, g))
        at = active[order]
        g, key = g[order], key[order]
        places[active], whole[active] = places[at], whole[at]
        split = np.concatenate([[False], (g[1:] == g[:-1]) & (key[1:] != key[:-1])])
        # new group numbers, apart from all others: only equality matters, and members stay side by side
        group[active] = np.cumsum(split | np.concatenate([[True], g[1:] != g[:-1]])) + (len(places) + 1) * (done // 8)
        done += 8
    return places


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Bytes that each suffix of ``order`` has in common with the one before it, up to ``depth``; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    words = _words(text, depth + 8)
    alive, a, b = np.arange(1, len(order)), order[:-1], order[1:]
    for done in range(0, depth, 8):
        x = words[a + done] ^ words[b + done]
        same = x == 0
        lead = np.full(len(x), 8)
        some = x[~same]
        lead[~same] = np.searchsorted(np.array([1 << (8 * k) for k in range(8)], np.uint64), some, side="right") * -1 + 8
        out[alive] = np.minimum(done + lead, depth)
        alive, a, b = alive[same], a[same], b[same]
        if not len(alive):
            break
    # zeros after the end are no bytes of the text
    return np.concatenate([[0], np.minimum(out[1:], len(text) - np.maximum(order[1:], order[:-1]))])


def repeats_in(pieces: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of ``pieces``, given in the order of their places, occur earlier: by suffix array.

    The flags of all windows, piece after piece, and the end of each piece's in them.
    """
    seen: dict[bytes, int] = {}
    first = np.fromiter((seen.setdefault(p, i) for i, p in enumerate(pieces)), np.int64, len(pieces))
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    windows = np.maximum(size - length + 1, 0)
    text = np.frombuffer(b"".join(seen), np.uint8)  # equal pieces count once: all others of them are repeats
    own = first == np.arange(len(pieces))
    end = np.cumsum(size[own])
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, end - size[own], 1)
    np.add.at(edge, end - size[own] + windows[own], -1)
    wanted = np.cumsum(edge[:-1]) > 0
    order = two_stage_sort(text, wanted, length)
    gone = np.zeros(len(text), bool)
    if len(order):
        new = np.flatnonzero(common_prefixes(text, order, length) < length)
        least = np.repeat(np.minimum.reduceat(order, new), np.diff(np.append(new, len(order))))
        gone[order[order != least]] = True
    flags = np.ones(int(windows.sum()), bool)
    flags[np.repeat(own, windows)] = gone[wanted]
    return flags, np.cumsum(windows)


class _Block:
    """The documents of a block in their order, as one string of bytes."""

    def __init__(self, rows: pa.Table):
        text = rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) and text.num_chunks == 1 else text
        doc = rows.column("doc_id").to_numpy(zero_copy_only=False) if not rows.column("doc_id").null_count else np.array([LAST if v is None else v for v in rows.column("doc_id").to_pylist()], np.int64)
        th = rows.column("th").to_numpy()
        order = np.lexsort((th, doc))
        self.row = order
        d, t = doc[order], th[order]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])])[:len(d)]
        self.of_row = np.cumsum(new) - 1  # document of each ordered row
        self.doc = d[new]
        texts = text.take(pa.array(order[new]))
        parts = [np.frombuffer(s.as_buffer(), np.uint8) if s.is_valid else np.zeros(0, np.uint8) for s in texts]
        self.text = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.end = np.cumsum(size)
        self.start = self.end - size


def _buckets_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(13)) % np.uint64(n)).astype(np.int64)


def _anchors(block: _Block, n_buckets: int, length: int, gram: int):
    """Runs of a block, and its different anchors by bucket: (runs, hashes, buckets, pieces of each)."""
    runs = runs_of(block.text, block.end, length, gram)
    anchor, piece = runs[0], runs[3]
    order = np.lexsort((piece, anchor))
    a, p = anchor[order], piece[order]
    new = np.concatenate([[True], a[1:] != a[:-1]])[:len(a)]
    other = new | np.concatenate([[True], p[1:] != p[:-1]])[:len(p)]
    hashes = a[new]
    pieces = np.add.reduceat(other.astype(np.int64), np.flatnonzero(new)) if len(a) else np.zeros(0, np.int64)
    bucket = _buckets_of(hashes, n_buckets)
    by = np.argsort(bucket, kind="stable")
    return runs, hashes[by], bucket[by], pieces[by]


def _cuts(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
    return ((int(i), int(j)) for i, j in zip(edge[:-1], edge[1:]) if j > i)


ASK = "bucket int, block int, hashes binary, pieces binary"
ANSWER = "block int, bucket int, flags binary"
SENT = "bucket int, block int, docs binary, places binary, sizes binary, bytes binary, removed binary"
REMOVED = "block int, removed binary"
RANGE = np.dtype([("at", "<i4"), ("n", "<i4")])
_TYPES = {"int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64()}


def _columns(schema: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in schema.split(", ")])


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = _columns(schema)
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds)], schema=kinds)


def _each_bucket(batches: Iterator[pa.RecordBatch], close) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket after another; ``close`` makes a table of each."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != now:
                if held:
                    yield from close(held).to_batches()
                now, held = row["bucket"], []
            held.append(row)
    if held:
        yield from close(held).to_batches()
    give_back()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> bytes:
    out = np.empty(len(starts), RANGE)
    out["at"], out["n"] = starts, sizes
    return out.tobytes()


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` has the bytes that stay, which may cut a character in two."""
    if not 0 < gram <= length:
        raise ValueError("gram must be 1 to length")
    total = docs.agg(F.sum(F.octet_length(docs["text"]).cast("bigint"))).first()[0] or 0
    n = 1 + total // block_bytes
    n_buckets = 1 + n // 2
    th = F.xxhash64(docs["text"])
    texts = docs.select(F.pmod(F.xxhash64(docs["doc_id"].cast("bigint"), th), F.lit(n)).cast("int").alias("block"),
                        docs["doc_id"].cast("bigint").alias("doc_id"), th.alias("th"), F.coalesce(docs["text"], F.lit("")).alias("text"))

    def ask(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        _, hashes, bucket, pieces = _anchors(_Block(rows), n_buckets, length, gram)
        out = [(int(bucket[i]), block, hashes[i:j].tobytes(), np.minimum(pieces[i:j], 65535).astype(np.uint16).tobytes()) for i, j in _cuts(bucket)]
        give_back()
        return _table(ASK, out)

    def answer(held: list[dict]) -> pa.Table:
        hashes = np.frombuffer(b"".join(r["hashes"] for r in held), np.uint64)
        pieces = np.frombuffer(b"".join(r["pieces"] for r in held), np.uint16).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        h = hashes[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.append(first, len(h)))
        many = np.add.reduceat(pieces[order], first)
        flags = np.empty(len(h), np.uint8)
        flags[order] = np.repeat(np.where(many > hot, 2, (np.maximum(many, size) > 1).astype(np.int64)), size)
        # an anchor of one block and one piece may still repeat in the block: merged there
        out, at = [], 0
        for r in held:
            m = len(r["hashes"]) // 8
            if flags[at:at + m].any():
                out.append((r["block"], r["bucket"], flags[at:at + m].tobytes()))
            at += m
        return _table(ANSWER, out)

    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _table(SENT, [])
        block = rows.column("block")[0].as_py()
        b = _Block(rows)
        (anchor, start, size, piece), hashes, bucket, _ = _anchors(b, n_buckets, length, gram)
        flag = np.zeros(len(hashes), np.uint8)
        where = {int(bucket[i]): (i, j) for i, j in _cuts(bucket)}
        for r in answers.to_pylist():
            i, j = where[r["bucket"]]
            flag[i:j] = np.frombuffer(r["flags"], np.uint8)
        by = np.argsort(hashes)
        mine = flag[by][np.searchsorted(hashes[by], anchor)] if len(hashes) else np.zeros(0, np.uint8)
        # equal pieces of the block merge into their first, which goes on if others may have it
        data = b.text.tobytes()
        order = np.lexsort((piece, anchor))
        new = np.concatenate([[True], (anchor[order][1:] != anchor[order][:-1]) | (piece[order][1:] != piece[order][:-1])])[:len(order)]
        first = np.empty(len(order), np.int64)
        first[order] = np.repeat(order[new], np.diff(np.append(np.flatnonzero(new), len(order))))
        repeated = first != np.arange(len(order))
        for i in np.flatnonzero(repeated):  # equal hashes are checked on the bytes
            f, bytes_of = first[i], size[i] + length - 1
            repeated[i] = size[f] == size[i] and data[start[f]:start[f] + bytes_of] == data[start[i]:start[i] + bytes_of]
        removed = [(start[repeated], size[repeated])]
        go = np.flatnonzero((mine == 1) & ~repeated)
        to, at, n_starts = _buckets_of(anchor[go], n_buckets), start[go], size[go]
        split = np.flatnonzero((mine == 2) & ~repeated)
        if len(split):
            every = np.repeat(start[split], size[split]) + np.arange(size[split].sum()) - np.repeat(np.cumsum(size[split]) - size[split], size[split])
            windows = [data[i:i + length] for i in every.tolist()]
            own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in windows), np.uint64, len(windows))
            seen: dict[bytes, int] = {}
            new = np.array([seen.setdefault(w, k) == k for k, w in enumerate(windows)], bool)
            removed.append((every[~new], np.ones(int((~new).sum()), np.int64)))
            to, at, n_starts = np.concatenate([to, _buckets_of(own[new], n_buckets)]), np.concatenate([at, every[new]]), np.concatenate([n_starts, np.ones(int(new.sum()), np.int64)])
        order = np.lexsort((at, to))
        to, at, n_starts = to[order], at[order], n_starts[order]
        doc, place, windows = b.doc[np.searchsorted(b.end, at, side="right")], at.astype(np.int32), n_starts.astype(np.int32)
        starts, stops = at.tolist(), (at + n_starts + length - 1).tolist()
        out = [(int(to[i]), block, doc[i:j].tobytes(), place[i:j].tobytes(), windows[i:j].tobytes(),
                zstandard.compress(b"".join(data[x:y] for x, y in zip(starts[i:j], stops[i:j])), 1), None) for i, j in _cuts(to)]
        at, n_starts = (np.concatenate(c) for c in zip(*removed))
        if len(at):
            out.append((block % n_buckets, block, None, None, None, None, _ranges(at, n_starts)))
        give_back()
        return _table(SENT, out)

    def settle(held: list[dict]) -> pa.Table:
        out = [(r["block"], r["removed"]) for r in held if r["removed"] is not None]
        rows = [r for r in held if r["docs"] is not None]
        if rows:
            doc, at, size = (np.frombuffer(b"".join(r[c] for r in rows), kind).astype(np.int64) for c, kind in (("docs", "<i8"), ("places", "<i4"), ("sizes", "<i4")))
            block = np.repeat([r["block"] for r in rows], [len(r["sizes"]) // 4 for r in rows])
            data = b"".join(zstandard.decompress(r["bytes"]) for r in rows)
            order = np.lexsort((at, block, doc))
            end = np.cumsum(size + length - 1)
            starts, stops = (end - size - length + 1)[order].tolist(), end[order].tolist()
            flags, upto = repeats_in([data[x:y] for x, y in zip(starts, stops)], length)
            # runs of repeats within a piece
            before = np.concatenate([[False], flags[:-1]])
            before[(upto - size[order])] = False
            begins = np.flatnonzero(flags & ~before)
            after = np.concatenate([flags[1:], [False]])
            after[upto - 1] = False
            n_repeats = np.flatnonzero(flags & ~after) - begins + 1
            piece = np.searchsorted(upto, begins, side="right")
            where = order[piece]
            place = at[where] + begins - (upto - size[order])[piece]
            by = np.argsort(block[where], kind="stable")
            out += [(int(block[where[by[i]]]), _ranges(place[by[i:j]], n_repeats[by[i:j]])) for i, j in _cuts(block[where[by]])]
        return _table(REMOVED, out)

    kept_schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"

    def cut(rows: pa.Table, removed: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _table(kept_schema, [])
        b = _Block(rows)
        edge = np.zeros(len(b.text) + 1, np.int32)
        for r in removed.column("removed").to_pylist():
            e = np.frombuffer(r, RANGE)
            np.add.at(edge, e["at"], 1)
            np.add.at(edge, e["at"] + e["n"] + length - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = b.start[(b.start > 0) & (b.start < len(gone))]
        begins[inner] = gone[inner]
        total_gone, total_begun = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begins))
        n_removed, n_spans = total_gone[b.end] - total_gone[b.start], total_begun[b.end] - total_begun[b.start]
        left = np.flatnonzero(~gone)
        bounds = np.searchsorted(left, np.append(b.start, len(gone)))
        kept_all = b.text[left].tobytes()
        kept = [kept_all[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        doc_id = rows.column("doc_id").to_pylist()
        out = [(doc_id[r], int(b.end[k] - b.start[k]), int(n_removed[k]), int(n_spans[k]), kept[k]) for r, k in zip(b.row.tolist(), b.of_row.tolist())]
        give_back()
        return _table(kept_schema, out)

    asked = texts.groupBy("block").applyInArrow(ask, ASK).repartition("bucket").sortWithinPartitions("bucket")
    answers = asked.mapInArrow(lambda batches: _each_bucket(batches, answer), ANSWER)
    sent = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send, SENT).repartition("bucket").sortWithinPartitions("bucket")
    removed = sent.mapInArrow(lambda batches: _each_bucket(batches, settle), REMOVED)
    return texts.groupBy("block").cogroup(removed.groupBy("block")).applyInArrow(cut, kept_schema)


def dedup_digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
