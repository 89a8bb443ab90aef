"""Substring dedup over sliding sentence spans.

A text is cut into units: sentences, clauses and lines, each ending with one
of ``. ! ? ; : ,`` or a line break.  A span starts at each unit and takes at
least ``UNITS`` units and ``WORDS`` words; it is hashed by its words in lower
case.  Of all places where a span occurs in the corpus the first (least
doc_id, then text hash, then position) stays; units covered by any other
occurrence are removed.  What is left of a text keeps its own characters.

With ``fine`` units, a passage that begins and ends inside long sentences is
caught too: other scripts' signs end a unit, and a unit of ``REACH`` words or
more is cut after the word of least hash in each ``REACH`` words in a row (the
last, if several have it).  Whether it is cut after a word depends on the
``REACH - 1`` words on either side only, so hosts of a passage cut it alike but
for that much at its ends, and no piece is longer than ``REACH``.  A passage of
``4 * REACH + WORDS - 3`` = 48 words therefore holds a whole span, wherever it
is placed; up to ``2 * REACH - 1`` of its words stay at either end.

Each task settles what it can alone: all its occurrences of a span but its
first are not the corpus's first either.  Only its first goes on, so a span
that a third of the documents hold costs one entry for each task.  Entries
travel packed by hash bucket; each bucket names the occurrences to remove.
The number of buckets follows the size of the corpus.

Rows: a null text stays null and an empty one empty, with no units.  Rows
equal in doc_id and text count as one document and get the same result; a
null doc_id comes last.  Texts of fewer units or words than a span are never
touched.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import fresh, give_back, slices, small_batches, stored

UNITS = 2
WORDS = 15
#: Entries in a bucket, about, and entries a task gathers before it sends them.
BUCKET_SPANS, GATHER = 500_000, 500_000
LAST = np.int64(np.iinfo(np.int64).max)  # stands for a null doc_id

UNIT = re.compile(r"[^.!?;:,\n]*[.!?;:,\n]+[ \t\r\n]*|[^.!?;:,\n]+\Z")

#: Words in a row of which one ends a fine unit, and the signs that end one.
REACH = 9
_SIGNS = r".!?;:,\n\u3002\uff01\uff1f\uff1b\uff1a\uff0c\uff0e\uff61\uff64\u3001\u2026\u203c\u2047-\u2049\u037e\u0387\u0589\u060c\u061b\u061f\u06d4\u0964\u0965\u104a\u104b\u1362-\u1368\u17d4\u17d5\u2028\u2029"
FINE_UNIT = re.compile(rf"[^{_SIGNS}]*[{_SIGNS}]+[ \t\r\n]*|[^{_SIGNS}]+\Z")
PIECE = re.compile(r"\s*\S+\s*")

ENTRY = np.dtype([("h", "<u8"), ("doc", "<i8"), ("th", "<i8"), ("start", "<i4"), ("units", "<i4")])


@lru_cache(1 << 16)
def _word_hash(word: str) -> int:
    return xxhash.xxh32_intdigest(word)


def _pieces(unit: str) -> list[str]:
    """A unit cut after the word of least hash in each ``REACH`` words in a row."""
    low = unit.lower().split()
    if len(low) < REACH:
        return [unit]
    hashed, words, out, done, least = list(map(_word_hash, low)), PIECE.findall(unit), [], 0, 0
    for i, h in enumerate(hashed):
        if i - least >= REACH:
            least = min(range(i - REACH + 1, i + 1), key=lambda k: (hashed[k], -k))
        elif h <= hashed[least]:
            least = i
        if i >= REACH - 1 and least >= done:
            out.append("".join(words[done:least + 1]))
            done = least + 1
    return [*out, "".join(words[done:])] if done < len(words) else out


def units_of(text: str | None, fine: bool = False) -> list[str]:
    """The units of a text; joined they are the text."""
    if not fine:
        return UNIT.findall(text or "")
    return [p for u in FINE_UNIT.findall(text or "") for p in _pieces(u)]


def spans_of(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first unit, number of units) of each span."""
    words = [u.lower().split() for u in units]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    upto = np.concatenate([[0], np.cumsum(n_words)])
    n = len(units)
    start = np.arange(n)
    end = np.maximum(np.searchsorted(upto, upto[:-1] + WORDS), start + UNITS)
    start, end = start[end <= n], end[end <= n]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    hashed = np.fromiter((xxhash.xxh64_intdigest(" ".join(w)) if w else 0 for w in words), np.uint64, n)
    # units without a word have no part in a span's hash, so that blank lines don't matter
    some = np.flatnonzero(n_words)
    a, b = np.searchsorted(some, start), np.searchsorted(some, end)
    out = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        h = hashed[some]
        left = b - a
        for k in range(int(left.max())):
            on = left > k
            out[on] = (out[on] * np.uint64(0x9E3779B97F4A7C15) + h[a[on] + k]) * np.uint64(0xBF58476D1CE4E5B9)
            out[on] ^= out[on] >> np.uint64(29)
    return out, start, end - start


def _split(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first entry of each hash, and all others (but for repeats of the first from equal rows)."""
    e = e[np.lexsort((e["start"], e["th"], e["doc"], e["h"]))]
    new = np.concatenate([[True], e["h"][1:] != e["h"][:-1]])
    first = e[new]
    return first, e[e != first[np.cumsum(new) - 1]]


def _removals(docs: DataFrame, fine: bool) -> DataFrame:
    """(doc, th, start, units) of each span occurrence that is not the first, from (doc, th, text)."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = 1 + int(chars / (20 if fine else 25)) // BUCKET_SPANS
    names, schema = ["bucket", "entries", "removed"], "bucket int, entries binary, removed binary"

    def rows(*found: tuple[int, bytes | None, bytes | None]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.binary(), pa.binary()))], names)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def send() -> Iterator[pa.RecordBatch]:
            first, others = _split(np.concatenate(held))
            held.clear()
            if len(others):
                yield rows((int(others["h"][0] % np.uint64(n_buckets)), None, others.tobytes()))
            to = (first["h"] >> np.uint64(20)) % np.uint64(n_buckets)
            order = np.argsort(to, kind="stable")
            first, to = first[order], to[order]
            cut = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]])
            found = [(int(to[i]), first[i:j].tobytes(), None) for i, j in zip(cut[:-1], cut[1:]) if j > i]
            if found:
                yield rows(*found)

        for batch in batches:
            for cut in slices(batch):
                for doc, th, text in zip(cut.column("doc").to_pylist(), cut.column("th").to_pylist(), cut.column("text").to_pylist()):
                    h, start, units = spans_of(units_of(text, fine))
                    if len(h):
                        e = np.empty(len(h), ENTRY)
                        e["h"], e["doc"], e["th"], e["start"], e["units"] = h, doc, th, start, units
                        held.append(e)
                        n += len(e)
                if n > GATHER:
                    yield from send()
                    n = 0
        if held:
            yield from send()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def table(e: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(e[c])) for c in ("doc", "th", "start", "units")], ["doc", "th", "start", "units"])

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                _, others = _split(np.frombuffer(b"".join(held), ENTRY))
                held.clear()
                if len(others):
                    yield table(others)

        for batch in batches:
            for bucket, entries, removed in zip(batch.column("bucket").to_pylist(), batch.column("entries"), batch.column("removed")):
                if bucket != now:
                    yield from close()
                    now = bucket
                if removed.is_valid:
                    yield table(np.frombuffer(removed.as_py(), ENTRY))
                else:
                    held.append(entries.as_py())
        yield from close()
        give_back()

    # a task of the shuffle takes its buckets one after another, so their number doesn't set the number of tasks
    sent = docs.mapInArrow(gather, schema).repartition("bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(settle, "doc bigint, th bigint, start int, units int")


def dedup(docs: DataFrame, fine: bool = False) -> DataFrame:
    """``docs`` with the text left, and two columns: units before, units removed (``n_units``, ``n_removed``)."""
    small_batches(docs)
    doc, th, cuts = fresh(docs, "doc"), fresh(docs, "th"), fresh(docs, "cuts")
    keyed = docs.withColumns({doc: F.coalesce(docs["doc_id"].cast("bigint"), F.lit(int(LAST))), th: F.xxhash64(docs["text"])})
    found = _removals(keyed.select(F.col(doc).alias("doc"), F.col(th).alias("th"), "text"), fine)
    removed = stored(found.groupBy(F.xxhash64("doc", "th").alias(doc)).agg(F.collect_set(F.struct("start", "units")).alias(cuts)), "span-removals")
    # lists of places can be long, so they are never broadcast
    joined = keyed.withColumn(doc, F.xxhash64(doc, th)).join(removed.hint("merge"), doc, "left").select(*[f"`{c}`" for c in docs.columns], cuts)
    n_units, n_removed, columns = fresh(docs, "n_units"), fresh(docs, "n_removed"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                texts, n, gone = [], [], []
                for text, where in zip(cut.column("text").to_pylist(), cut.column(cuts)):
                    units = units_of(text, fine)
                    n.append(len(units))
                    drop = np.zeros(len(units), bool)
                    if where.is_valid:
                        for w in where.as_py():
                            drop[w["start"]:w["start"] + w["units"]] = True
                        text = "".join(u for u, d in zip(units, drop) if not d)
                    gone.append(int(drop.sum()))
                    texts.append(text)
                own = [pa.array(texts, pa.string()) if c == "text" else cut.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int64()), pa.array(gone, pa.int64())], [*columns, n_units, n_removed])

    return joined.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(n_units, T.LongType()), T.StructField(n_removed, T.LongType())]))


def dedup_documents(docs: DataFrame, fine: bool = False) -> DataFrame:
    """The documents with the text left; those of which no word is left go.  ``n_chars``, if there, follows the text."""
    out = dedup(docs, fine)
    left = (F.col(f"`{out.columns[-1]}`") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n_chars = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return out.where(left).withColumns(n_chars).select(*[f"`{c}`" for c in docs.columns])


def dedup_digest(docs: DataFrame) -> DataFrame:
    return dedup(docs.select(docs["doc_id"], docs["text"])).select("doc_id", "text", "n_units", "n_removed")
