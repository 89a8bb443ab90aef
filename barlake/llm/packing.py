"""Packing documents into fixed-length training sequences: concatenate and cut.

Pass 1 encodes each partition once and notes a document's place among its
partition's ids.  The partitions' totals (one row each) give each partition's
global offset, so a document's place in the concatenation is a sum of two
numbers.  Pass 2 cuts every document at the multiples of the sequence length.
All sequences are full but the last one, so padding is below one sequence for
the whole corpus.

Rows: a null text is the empty text (only the end id); a null doc_id and
repeated rows are packed like any other row; an empty table gives no rows.
Extra columns are ignored.  The order of documents follows the input's
partitions; it is fixed once pass 1 is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import needed, slices, small_batches, stored, texts_of, tokenizer_file
from barlake.llm.encoding import encoder

SEQUENCE_LENGTH = 2048
END_ID = 1


def encode_documents(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pass 1: (part, local_start, doc_id, doc_tokens, ids), ids as little-endian 32-bit integers."""
    path = path or tokenizer_file("word_bpe_49k.json")
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32).tobytes()
        for batch in batches:
            for cut in slices(batch, 8 << 20):  # the encoder gains from long slices
                ids, bounds = enc.encode(texts_of(cut))
                n = np.diff(bounds) + 1
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(cut.num_rows, part, np.int32)), pa.array(starts), cut.column("doc_id"), pa.array(n),
                     pa.array([ids[a:b].tobytes() + end for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    ["part", "local_start", "doc_id", "doc_tokens", "ids"])

    src = needed(docs, "doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"part int, local_start bigint, doc_id {kind}, doc_tokens bigint, ids binary")


def cut_sequences(encoded: DataFrame, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Pass 2: one row for each piece, with its ids, place in its document and place in its sequence.

    ``encoded`` must be stored: its totals and its rows are read separately.
    """
    totals = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    g = F.col("base") + F.col("local_start")
    # a row of 12 bytes for each task of pass 1: 12 MB for a million tasks
    placed = encoded.join(F.broadcast(offsets), "part").withColumn("g", g)
    last = F.col("g") + F.col("doc_tokens")

    def piece(s):
        lo = F.greatest(F.col("g"), s * length)
        n = F.least(last, (s + 1) * length) - lo
        cut = F.substring(F.col("ids"), ((lo - F.col("g")) * 4 + 1).cast("int"), (n * 4).cast("int"))
        return F.struct((lo - F.col("g")).alias("start"), n.alias("length"), cut.alias("ids"),
                        s.alias("sequence_id"), (lo - s * length).alias("offset"))

    windows = F.sequence(F.expr(f"g div {length}"), F.expr(f"(g + doc_tokens - 1) div {length}"))
    return (placed.select("doc_id", "doc_tokens", F.explode(F.transform(windows, piece)).alias("p"))
            .select("doc_id", "doc_tokens", "p.*"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ids joined in order, and the boundary records (doc_id, start, offset, length)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    return (pieces.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id",
                    F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
                    F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"),
                                                            p["offset"].alias("offset"), p["length"].alias("length"))).alias("documents")))


def pack(docs: DataFrame, path: str | None = None, length: int = SEQUENCE_LENGTH, end_id: int = END_ID) -> DataFrame:
    """Encode, store, cut."""
    return cut_sequences(stored(encode_documents(docs, path, end_id), "packing-ids"), length)


def pack_digest(docs: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
