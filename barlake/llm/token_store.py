"""Token-id files with keyed access through a minimal perfect hash index.

Files (below one folder of shared storage):

* ``ids/*.bin``  raw ids of consecutive documents, little-endian, 16 bits if
  the vocabulary allows it, else 32; no header, an end id after each document;
* ``ids/*.idx``  for each document of the .bin file the place where its ids
  end, as little-endian 64-bit integers;
* ``manifest``   one row for each .bin file in document order;
* ``index``      one row for each bucket of keys: the levels of a minimal
  perfect hash with a stored rank for every 512 bits, a stored 64-bit
  fingerprint for each slot, and for each slot its runs of rows (file and row
  range).

Documents are written in ascending doc_id order (null first) by a range sort;
ties are broken by text hash and input place, so no equal ids pile up in one
task.  A task writes its files under names of its own and reports them in its
rows, so files of failed attempts are never referenced.

A key costs the hash of its bucket, one slot, one fingerprint comparison and
one range of a file.  Absent keys are rejected by fingerprint (a wrong
acceptance has odds of 2^-64).

Rows: a null text is the empty text (only the end id).  Rows that share a
doc_id, null included, are all stored and all found under it; in one file they
form one run, so the index grows with files, not with repeats.  An empty table
gives an empty manifest and index.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm import perfect_hash
from barlake.llm.common import needed, scratch, slices, small_batches, small_side, stored, texts_of, tokenizer_file
from barlake.llm.encoding import encoder

END_ID = 1
#: Ids in a .bin file, if its documents are not longer.
FILE_IDS = 4 << 20
#: Keys in a bucket of the index, about.
BUCKET_KEYS = 50_000
#: Buckets that a lookup names one by one.
FEW_BUCKETS = 1000

RUN = np.dtype([("part", "<i4"), ("seq", "<i4"), ("first_row", "<i8"), ("n_rows", "<i8")])


def _filesystem(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def _hashes(key: Column) -> list[Column]:
    text = F.coalesce(key.cast("string"), F.lit("\u0000null"))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Write the .bin and .idx files.  Rows: a run of equal doc_ids within a file (kind 0) or a file (kind 1)."""
    src = needed(docs, "doc_id", "text").orderBy(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        wide = enc.tokenizer.get_vocab_size() > 1 << 16
        store, root = _filesystem(folder)
        store.create_dir(root, recursive=True)
        kind, ids, keys = "<u4" if wide else "<u2", [], []
        n_ids, ends = 0, []

        def close() -> pa.RecordBatch:
            nonlocal n_ids, seq
            name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}"
            for suffix, data in (("bin", b"".join(ids)), ("idx", np.cumsum(np.concatenate(ends)).astype("<i8").tobytes())):
                with store.open_output_stream(f"{root}/{name}.{suffix}") as f:
                    f.write(data)
            key = pa.chunked_array(keys).combine_chunks()
            codes = key.dictionary_encode(null_encoding="encode")
            code = codes.indices.to_numpy()
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            rows = np.diff(np.append(first, len(code)))
            n = len(first)
            out = pa.RecordBatch.from_arrays([
                pa.array([0] * n + [1], pa.int32()), pa.concat_arrays([key.take(pa.array(first)), pa.nulls(1, key.type)]),
                pa.array([part] * (n + 1), pa.int32()), pa.array([seq] * (n + 1), pa.int32()),
                pa.array([*first, 0], pa.int64()), pa.array([*rows, len(code)], pa.int64()),
                pa.array([None] * n + [n_ids], pa.int64()), pa.array([None] * n + [name], pa.string())],
                ["kind", "doc_id", "part", "seq", "first_row", "n_rows", "n_ids", "name"])
            seq, n_ids = seq + 1, 0
            for x in (ids, keys, ends):
                x.clear()
            return out

        for batch in batches:
            for cut in slices(batch, 8 << 20):  # the encoder gains from long slices
                flat, bounds = enc.encode(texts_of(cut))
                full = np.insert(flat, bounds[1:], end_id)
                n = np.diff(bounds) + 1
                ids.append(full.astype(kind).tobytes())
                keys.append(cut.column("doc_id"))
                ends.append(n)
                n_ids += len(full)
                if n_ids >= FILE_IDS:
                    yield close()
        if keys:
            yield close()

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"kind int, doc_id {kind}, part int, seq int, first_row bigint, n_rows bigint, n_ids bigint, name string")


def build_index(runs: DataFrame, buckets: int) -> DataFrame:
    """One row for each bucket from (doc_id, part, seq, first_row, n_rows)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h1", "h2", "part", "seq"], kind="stable")
        h1, h2 = (pdf[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("h1", "h2"))
        first = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        sizes, bits = perfect_hash.build(h1[first], h2[first])
        words, ranks = perfect_hash.pack(bits)
        slot = perfect_hash.packed_slots(h1[first], h2[first], sizes, words, ranks)
        count = np.diff(np.append(first, len(h1)))
        order = np.argsort(slot)
        prints = h2[first][order]
        runs = np.zeros(len(h1), RUN)
        for c in RUN.names:
            runs[c] = pdf[c].to_numpy()
        place = np.concatenate([np.arange(a, a + n) for a, n in zip(first[order], count[order])])
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "n_keys": [len(first)], "sizes": [sizes], "bits": [words], "ranks": [ranks],
                             "fingerprints": [prints.astype("<u8").tobytes()], "run_ends": [np.cumsum(count[order]).astype("<i8").tobytes()],
                             "runs": [runs[place].tobytes()]})

    keyed = runs.select("part", "seq", "first_row", "n_rows", *_hashes(F.col("doc_id"))).withColumn("bucket", F.expr(f"pmod(h1, {buckets})"))
    return keyed.groupBy("bucket").applyInPandas(
        run, "bucket bigint, n_keys bigint, sizes array<bigint>, bits binary, ranks binary, fingerprints binary, run_ends binary, runs binary")


class TokenStore:
    """The files below ``folder``: ``write`` makes them, ``lookup`` reads documents by key."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, name))

    @classmethod
    def write(cls, docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = END_ID) -> "TokenStore":
        spark = docs.sparkSession
        small_batches(docs)
        store = cls(spark, folder or scratch(spark, "token-store"))
        path = path or tokenizer_file("word_bpe_49k.json")
        written = stored(write_ids(docs, os.path.join(store.folder, "ids"), path, end_id), "token-runs")
        files = written.where("kind = 1").select("part", "seq", "name", "n_rows", "n_ids")
        # ids before a file: those of the tasks before (a row for each task), and those of its own task's files before
        earlier = (Window.unboundedPreceding, -1)
        parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("before"))
        inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(*earlier)), F.lit(0))
        files.withColumn("inside", inside).join(parts, "part").select("part", "seq", "name", "n_rows", "n_ids", (F.col("before") + F.col("inside")).alias("first_id")).write.parquet(os.path.join(store.folder, "manifest"))
        runs = written.where("kind = 0")
        buckets = max(1, -(-runs.count() // BUCKET_KEYS))
        build_index(runs, buckets).withColumn("buckets", F.lit(buckets)).sortWithinPartitions("bucket").write.parquet(os.path.join(store.folder, "index"))
        return store

    def locate(self, keys: DataFrame) -> DataFrame:
        """(doc_id, part, seq, first_row, n_rows) for the distinct keys that are stored.

        Only buckets that a key falls in are read from the index: a few of them by their
        numbers, which the files' statistics find, more of them by a semi-join.
        """
        index = self._table("index")
        buckets = (index.select("buckets").first() or [1])[0]
        kind = keys.schema["doc_id"].dataType.simpleString()
        asked = keys.select("doc_id").distinct().select("doc_id", *_hashes(F.col("doc_id"))).withColumn("bucket", F.expr(f"pmod(h1, {buckets})"))
        wanted = [r.bucket for r in asked.select("bucket").distinct().limit(FEW_BUCKETS + 1).collect()] if buckets > 1 else []
        if buckets > 1 and len(wanted) <= FEW_BUCKETS:
            index = index.where(F.col("bucket").isin(wanted))
        elif buckets > FEW_BUCKETS:
            index = index.join(small_side(stored(asked.select("bucket").distinct(), "asked-buckets")), "bucket", "left_semi")

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            empty = pd.DataFrame({"doc_id": left["doc_id"][:0], **{c: np.zeros(0, np.int64) for c in RUN.names}})
            if left.empty or right.empty:
                return empty
            b = right.iloc[0]
            h1, h2 = (left[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("h1", "h2"))
            sizes = [int(x) for x in b["sizes"]]
            slot = perfect_hash.packed_slots(h1, h2, sizes, b["bits"], b["ranks"])
            prints = np.frombuffer(b["fingerprints"], "<u8")
            found = (slot >= 0) & (prints[np.maximum(slot, 0)] == h2)
            slot = slot[found]
            ends = np.frombuffer(b["run_ends"], "<i8")
            starts = np.concatenate([[0], ends[:-1]])
            runs, n = np.frombuffer(b["runs"], RUN), ends[slot] - starts[slot]
            at = np.concatenate([np.arange(starts[s], ends[s]) for s in slot]) if len(slot) else np.zeros(0, np.int64)
            return pd.DataFrame({"doc_id": left["doc_id"][found].repeat(n).reset_index(drop=True), **{c: runs[c][at].astype(np.int64) for c in RUN.names}})

        return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
            run, f"doc_id {kind}, part int, seq int, first_row bigint, n_rows bigint")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """(doc_id, start, n_tokens, ids) of all documents stored under the keys, read from the files.

        ``start`` counts the ids of all documents before; ``ids`` are little-endian 32-bit integers.
        """
        kind, folder = keys.schema["doc_id"].dataType.simpleString(), os.path.join(self.folder, "ids")
        placed = self.locate(keys).join(self._table("manifest").select("part", "seq", "name", "first_id", "n_ids"), ["part", "seq"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = _filesystem(folder)
            open_name = None
            for batch in batches:
                rows, size = [], 0
                for doc_id, name, first_id, n_ids, first, n in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "name", "first_id", "n_ids", "first_row", "n_rows")]):
                    if name != open_name:
                        open_name, data = name, store.open_input_file(f"{root}/{name}.bin")
                        with store.open_input_file(f"{root}/{name}.idx") as f:
                            ends = np.frombuffer(f.read(), "<i8")
                        kind = f"<u{data.size() // max(n_ids, 1)}"
                        width = np.dtype(kind).itemsize
                    for r in range(first, first + n):
                        a, b = int(ends[r - 1]) if r else 0, int(ends[r])
                        ids = np.frombuffer(data.read_at((b - a) * width, a * width), kind).astype("<u4").tobytes()
                        rows.append((doc_id, first_id + a, b - a, ids))
                        size += len(ids)
                        if size > 8 << 20:
                            yield _batch(rows, batch.schema.field("doc_id").type)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, batch.schema.field("doc_id").type)

        near = placed.repartition("part", "seq").sortWithinPartitions("part", "seq", "first_row")
        return near.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")


def _batch(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (key, pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "n_tokens", "ids"])


def store_digest(docs: DataFrame) -> DataFrame:
    """Write all documents, look every key up again and return a checksum of the ids read."""
    read = TokenStore.write(docs).lookup(needed(docs, "doc_id"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
