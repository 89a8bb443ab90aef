"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import os
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import scratch_path

#: Text handled at once inside a Python task, in bytes (one longer text is still taken whole).
SLICE_BYTES = 2 << 20
#: Words of the word-based operators: runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    It cuts lineage and pins what depends on the physical layout; a lost
    executor only costs the tasks that were running.  Nothing reads the
    shuffles behind it any more, so their files go.
    """
    path = scratch(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a join's side that is sent to all executors, at most; rows of a few numbers, so 32 MB about.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table for a join: broadcast if a count shows it to be small, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def needed(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that extra columns with clashing names cannot disturb it."""
    return df.select(*[df[n] for n in names])


def words(text: Column) -> Column:
    """Words of a text; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a cut holds ``limit`` bytes of text at most, one row at least."""
    n = batch.num_rows
    if n == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size.astype(np.int64))
    i = 0
    while i < n:
        before = end[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(end, before + limit, side="right")))
        yield batch.slice(i, j - i)
        i = j
    give_back()


def small_batches(df: DataFrame) -> None:
    """Hand texts to Python in batches of 2,000 rows: the default of 10,000 rows holds too many bytes of whole texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def give_back() -> None:
    """Return freed memory to the system: a worker stays alive between tasks, beside others of its executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # a C library without malloc_trim
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with null as the empty text, copied: some Arrow functions err on arrays cut out of larger ones."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "").take(pa.array(np.arange(batch.num_rows)))


def spread(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``flat[starts[c]:starts[c] + lens[c]]`` for each code c; also the length of each."""
    ln = lens[codes]
    ends = np.cumsum(ln)
    if not len(ends) or ends[-1] == 0:
        return flat[:0], ln
    index = np.arange(ends[-1]) + np.repeat(starts[codes] - (ends - ln), ln)
    return flat[index], ln


def tokenizer_file(name: str) -> str:
    """Default place of a public tokenizer's vocabulary file (the path is a parameter everywhere)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_env() -> None:
    """Spark gives each task one core: libraries in it stay on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("OMP_NUM_THREADS", "1")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
