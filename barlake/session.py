"""Spark session settings the engine relies on.

ANSI mode stays on (Spark 4 default); IEEE float division goes through
``barlake.functions.numeric.fdiv``.  Timestamps are UTC so dates derived from
timestamps agree with DuckDB.  AQE coalesces small shuffles, splits skewed
join partitions and turns joins into broadcasts only after it has measured
the real size of a side.
"""

from __future__ import annotations

import os
import re
import tempfile
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window stages are CPU-bound: do not let AQE merge small shuffles below 128 KiB
    # per partition (the default 1 MiB leaves most cores idle on bar-sized data;
    # at scale partitions are far larger, so this changes nothing there).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # fits that run side by side share the executors instead of queueing
    "spark.scheduler.mode": "FAIR",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 captures a Python call site for every Column call (error context);
    # it costs one JVM round trip each and doubles plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "barlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    On a cluster ``master`` is left to ``spark-submit``; for local runs pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder (``spark.checkpoint.dir``).

    A cluster names a shared folder there and it is used as is.  Only when
    neither the setting nor the context's checkpoint dir exists is a scratch
    folder created, and only for a local master: executors of a cluster would
    not see it.  ``spark.checkpoint.dir`` cannot be changed on a running
    session, so the fallback goes through ``setCheckpointDir``.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="barlake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


#: Files moved at a time.
MOVES = 16

#: Folders of intermediates that this process has named, for ``remove_scratch``.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    path = os.path.join(ensure_checkpoint_dir(spark), name)
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Remove the intermediates written so far; returns how many folders there were.

    Results read from them, so call it when those have been written elsewhere.
    """
    found = [p for p in _SCRATCH if path_exists(spark, p)]
    for p in found:
        remove_folder(spark, p)
    _SCRATCH.clear()
    return len(found)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage (survives executor loss, unlike a local checkpoint or a
    cache) and pins any value computed from the physical layout, such as a
    partition id, so every later consumer sees the same rows.  Used where one
    intermediate feeds two differently pruned branches.
    """
    import uuid

    path = scratch_path(df.sparkSession, f"materialized-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The store of a path (any file system that Spark reads), and the path there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own store."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder."""
    fs, where = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.mkdirs(where)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file within its store, making the target's folder."""
    fs, old = _file_system(spark, source)
    new = _file_system(spark, target)[1]
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def move_files(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Move many files (source, target) within their store, several at a time, each target folder made once."""
    if not moves:
        return
    fs, _ = _file_system(spark, moves[0][0])
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in sorted({target.rsplit("/", 1)[0] for _, target in moves}):
        fs.mkdirs(path(folder))

    def move(pair: tuple[str, str]) -> None:
        if not fs.rename(path(pair[0]), path(pair[1])):
            raise OSError(f"cannot move {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(MOVES) as workers:
        for _ in workers.map(move, moves):
            pass


def files_below(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Paths of the files below a folder whose names end so; none if there is no such folder.

    Folders are listed plainly: the store's recursive listing took 17 ms for each file of a local one.
    """
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return []
    found, folders = [], [where]
    while folders:
        for status in fs.listStatus(folders.pop()):
            if status.isDirectory():
                folders.append(status.getPath())
            elif (name := status.getPath().toString()).endswith(suffix):
                found.append(name)
    return found


@contextmanager
def split_size(spark: SparkSession, size: int):
    """Files are read in splits of ``size`` bytes, so that those of the small test tables have several.

    A task takes many splits: there are no more tasks than shuffle partitions, or four for each core.
    """
    sc, names = spark.sparkContext, ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionNum")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * sc.defaultParallelism)
    before = [spark.conf.get(n, None) for n in names]
    for n, v in zip(names, (str(size), "0", str(tasks))):
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in zip(names, before):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
