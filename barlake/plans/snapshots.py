"""Tables kept as whole snapshots with a commit record.

A snapshot is written to a folder of its own below ``<root>/data``; one row
appended to ``<root>/commits`` then makes it the table's newest version.  The
row is a single file, which the store shows whole or not at all, so a writer
that dies before it leaves a folder that no reader ever opens.  The folders of
all but the newest ``keep`` versions, and those without a commit, are removed
by the next writer.  There is one writer at a time; readers need no lock, as
a folder is never changed.

A commit can carry a ``tag``, such as the number of a stream's batch: a writer
that finds its tag committed has nothing left to do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.session import child_folders, path_exists, remove_folder

COMMITS_SCHEMA = "version bigint, folder string, tag string, committed_at timestamp"
KEEP = 3


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(version, folder, tag, committed_at) of each commit."""
    path = f"{root}/commits"
    if not path_exists(spark, path):
        return spark.createDataFrame([], COMMITS_SCHEMA)
    return spark.read.schema(COMMITS_SCHEMA).parquet(path)


def newest(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, folder) of the newest snapshot."""
    row = commits(spark, root).agg(F.max(F.struct("version", "folder")).alias("c")).first()["c"]
    return (row.version, row.folder) if row else None


def is_committed(spark: SparkSession, root: str, tag: str) -> bool:
    return not commits(spark, root).where(F.col("tag") == tag).isEmpty()


def read_snapshot(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The newest snapshot; without one an empty table."""
    at = newest(spark, root)
    return spark.read.schema(schema).parquet(f"{root}/data/{at[1]}") if at else spark.createDataFrame([], schema)


def write_snapshot(df: DataFrame, root: str, tag: str | None = None, keep: int = KEEP) -> int:
    """Write ``df`` as the next version and return its number.  ``df`` may read the version before."""
    spark = df.sparkSession
    at = newest(spark, root)
    version, folder = (at[0] + 1 if at else 0), uuid.uuid4().hex
    df.write.option("compression", "zstd").parquet(f"{root}/data/{folder}")
    (spark.createDataFrame([(version, folder, tag)], "version bigint, folder string, tag string")
     .withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/commits"))
    kept = {r.folder for r in commits(spark, root).where(F.col("version") > version - keep).select("folder").collect()}  # at most ``keep`` rows
    for name in child_folders(spark, f"{root}/data"):
        if name not in kept:
            remove_folder(spark, f"{root}/data/{name}")
    return version
