"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime
size (an offset and a skip from its name).  Shards take turns; in its turn a
shard claims the first slot of its order that is still free, until all slots
are taken.  Shares then differ by one slot at most, and adding or removing a
shard moves few keys.  A row's slot is a hash of its key, its shard the table
entry: a join with a broadcast table of ``size`` rows, whose size is a
parameter and checked.

The table depends on the shard names alone, never on the data.  A shard gets a
key's rows whole, so a hot key makes a hot shard; ``write_shards`` still
spreads its rows over tasks.

Rows: a null key is placed like the empty string; repeated keys go to the same
shard; an empty table gives no rows; all columns are kept and ``slot`` and
``shard`` are added (``slot_`` and ``shard_`` where the input has such columns).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import fresh

#: Rows of the broadcast table at most: 16 MB.
MAX_SIZE = 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int) -> list[int]:
    """The shard (by place in ``shards``) of each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be distinct and at least one")
    if not is_prime(size) or not len(shards) <= size <= MAX_SIZE:
        raise ValueError(f"the table size must be a prime from the number of shards to {MAX_SIZE}")
    skip = [_number(f"skip {s}") % (size - 1) + 1 for s in shards]
    want = [_number(f"offset {s}") % size for s in shards]
    table = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        while table[want[i]] >= 0:
            want[i] = (want[i] + skip[i]) % size
        table[want[i]] = i
    return table


def key_slot(key: Column, size: int) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % size).cast("int")


def slots(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard) as a table, split from one literal."""
    text = ",".join(map(str, lookup_table(shards, size)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard")).select("slot", F.col("shard").cast("int").alias("shard"))


def assign(df: DataFrame, key: str, shards: list[str], size: int) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; where columns have these names already, the new ones end in ``_``."""
    slot, shard = fresh(df, "slot"), fresh(df, "shard")
    placed = df.withColumn(slot, key_slot(df[key], size))
    lookup = slots(df.sparkSession, shards, size).withColumnsRenamed({"slot": slot, "shard": shard})
    return placed.join(F.broadcast(lookup), slot).select(*[f"`{c}`" for c in df.columns], slot, shard)


def write_shards(df: DataFrame, key: str, shards: list[str], size: int, path: str) -> None:
    """One folder for each shard.  Rows are rebalanced by shard, so Spark splits a large shard over tasks."""
    shard = fresh(df, "shard")
    assign(df, key, shards, size).hint("rebalance", shard).write.partitionBy(shard).parquet(path)


#: The registered placement: 40 shards, a prime of about a hundred slots for each.
SHARDS = [f"shard-{i:03d}" for i in range(40)]
SIZE = 4001


def shard_documents(docs: DataFrame) -> DataFrame:
    return assign(docs.select(docs["doc_id"]), "doc_id", SHARDS, SIZE)
