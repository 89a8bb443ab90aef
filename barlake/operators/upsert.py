"""Keyed idempotent upserts without a table format.

``merge_by_key`` is the pure merge (a DataFrame in, a DataFrame out); the
``*_table`` functions persist it.  Partitioned tables are rewritten with
dynamic partition overwrite, restricted to the partitions the update
touches, so the cost follows the update, not the table.  Running an upsert
twice with the same input gives the same table (last writer wins per key).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators.ordered import ordered_prefix_sums
from barlake.schema import PRICE
from barlake.session import materialize, path_exists


def check_unique_keys(updates: DataFrame, keys: list[str]) -> None:
    """Raise if a key occurs twice in ``updates`` (the database would refuse the batch)."""
    dup = updates.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate keys in upsert input: {dup[0].asDict()}")


def merge_by_key(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    replace: list[str] | None = None,
    keep: list[str] | None = None,
    merge: dict[str, Callable[[Column, Column], Column]] | None = None,
    on_insert: dict[str, Column] | None = None,
    on_update: dict[str, Column] | None = None,
) -> DataFrame:
    """Full-outer merge on ``keys``; output has ``target``'s columns.

    * ``replace``: take the update's value when the key is updated;
    * ``keep``: keep the target's value (inserted rows take ``on_insert`` or the update's value);
    * ``merge``: ``f(old, new)`` when both exist;
    * ``on_update``: value for every updated or inserted row (e.g. ``updated_at``).
    Columns not named anywhere behave like ``replace`` when the update has them,
    otherwise like ``keep``.  A ``replace`` or ``merge`` column, or a key, that the
    update lacks raises: it would silently become NULL for every updated row.
    """
    replace, keep, merge = list(replace or []), list(keep or []), dict(merge or {})
    on_insert, on_update = dict(on_insert or {}), dict(on_update or {})
    if missing := [c for c in [*keys, *replace, *merge] if c not in updates.columns]:
        raise ValueError(f"the update lacks the columns {missing}")
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    u = updates.select(*[F.col(c).alias(f"u_{c}") for c in updates.columns], F.lit(True).alias("_in_u"))
    cond = None
    for k in keys:
        c = F.col(f"t_{k}") == F.col(f"u_{k}")
        cond = c if cond is None else cond & c
    j = t.join(u, cond, "full_outer")
    in_t, in_u = F.col("_in_t").isNotNull(), F.col("_in_u").isNotNull()
    cols = []
    for c in target.columns:
        tc = F.col(f"t_{c}")
        uc = F.col(f"u_{c}") if c in updates.columns else F.lit(None)
        if c in keys:
            cols.append(F.coalesce(tc, uc).alias(c))
            continue
        if c in on_update:
            both = on_update[c]
        elif c in merge:
            both = merge[c](tc, uc)
        elif c in keep or (c not in replace and c not in updates.columns):
            both = tc
        else:
            both = uc
        insert = on_insert.get(c, on_update.get(c, uc))
        v = F.when(in_t & in_u, both).when(in_u, insert).otherwise(tc)
        cols.append(v.cast(target.schema[c].dataType).alias(c))
    return j.select(*cols)


def replace_by_key(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """All value columns replaced: target rows without an update, plus the updates."""
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


# ---------------------------------------------------------------- catalogue
def assign_new_ids(catalogue: DataFrame, new_symbols: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Ids for new symbols: max(existing id) + 1, 2, ... in symbol order, distributed."""
    ones = materialize(new_symbols.select(symbol).distinct()).withColumn("_one", F.lit(1))
    numbered = ordered_prefix_sums(ones, [], symbol, ["_one"])
    base = F.coalesce(catalogue.agg(F.max("id")).scalar(), F.lit(0))
    return numbered.select(symbol, (base + F.col("cum__one")).cast("bigint").alias("id"))


def upsert_instruments(catalogue: DataFrame, updates: DataFrame, now: Column | None = None) -> DataFrame:
    """Key symbol.  Overwrites market/asset_type/sector_code, ``listed_at = least(old, new)``,
    reactivates, stamps ``updated_at``; keeps id, name, delisted_at, created_at.
    New symbols get fresh ids; the result is the whole catalogue.  Of several update
    rows of a symbol the least (market, asset_type, sector_code) counts, with the
    least listed_at."""
    now = now if now is not None else F.current_timestamp()
    upd = updates.groupBy("symbol").agg(F.min(F.struct("market", "asset_type", "sector_code")).alias("kind"),
                                        F.min("listed_at").alias("listed_at")).select("symbol", "kind.*", "listed_at")
    new = upd.join(catalogue.select("symbol"), "symbol", "left_anti")
    ids = assign_new_ids(catalogue, new)
    upd = upd.join(ids, "symbol", "left")
    return merge_by_key(
        catalogue, upd, ["symbol"],
        replace=["market", "asset_type", "sector_code"],
        keep=["id", "name", "delisted_at", "created_at"],
        merge={"listed_at": lambda old, new_: F.least(old, new_)},
        on_insert={"created_at": now, "is_active": F.lit(True)},
        on_update={"is_active": F.lit(True), "updated_at": now},
    )


def symbol_ids(catalogue: DataFrame, rows: DataFrame, symbol: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Attach ``ticker_id``; returns (matched rows, unknown symbols with their row count)."""
    ids = catalogue.select(F.col("symbol").alias(symbol), F.col("id").alias("ticker_id"))
    matched = rows.join(ids, symbol, "inner")
    unknown = rows.join(ids, symbol, "left_anti").groupBy(symbol).count()
    return matched, unknown


def to_gold_bars(bars_with_ids: DataFrame) -> DataFrame:
    """Gold bar layout: DECIMAL(18,6) prices (half-up), volume default 0."""
    return bars_with_ids.select(
        F.col("ticker_id").cast("bigint"), "date",
        *[F.col(c).cast(PRICE).alias(c) for c in ("open", "high", "low", "close")],
        F.coalesce(F.col("volume"), F.lit(0)).cast("bigint").alias("volume"),
        F.col("open_interest").cast("bigint"),
    )


def upsert_bars(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Key (ticker_id, date); all six values replaced."""
    return replace_by_key(target, updates, ["ticker_id", "date"])


PREDICTION_KEYS = ["ticker_id", "prediction_date", "horizon_days", "model_name"]


def upsert_predictions(target: DataFrame, updates: DataFrame, now: Column | None = None) -> DataFrame:
    """Replaces run id, probability and class; keeps actual_class and created_at."""
    now = now if now is not None else F.current_timestamp()
    return merge_by_key(
        target, updates, PREDICTION_KEYS,
        replace=["run_id", "predicted_probability", "predicted_class"],
        keep=["actual_class", "created_at"],
        on_insert={"created_at": now, "actual_class": F.lit(None).cast("int")},
    )


def fill_actual_class(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """NULL ``actual_class`` filled from realised labels keyed (ticker_id, prediction_date, horizon_days)."""
    o = outcomes.select(
        "ticker_id", "prediction_date", "horizon_days", F.col("actual").cast("int").alias("_actual")
    )
    j = predictions.join(o, ["ticker_id", "prediction_date", "horizon_days"], "left")
    return j.select(
        *[F.coalesce(F.col("actual_class"), F.col("_actual")).alias("actual_class") if c == "actual_class" else F.col(c)
          for c in predictions.columns]
    )


def purge(table: DataFrame, removed_ids: DataFrame, key: str = "ticker_id") -> DataFrame:
    """Cascade delete — drop rows whose key is in ``removed_ids``."""
    return table.join(removed_ids.select(F.col(removed_ids.columns[0]).alias(key)), key, "left_anti")


# ---------------------------------------------------------------- persistence
def upsert_partitioned_table(target_path: str, updates: DataFrame, keys: list[str], partition_col: str,
                             merge_fn: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> None:
    """Rewrite only the partitions ``updates`` touches (dynamic partition overwrite).

    The target is read restricted to those partitions (a semi-join on the
    partition column lets dynamic partition pruning skip the rest), merged,
    and written back; other partitions are never read nor rewritten.  The update
    is stored first: the check, the list of partitions and the merge see the same rows.
    """
    spark = updates.sparkSession
    updates = materialize(updates)
    check_unique_keys(updates, keys)
    if path_exists(spark, target_path):  # any error in reading it stops the upsert before it writes
        target = spark.read.parquet(target_path)
        touched = updates.select(partition_col).distinct()
        scoped = target.join(touched, partition_col, "left_semi")
        merged = (merge_fn or (lambda t, u: replace_by_key(t, u, keys)))(scoped, updates.select(*target.columns))
    else:
        merged = updates
    write_partitions(merged, target_path, [partition_col], keys)


def write_partitions(df: DataFrame, path: str, partition_cols: list[str], sort_cols: list[str], dynamic: bool = True) -> None:
    """Write ``df`` in folders by ``partition_cols``, each file sorted.

    Rows are rebalanced by the partition columns: Spark splits a large
    partition over several tasks (and files) and joins small ones.  With
    ``dynamic`` only the folders present in ``df`` are replaced.
    """
    (df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, *sort_cols)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .option("compression", "zstd").partitionBy(*partition_cols).parquet(path))
