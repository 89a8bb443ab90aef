"""Running sums over an ordering without putting a whole group in one task.

A window ``partitionBy(g).orderBy(v)`` sends every row of a group to a
single task.  Validation folds, score tables and "all new symbols" are few
and large groups, so the exact metrics and quantiles here use a two-level
prefix sum instead:

1. each row gets a bucket from its own order value, by a function that never
   falls as the value grows: rows of a bucket lie next to each other;
2. a running sum inside ``(group, bucket)``: a big group spans many tasks;
3. per ``(group, bucket)`` totals, summed before the shuffle, turned into
   offsets by a running sum over the buckets of a group;
4. running sum + offset = the exact group-wide running sum.

The bucket depends on the value alone, so both branches agree whatever the
physical layout, and nothing has to be written in between.  Strings are cut at
sampled quantiles; as their column is counted and sampled first, it should be
a stored one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType

from barlake.functions.numeric import fdiv

#: Buckets for each doubling of a number; a number has at most 1,044 doublings on each side of 0.
PER_OCTAVE = 1024
#: Strings in a bucket, about; sampled strings for each bound between buckets; bounds at most, and how many a first look skips.
PER_BUCKET, SAMPLED, MAX_BOUNDS, SKIP = 4096, 16, 4096, 64
_NAN, _NULL = 1 << 39, 1 << 40


def string_bounds(df: DataFrame, name: str) -> list[str]:
    """Bounds that cut the strings of a column into even parts of about ``PER_BUCKET``, from a sample of bounded size.

    The sample is those of least hash, so it depends on the strings alone and
    follows their order whatever they have in common.
    """
    parts = min(df.count() // PER_BUCKET, MAX_BOUNDS)
    if not parts:
        return []
    sample = df.where(F.col(name).isNotNull()).select(name).orderBy(F.xxhash64(name), name).limit(SAMPLED * parts).collect()
    ordered = sorted({r[0] for r in sample})
    return sorted({ordered[len(ordered) * i // (parts + 1)] for i in range(1, parts + 1)})


def string_bucket(c: Column, bounds: list[str]) -> Column:
    """The number of ``bounds`` (rising) that are not above the string, found in two looks."""
    if not bounds:
        return F.lit(0).cast("bigint")
    upto = lambda some: F.size(F.filter(some, lambda b: b <= c))
    start = (F.greatest(upto(F.lit(bounds[::SKIP])), F.lit(1)) - 1) * SKIP
    return (start + upto(F.slice(F.lit(bounds), start + 1, SKIP))).cast("bigint")


def value_bucket(df: DataFrame, name: str, descending: bool) -> Column:
    """A bucket that follows the order of a numeric, date or string column; NaN and NULL come as they sort."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, StringType):
        if descending:
            raise ValueError("strings are only bucketed in ascending order")
        place = string_bucket(c, string_bounds(df, name))
    elif isinstance(kind, DateType):
        place = F.floor(F.unix_date(c) / 16).cast("bigint")
    elif isinstance(kind, NumericType):
        x = c.cast("double")
        grown = F.floor(F.log2(1 + F.least(F.abs(x), F.lit(1e300)) * float(1 << 20)) * PER_OCTAVE).cast("bigint")
        place = F.when(x < 0, -grown).otherwise(grown)
        place = F.when(F.isnan(x), F.lit(_NAN)).otherwise(place)
    else:
        raise ValueError(f"no buckets for {kind.simpleString()}")
    return F.when(c.isNull(), F.lit(_NULL)).otherwise(-place if descending else place)


def ordered_prefix_sums(
    df: DataFrame,
    keys: list[str],
    order: str,
    sum_cols: list[str],
    descending: bool = False,
) -> DataFrame:
    """Append ``cum_<c>``: inclusive running sum of ``c`` within ``keys`` by ``order`` (NULL last).

    ``df`` must hold one row per ``(keys, order)`` (aggregate first), so the
    result is deterministic.
    """
    by = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    tagged = df.withColumn("_b", value_bucket(df, order, descending))
    inside = Window.partitionBy(*keys, "_b").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select("*", *[F.sum(c).over(inside).alias(f"_loc_{c}") for c in sum_cols])
    totals = tagged.groupBy(*keys, "_b").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    before = (Window.partitionBy(*keys) if keys else Window).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_k_b"),
                            *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    same = F.col("_b") == F.col("_k_b")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return local.join(offsets, same).select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], keys: list[str] | None = None
) -> DataFrame:
    """Exact lower quantiles per group: the smallest ``v`` with count(x <= v) >= q * n.

    Same definition as ``percentile_approx`` at unlimited accuracy, computed
    with distributed prefix counts.  NULL and NaN values are ignored.  Returns
    one row per group with one column per entry of ``probabilities``.
    """
    keys = list(keys or [])
    v = F.col(value)
    counts = (
        df.where(v.isNotNull() & ~F.isnan(v.cast("double")))
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_cnt"))
    )
    cum = ordered_prefix_sums(counts, keys, value, ["_cnt"])
    totals = counts.groupBy(*keys).agg(F.sum("_cnt").alias("_n"))
    # one row for each group: joined on the keys, or its only row beside each value
    joined = cum.join(totals, on=keys, how="inner") if keys else cum.withColumn("_n", totals.scalar())
    aggs = [
        F.min(F.when(F.col("cum__cnt") >= F.lit(q) * F.col("_n"), v)).alias(name)
        for name, q in probabilities.items()
    ]
    return joined.groupBy(*keys).agg(*aggs)


def score_label_table(scored: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """(keys, score) -> positives and negatives; duplicates of a score collapse here."""
    y = F.col(label).cast("double")
    return scored.groupBy(*keys, score).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1.0) - y).alias("neg")
    )


def roc_auc(scored: DataFrame, keys: list[str], score: str = "p", label: str = "y") -> DataFrame:
    """Exact ROC AUC per group (ties count one half); NaN for a single-class group."""
    table = score_label_table(scored, keys, score, label)
    cum = ordered_prefix_sums(table, keys, score, ["pos", "neg"], descending=True)
    above = F.col("cum_pos") - F.col("pos")
    agg = cum.groupBy(*keys).agg(
        F.sum(F.col("neg") * (above + F.col("pos") / F.lit(2.0))).alias("_u"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
    )
    return agg.select(*keys, fdiv(F.col("_u"), F.col("_p") * F.col("_n")).alias("roc_auc"))


def average_precision(scored: DataFrame, keys: list[str], score: str = "p", label: str = "y") -> DataFrame:
    """Step-wise average precision, sum over distinct thresholds of dRecall * precision.

    NaN when the group has a single class (the reference's rule).
    """
    table = score_label_table(scored, keys, score, label)
    cum = ordered_prefix_sums(table, keys, score, ["pos", "neg"], descending=True)
    precision = fdiv(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    agg = cum.groupBy(*keys).agg(
        F.sum(F.col("pos") * precision).alias("_s"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
    )
    ap = F.when((F.col("_p") > 0) & (F.col("_n") > 0), fdiv(F.col("_s"), F.col("_p"))).otherwise(F.lit(float("nan")))
    return agg.select(*keys, ap.alias("average_precision"))
