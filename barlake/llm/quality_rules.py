"""Quality rules with thresholds that adapt to language and source.

Fixed rules come first (too few words, too many words in repeated 5-word
windows).  Then each of three ratios is held against an upper fence
``high + (high - low) / 2 + slack`` of its (lang, source) group, where high and
low are quantiles: outliers of a group go, whatever is usual in it stays.
Repeats are rare but honest in most groups, so their high quantile is q99, the
low one q90.  Symbol junk may be a larger part of a group, so there they are
q90 and q75: up to a tenth of junk does not move the fence.  Groups with fewer
than ``min_docs`` documents, too few for a q99, take the fence of their
language, languages with fewer that of the whole corpus.

Quantiles come from a mergeable sketch: counts of values in buckets that keep
a value's six leading bits, so a bucket is exact below 64 and at most 1/32 of
its value wide above.  Two sketches merge by adding counts; it is a plain
grouped count, summed up in each task before the shuffle, so a hot source
costs a few hundred rows for each task.  Its size has a bound for each group.

Everything runs on DataFrame functions; a text never leaves its row.

Rows: a null text counts as no words and fails the fixed rules; null lang or
source form groups of their own; repeated rows count as often as they occur;
an empty table gives no rows.  Window hashes have 64 bits: two different
windows of one text are taken as equal with odds of about 1e-19 a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import SPACE, fresh, needed, stored

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_DOCS = 100
#: Groups whose fences are broadcast (about 20 MB); more are joined by shuffle.
BROADCAST_GROUPS = 200_000
#: Each ratio's low and high quantile (in percent) and the slack of its fence, in parts of 10,000.
RATIOS = {"symbol_ratio": (75, 90, 200), "dup_line_ratio": (90, 99, 300), "repeat_ratio": (90, 99, 300)}
_BLANKS = " \t\n\u000b\f\r"
_SYMBOLS = "#*$%&|<>"


def base_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the counts of each text.  Built in steps so that each array is computed once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    body = F.btrim(text, F.lit(_BLANKS))
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(_BLANKS)) != "")
    a = docs.select(
        *keep,
        F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE)).alias("w"),
        F.length(F.translate(text, _BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"))
    rest = ["word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    b = a.select(
        *keep, "word_chars", "n_symbols", F.size("w").cast("bigint").alias("n_words"), F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    at = F.when(F.size("h") >= WINDOW, F.sequence(F.lit(0), F.size("h") - WINDOW)).otherwise(F.array().cast("array<int>"))
    c = b.select(*keep, *rest, F.transform(at, lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])).alias("g"))
    d = c.select(*keep, *rest, F.when(F.size(F.array_distinct("g")) < F.size("g"), F.col("g")).alias("g"))
    e = d.select(*keep, *rest, F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i")))).alias("s"))
    same = lambda i, j: F.get("s", i)["x"] == F.get("s", j)["x"]
    twice = F.filter("s", lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
    f = e.select(*keep, *rest, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("p"))
    covered = F.aggregate(F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW)))),
                          F.lit(0), lambda t, x: t + x)
    return f.select(*keep, *rest, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def with_ratios(features: DataFrame) -> DataFrame:
    """Ratios in parts of 10,000 and the verdict of the fixed rules."""
    part = lambda a, b: F.expr(f"10000 * {a} div greatest({b}, 1)")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return features.withColumns({"symbol_ratio": part("n_symbols", "word_chars"), "dup_line_ratio": part("n_dup_lines", "n_lines"),
                                 "repeat_ratio": part("n_repeat_words", "n_words"), "base_failed": failed})


def bucket(v: Column) -> Column:
    """The least value with the same six leading bits."""
    drop = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketch(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """(groups, feature, bucket, n): one mergeable sketch for each group and column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), bucket(F.col(c)).alias("bucket")) for c in columns]))
    return merged(df.select(*groups, pairs.alias("p")).select(*groups, "p.*", F.lit(1).cast("bigint").alias("n")), groups)


def merged(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Add up sketches, also to fewer groups."""
    return sketches.groupBy(*groups, "feature", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: list[str], percents: dict[str, int]) -> DataFrame:
    """(groups, feature, docs, one column for each percentage): the bucket that holds the value of that rank."""
    w = Window.partitionBy(*groups, "feature")
    ranked = sketches.select("*", F.sum("n").over(w.orderBy("bucket")).alias("upto"), F.sum("n").over(w).alias("docs"))
    rank = lambda q: F.expr(f"(docs * {q} + 99) div 100")
    return ranked.groupBy(*groups, "feature").agg(
        F.first("docs").alias("docs"), *[F.min(F.when(F.col("upto") >= rank(q), F.col("bucket"))).alias(name) for name, q in percents.items()])


def fences(sketches: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, one fence for each ratio) for each group of the sketch."""
    levels = []
    for groups in (["lang", "source"], ["lang"], []):
        percents = {f"q{p}": p for low, high, _ in RATIOS.values() for p in (low, high)}
        q = quantiles(merged(sketches, groups), groups, percents)
        fence = F.lit(None).cast("bigint")
        for name, (low, high, slack) in RATIOS.items():
            fence = F.when(F.col("feature") == name, F.expr(f"q{high} + (q{high} - q{low}) div 2 + {slack}")).otherwise(fence)
        fence = F.when((F.col("docs") >= min_docs) | F.lit(not groups), fence)
        n = len(groups)
        levels.append(q.select(*[F.col(g).alias(f"{g}{n}") for g in groups], F.col("feature").alias(f"feature{n}"), fence.alias(f"fence{n}")))
    two, one, none = levels
    best = (two.join(one, two.lang2.eqNullSafe(one.lang1) & (two.feature2 == one.feature1))
            .join(none, two.feature2 == none.feature0)
            .select(F.col("lang2").alias("fence_lang"), F.col("source2").alias("fence_source"), "feature2", F.coalesce("fence2", "fence1", "fence0").alias("fence")))
    return best.groupBy("fence_lang", "fence_source").agg(
        *[F.max(F.when(F.col("feature2") == c, F.col("fence"))).alias(f"{c}_fence") for c in RATIOS])


def _judged(features: DataFrame, min_docs: int) -> DataFrame:
    """Stored features with the fences of their group and the verdict ``kept``."""
    # fixed-rule failures don't shape the fences
    limits = stored(fences(sketch(features.where(~F.col("base_failed")), ["lang", "source"], list(RATIOS)), min_docs), "quality-fences")
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    known = features.join(limits, features.lang.eqNullSafe(limits.fence_lang) & features.source.eqNullSafe(limits.fence_source), "left")
    inside = F.lit(True)
    for c in RATIOS:
        inside &= F.coalesce(F.col(c) <= F.col(f"{c}_fence"), F.lit(False))
    return known.withColumn("kept", ~F.col("base_failed") & inside)


def judge(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Counts, ratios, fences and verdict of each document."""
    keep = ["doc_id", "lang", "source"]
    return _judged(stored(with_ratios(base_features(needed(docs, "text", *keep), keep)), "quality-features"), min_docs)


def filter_documents(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents kept, with their own columns.  Texts and features are stored together, so nothing is joined back."""
    own = fresh(docs, "document")
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(own), *[docs[c] for c in ("text", "lang", "source")])
    features = stored(with_ratios(base_features(packed, [own, "lang", "source"])), "quality-documents")
    return _judged(features, min_docs).where("kept").select(f"{own}.*")


def judge_digest(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                              "symbol_ratio", "dup_line_ratio", "repeat_ratio", *[f"{c}_fence" for c in RATIOS])
