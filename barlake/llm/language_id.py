"""Language identification by one character language model for each language.

A text is a row of lower-case letters, each mapped to one of 63 classes (a-z
have their own, other letters share the rest by hash) and class 0 for anything
between words.  An interpolated Kneser-Ney model of order 4 gives each letter
and word end a probability from the three classes before it in its word: the
highest order uses counts, lower orders count distinct left neighbours.

Counting covers every training text; each task adds up its counts before the
shuffle, so a hot language costs one row for each n-gram and task.  Lower
orders, context totals and discounts are grouped counts on Spark, where they
stay.  A model is a sorted array of n-gram codes (24 bits) for each order with
a column of log-probabilities for each language.  Languages are scored in
blocks of at most ``BLOCK_LANGUAGES`` and ``BLOCK_CODES`` codes (one language
alone has 64^4 at most), which bounds what the driver reads and sends to the
tasks at a time; there is no bound on the number of languages.  With several
blocks each text's best language is a grouped maximum over them.

The language with the lowest cross-entropy per symbol wins, ties going to the
first name.  ``rejected`` is calibrated: a text is rejected if its
cross-entropy is above what ``ACCEPT_PERCENT`` of its language's own training
texts reach.  ``score`` is the posterior of the winner with equal priors.

Rows: ``lang`` and ``source`` are never inputs of a prediction; training takes
rows that are not held out with non-null text and lang.  A text that is null
or has no letter is ``und`` with score 0, as is any text if nothing could be
learned.  Repeated rows count as often as they occur; a null doc_id is not
held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import needed, slices, small_batches, small_side, stored

ORDER = 4
BITS = 6
CLASSES = 1 << BITS
BLOCK_LANGUAGES, BLOCK_CODES = 16, 2_000_000
ACCEPT_PERCENT = 99.5
UNKNOWN = "und"

_TABLE: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """The class of each code point: 0 unless it is a letter."""
    if not _TABLE:
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        code = np.arange(0x110000, dtype=np.uint64)
        other = 27 + ((code * np.uint64(2654435761)) >> np.uint64(13)) % np.uint64(CLASSES - 27)
        own = (code >= 97) & (code <= 122)
        _TABLE.append(np.where(own, code - np.uint64(96), np.where(letter, other, 0)).astype(np.uint32))
    return _TABLE[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The order-4 codes of all texts, and each text's bounds in them."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    c = _classes()[points]
    before = np.concatenate([np.zeros(1, np.uint32), c[:-1]])
    keep = (c != 0) | (before != 0)
    kept = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(size)])]
    c = c[keep]
    pad = np.concatenate([np.zeros(3, np.uint32), c])
    one, two, three = pad[2:-1], pad[1:-2], pad[:-3]
    two = np.where(one == 0, 0, two)
    three = np.where(two == 0, 0, three)
    return (three << 18 | two << 12 | one << 6 | c).astype(np.uint32), kept


def count_grams(train: DataFrame) -> DataFrame:
    """(lang, code, n) over all texts of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for cut in slices(batch, 1 << 20):
                code, bounds = grams(cut.column("text").to_pylist())
                langs = cut.column("lang").dictionary_encode()
                owner = np.repeat(langs.indices.to_numpy(), np.diff(bounds))
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    found, n = np.unique(code[owner == i], return_counts=True)
                    if lang in total:
                        both = np.concatenate([total[lang][0], found])
                        found, back = np.unique(both, return_inverse=True)
                        n = np.bincount(back, np.concatenate([total[lang][1], n])).astype(np.int64)
                    total[lang] = found, n
        for lang, (found, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    counted = needed(train, "lang", "text").mapInArrow(run, "lang string, code int, n bigint")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


class KneserNey:
    """The models of a block of languages, from their rows of ``statistics``."""

    def __init__(self, stats: pd.DataFrame):
        self.langs = sorted(stats["lang"].unique())
        place = {lang: i for i, lang in enumerate(self.langs)}
        n_langs = len(self.langs)
        self.codes: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.weight: list[np.ndarray] = []
        for order in range(1, ORDER + 1):
            s = stats[stats["k"] == order]
            col = s["lang"].map(place).to_numpy()
            codes, row = np.unique(s["code"].to_numpy(np.int64), return_inverse=True)
            contexts, crow = np.unique(s["code"].to_numpy(np.int64) >> BITS, return_inverse=True)
            total, weight = s["total"].to_numpy(float), np.ones((len(contexts), n_langs))
            weight[crow, col] = (s["discount"] * s["types"]).to_numpy() / total
            p = np.zeros((len(codes), n_langs))
            p[row, col] = np.maximum(s["n"].to_numpy(float) - s["discount"].to_numpy(), 0) / total
            at = np.searchsorted(contexts, codes >> BITS)
            p += weight[at] * (np.exp(self.of(codes & ((1 << BITS * (order - 1)) - 1), order - 1)) if order > 1 else 1 / CLASSES)
            self.codes.append(codes)
            self.logp.append(np.log(p))
            self.contexts.append(contexts)
            self.weight.append(np.log(weight))

    def of(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probabilities of n-gram codes, one column for each language; unseen ones back off."""
        known, out = self.codes[order - 1], np.empty((len(codes), len(self.langs)))
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        seen = known[at] == codes
        out[seen] = self.logp[order - 1][at[seen]]
        if not seen.all():
            rest = codes[~seen]
            contexts = self.contexts[order - 1]
            c = np.minimum(np.searchsorted(contexts, rest >> BITS), len(contexts) - 1)
            weight = np.where((contexts[c] == rest >> BITS)[:, None], self.weight[order - 1][c], 0)
            lower = self.of(rest & ((1 << BITS * (order - 1)) - 1), order - 1) if order > 1 else -np.log(CLASSES)
            out[~seen] = weight + lower
        return out


def statistics(counts: DataFrame) -> DataFrame:
    """(lang, k, code, n, total, types, discount) for each order k from the order-4 counts."""
    levels = [counts.withColumn("k", F.lit(ORDER))]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("code").bitwiseAND(F.lit((1 << BITS * order) - 1))
        levels.append(levels[-1].groupBy("lang", shorter.alias("code")).agg(F.count("*").alias("n")).withColumn("k", F.lit(order)))
    out = None
    for level in levels:
        contexts = level.groupBy("lang", F.shiftright("code", BITS).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        ones, twos = F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1))
        d = level.groupBy("lang").agg(F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.75).alias("discount"))
        row = (level.withColumn("context", F.shiftright("code", BITS)).join(contexts, ["lang", "context"]).join(d, "lang")
               .select("lang", "k", "code", "n", "total", "types", "discount"))
        out = row if out is None else out.unionByName(row)
    return out


class Models:
    """The stored statistics of all languages, and the blocks they are scored in."""

    def __init__(self, counts: DataFrame, block_languages: int, block_codes: int):
        self.statistics = stored(statistics(counts), "language-statistics")
        self.blocks: list[list[str]] = []
        room = 0
        # a name and a number for each language
        for r in self.statistics.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").toLocalIterator():
            if not self.blocks or len(self.blocks[-1]) >= block_languages or r.n > room:
                self.blocks.append([])
                room = block_codes
            self.blocks[-1].append(r.lang)
            room -= r.n

    def block(self, langs: list[str]) -> KneserNey:
        return KneserNey(self.statistics.where(F.col("lang").between(langs[0], langs[-1])).toPandas())


def train(rows: DataFrame, block_languages: int = BLOCK_LANGUAGES, block_codes: int = BLOCK_CODES) -> Models | None:
    """Models from all rows of (lang, text); None if there are none."""
    counts = stored(count_grams(rows.where("lang is not null and text is not null")), "language-counts")
    return None if counts.isEmpty() else Models(counts, block_languages, block_codes)


def _block_scores(docs: DataFrame, model: KneserNey, keep: list[str]) -> DataFrame:
    """``keep`` and the best language of a block, its log-likelihood, the log of the sum of all likelihoods, and the symbols."""
    fields = docs.select(*[docs[c] for c in keep]).schema
    names = [*keep, "best", "likelihood", "mass", "symbols"]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        row_of = np.full(1 << BITS * ORDER, -1, np.int32)
        row_of[m.codes[-1]] = np.arange(len(m.codes[-1]), dtype=np.int32)
        logp = m.logp[-1].astype(np.float32)
        for batch in batches:
            for cut in slices(batch, 1 << 20):
                n = cut.num_rows
                best, top, mass = np.full(n, None, object), np.full(n, np.nan), np.full(n, np.nan)
                code, bounds = grams([t or "" for t in cut.column("text").to_pylist()])
                size = np.diff(bounds)
                some = np.flatnonzero(size)
                ll = np.zeros((len(some), len(m.langs)))
                at = row_of[code]
                new = np.flatnonzero(at < 0)
                p_new = m.of(code[new].astype(np.int64)) if len(new) else None
                start = bounds[:-1][some]
                for j in range(len(m.langs)):
                    p = logp[at, j].astype(np.float64)
                    if len(new):
                        p[new] = p_new[:, j]
                    if len(some):
                        ll[:, j] = np.add.reduceat(p, start)
                which = ll.argmax(1)
                top[some] = ll[np.arange(len(some)), which]
                best[some] = np.array(m.langs, object)[which]
                mass[some] = top[some] + np.log(np.exp(ll - top[some][:, None]).sum(1))
                none = np.isnan(top)
                yield pa.RecordBatch.from_arrays([*[cut.column(c) for c in keep], pa.array(best, pa.string()), pa.array(top, mask=none), pa.array(mass, mask=none),
                                                  pa.array(size.astype(np.int64))], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.select(*[docs[c] for c in keep], docs["text"]).mapInArrow(run, f"{kinds}, best string, likelihood double, mass double, symbols bigint")


def score(docs: DataFrame, models: Models | None, keep: list[str]) -> DataFrame:
    """``keep``, lang_pred, score and cross_entropy (nats per symbol) of each whole text."""
    kept = [docs[c] for c in keep]
    if models is None:
        nothing = F.lit(None).cast("double").alias("cross_entropy")
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), nothing)
    if len(models.blocks) == 1:
        found = _block_scores(docs, models.block(models.blocks[0]), keep).withColumn("masses", F.array("mass"))
    else:
        numbered = stored(docs.select(*kept, docs["text"], F.monotonically_increasing_id().alias("row")), "language-texts")
        parts = None
        for langs in models.blocks:  # one block's model is in use at a time
            part = stored(_block_scores(numbered, models.block(langs), ["row"]), "language-block-scores")
            parts = part if parts is None else parts.unionByName(part)
        # blocks follow the names, so the first of equal likelihoods has the least name
        by = parts.groupBy("row").agg(F.min(F.struct((-F.col("likelihood")).alias("cost"), F.coalesce("best", F.lit("")).alias("name"), "best", "likelihood", "symbols")).alias("b"),
                                      F.collect_list("mass").alias("masses"))
        found = numbered.drop("text").join(by.select("row", "b.best", "b.likelihood", "b.symbols", "masses"), "row")
    all_of = F.aggregate("masses", F.lit(0.0), lambda total, m: total + F.exp(m - F.col("likelihood")))
    return found.select(*keep, F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"), F.when(F.col("symbols") > 0, 1.0 / all_of).otherwise(0.0).alias("score"),
                        F.when(F.col("symbols") > 0, -F.col("likelihood") / F.col("symbols")).alias("cross_entropy"))


def with_rejection(scored: DataFrame, own: str = "lang", held_out: str = "held_out") -> DataFrame:
    """Add ``rejected``, calibrated on the stored scores of the training rows."""
    right = scored.where(~F.col(held_out) & (F.col(own) == F.col("lang_pred")))
    limit = right.groupBy("lang_pred").agg(F.percentile_approx("cross_entropy", ACCEPT_PERCENT / 100, 10_000).alias("limit"))
    out = scored.join(small_side(stored(limit, "language-limits")), "lang_pred", "left")
    return out.withColumn("rejected", F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(True))).drop("limit")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    out = F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % 4 == 2
    small_batches(docs)
    rows = needed(docs, "doc_id", "text", "lang").withColumn("held_out", out)
    models = train(rows.where("not held_out"))
    scored = stored(score(rows, models, ["doc_id", "held_out", "lang"]), "language-scores")
    return with_rejection(scored).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")
