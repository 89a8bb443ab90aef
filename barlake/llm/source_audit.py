"""Source divergence audit by one-hot level products.

Terms are runs of letters (and of all characters beyond ASCII), with A-Z in
lower case.  Each language keeps the terms of at least ``MIN_DOCS`` of its
documents.  A group is a (lang, source); its share of a kept term with count n
is p = 1 + floor(10^9 (n + 1) / (N + V)), for N counts in all of the V kept
terms.  Groups are compared by f(p, q) = floor((p - q)^2 / q).

All terms with the same count in a group, its level, have the same share.  So
the sum of f over all terms needs only the joint table of two groups: how many
terms have level a in one and level b in the other.  With Z as the table of
indicators, a row for each kept term and a column for each (group, level above
0), the products Z'Z hold every joint table.  They are taken in blocks: a block
of terms and a block of sources make a cell, cells of the same terms meet in
pairs, and a task multiplies the indicator matrices of a pair (``TILE`` columns
at a time; entries are counts of at most a block's terms, exact in single
precision).  Spark adds the tables of all blocks.  Level 0, which most terms
have in most groups, needs no column: its counts are what the other levels
leave of the marginals.

Prices are whole numbers throughout: decimals of 38 digits where 63 bits could
be left.  Only sums by term travel: each task counts the terms of its texts
first, so a source, language or term with most of the rows costs each task one
row for a term.  Groups of a language meet each other as the report asks for
all pairs of them; small tables are broadcast only after a count.

Rows: null text, lang and source count as ''.  A row is a document, repeated
ones too.  Groups without terms are reported like others; in a language without
kept terms all values are 0.  Extra columns are not read.  An empty table gives
no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import slices, small_side, stored

MIN_DOCS = 3
TOP_TERMS = 200
#: Terms and sources in a cell, about; columns multiplied at once; terms a task holds before it sends them.
CELL_TERMS, CELL_SOURCES, TILE, HELD = 4096, 64, 1024, 400_000

#: Bytes of terms, A-Z as a-z, and spaces for all others.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, dealt out by (lang, term)."""
    names = ["lang", "source", "term", "n", "docs"]
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for (lang, source), (terms, found) in held.items():
                if terms:
                    same = [pa.array([v] * len(terms), pa.string()) for v in (lang, source)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(list(terms), pa.binary()), pa.array(list(terms.values()), pa.int64()),
                                                      pa.array([found[t] for t in terms], pa.int64())], names)
            held.clear()

        size = 0
        for batch in batches:
            for cut in slices(batch):
                for lang, source, text in zip(*(cut.column(c).to_pylist() for c in ("lang", "source", "text"))):
                    terms, found = held.get((lang, source)) or held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(terms)
                    words = text.translate(_BYTES).split()
                    terms.update(words)
                    found.update(set(words))
                    size += len(terms)
                    if size > HELD:
                        yield from send()
                        size = 0
        yield from send()

    found = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(count, "lang string, source string, term binary, n bigint, docs bigint")
    # tasks have summed their own terms; one exchange serves the sums by group and, in the audit, those by language
    dealt = found.withColumn("term", F.col("term").cast("string")).repartition("lang", "term")
    return dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(10^9 (n + 1) / (total + terms))."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    return F.lit(1) + F.call_function("div", F.lit(1_000_000_000).cast("decimal(12,0)") * (n.cast("decimal(20,0)") + 1), (total + terms).cast("decimal(21,0)"))


def price(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / q)."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """Counts of kept terms, groups and joint tables of a corpus."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        docs = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
        # the term first: rows are sorted by it, and few share its first bytes, while all of a language share theirs
        term = Window.partitionBy("term", "lang")
        every = term.orderBy("source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        counts = term_counts(docs).select("lang", "term", "source", "n", F.sum("n").over(every).alias("lang_n"), F.sum("docs").over(every).alias("docs"),
                                          (F.row_number().over(term.orderBy("source")) == 1).alias("first")).where(F.col("docs") >= min_docs).drop("docs")
        counts = stored(counts, "kept-counts")
        langs = stored(counts.where("first").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")), "languages")
        #: (lang, term, source, n, lang_n, terms, lang_total)
        self.counts = counts.drop("first").join(small_side(langs), "lang")
        totals = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        #: (lang, source, total, terms): every group, with the number of kept terms of its language
        self.groups = stored(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(small_side(langs.drop("lang_total")), "lang", "left")
                             .fillna(0, ["total", "terms"]), "groups")

    def joint_tables(self) -> DataFrame:
        """(lang, source, n, other, other_n, terms): kept terms with these counts, both above 0, for source < other."""
        sources = self.groups.groupBy("lang").agg(F.count("*").alias("sources"))
        dealt = lambda name, parts: F.pmod(F.xxhash64(name), F.lit(1) + F.expr(parts)).cast("int")
        cells = (self.counts.join(small_side(stored(sources, "language-sources")), "lang")
                 .groupBy("lang", dealt("term", f"terms div {CELL_TERMS}").alias("block"), dealt("source", f"sources div {CELL_SOURCES}").alias("part"))
                 .agg(F.collect_list(F.struct("term", "source", "n")).alias("c"))
                 .select("lang", "block", "part", *[F.col(f"c.{x}").alias(f"{x}s") for x in ("term", "source", "n")]))
        cells = stored(cells, "level-cells")
        other = cells.select("lang", "block", *[F.col(c).alias(f"other_{c}") for c in ("part", "terms", "sources", "ns")])
        pairs = cells.join(other, ["lang", "block"]).where("part <= other_part")
        schema = "lang string, source string, n bigint, other string, other_n bigint, terms bigint"
        return pairs.mapInArrow(_products, schema).groupBy("lang", "source", "n", "other", "other_n").agg(F.sum("terms").alias("terms"))

    def pair_values(self) -> DataFrame:
        """(lang, source, item, value): for each group and each other source, f summed over all kept terms."""
        groups = self.groups.withColumn("zero", F.when(F.col("terms") > 0, share(F.lit(0), "total", "terms")))
        groups = stored(groups, "group-shares")
        side = lambda name: small_side(groups.select("lang", *[F.col(c).alias(f"{name}_{c}") for c in ("source", "total", "zero")], F.col("terms").alias(f"{name}_terms")))
        exact = lambda c: c.cast("decimal(38,0)")
        pairs = side("g").join(side("h"), "lang").where("g_source <> h_source")
        named = lambda value: (F.col("g_source").alias("source"), F.col("h_source").alias("item"), exact(value).alias("value"))
        nothing = price("g_zero", "h_zero")
        parts = [pairs.select("lang", *named(F.coalesce(exact(nothing) * F.col("g_terms"), F.lit(0))))]
        levels = stored(self.counts.groupBy("lang", "source", "n").agg(F.count("*").alias("m")), "levels")
        of = lambda name: levels.withColumnRenamed("source", f"{name}_source").join(pairs, ["lang", f"{name}_source"])
        own = share("n", "g_total", "g_terms")
        parts.append(of("g").select("lang", *named(exact(price(own, F.col("h_zero")) - nothing) * F.col("m"))))
        its = share("n", "h_total", "h_terms")
        parts.append(of("h").select("lang", *named(exact(price(F.col("g_zero"), its) - nothing) * F.col("m"))))
        joint = stored(self.joint_tables(), "joint-tables")
        turned = joint.select("lang", F.col("other").alias("source"), F.col("other_n").alias("n"), F.col("source").alias("other"), F.col("n").alias("other_n"), "terms")
        both = (joint.unionByName(turned).withColumnsRenamed({"source": "g_source", "other": "h_source", "terms": "m"})
                .join(side("g"), ["lang", "g_source"]).join(side("h"), ["lang", "h_source"])
                .withColumns({"p": share("n", "g_total", "g_terms"), "q": share("other_n", "h_total", "h_terms")}))
        more = exact(price("p", "q")) - price("p", "h_zero") - price("g_zero", "q") + nothing
        parts.append(both.select("lang", *named(more * F.col("m"))))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))

    def term_values(self) -> DataFrame:
        """(lang, source, item, value): terms that a group has more of than its language."""
        groups = small_side(self.groups.select("lang", "source", "total"))
        priced = self.counts.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total", "terms"), "q": share("lang_n", "lang_total", "terms")})
        return priced.where("p > q").select("lang", "source", F.col("term").alias("item"), price("p", "q").alias("value"))

    def report(self, top: int = TOP_TERMS) -> DataFrame:
        """(lang, source, part, item, value, rank)."""
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
        pairs = self.pair_values().withColumn("rank", rank)
        terms = self.term_values().withColumn("rank", rank).where(F.col("rank") <= top)
        columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        return columns(pairs, "pair").unionByName(columns(terms, "term"))


class _Levels:
    """The columns (source, level) of a cell, and its indicator matrix by tiles; ``row``: the number of each entry's term."""

    def __init__(self, row: np.ndarray, sources: pa.Array, ns: pa.Array):
        n = ns.to_numpy(zero_copy_only=False)
        named = sources.dictionary_encode()
        code = named.indices.to_numpy(zero_copy_only=False)
        self.names = named.dictionary
        order = np.lexsort((n, code))
        c, m = code[order], n[order]
        new = np.concatenate([[True], (c[1:] != c[:-1]) | (m[1:] != m[:-1])])
        column = np.empty(len(code), np.int64)
        column[order] = np.cumsum(new) - 1
        self.code, self.n = c[new], m[new]
        by = np.argsort(column, kind="stable")
        self.row, self.column = row[by], column[by]

    def tiles(self, height: int) -> Iterator[tuple[int, np.ndarray]]:
        for at in range(0, len(self.n), TILE):
            i, j = np.searchsorted(self.column, [at, at + TILE])
            z = np.zeros((height, min(TILE, len(self.n) - at)), np.float32)
            z[self.row[i:j], self.column[i:j] - at] = 1
            yield at, z


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joint tables of each pair of cells: products of their indicator matrices."""
    names = ["lang", "source", "n", "other", "other_n", "terms"]
    for batch in batches:
        for k in range(batch.num_rows):
            values = [[batch.column(f"{side}{c}")[k].values for c in ("terms", "sources", "ns")] for side in ("", "other_")]
            rows = pa.concat_arrays([values[0][0], values[1][0]]).dictionary_encode()
            height, row = len(rows.dictionary), rows.indices.to_numpy(zero_copy_only=False)
            cut = len(values[0][0])
            cell = [_Levels(row[:cut], *values[0][1:]), _Levels(row[cut:], *values[1][1:])]
            same = batch.column("part")[k].as_py() == batch.column("other_part")[k].as_py()
            for at, z in cell[0].tiles(height):
                for other_at, other in cell[1].tiles(height):
                    if same and other_at < at:  # there the product is the other's transpose
                        continue
                    table = z.T @ other
                    i, j = np.nonzero(table)
                    terms = table[i, j].astype(np.int64)
                    i, j = i + at, j + other_at
                    a, b = (c.names.take(pa.array(c.code[x])) for c, x in zip(cell, (i, j)))
                    m, n = cell[0].n[i], cell[1].n[j]
                    # each pair of sources once, the lesser name first; a tile on the diagonal has both
                    less, more = (pc.less(x, y).to_numpy(zero_copy_only=False) for x, y in ((a, b), (b, a)))
                    if same and at == other_at:
                        more[:] = False
                    x, y = np.flatnonzero(less), np.flatnonzero(more)
                    if len(x) + len(y) == 0:
                        continue
                    pick = lambda first, second: pa.concat_arrays([first.take(pa.array(x)), second.take(pa.array(y))])  # noqa: B023, E731
                    lang = pa.array([batch.column("lang")[k].as_py()] * (len(x) + len(y)), pa.string())
                    yield pa.RecordBatch.from_arrays([lang, pick(a, b), pa.array(np.concatenate([m[x], n[y]])), pick(b, a),
                                                      pa.array(np.concatenate([n[x], m[y]])), pa.array(np.concatenate([terms[x], terms[y]]))], names)


def audit(docs: DataFrame) -> DataFrame:
    return Audit(docs).report()
