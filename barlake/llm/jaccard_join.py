"""Similarity join on Jaccard distance, a metric: links of distance 0.15 at most, and their components.

A document's set holds its distinct 4-word shingles as 64-bit hashes.  Equal
sets are collapsed first; what follows works on distinct sets.  ``words`` and
``percent`` set another length of shingles and another least similarity; the
figures here are those of the defaults.

Regions.  Pivots drawn from the corpus can't cut a corpus of texts by
themselves: a text shares nothing with almost any pivot, all its distances are
1 and no triangle inequality separates it from anything.  So the first regions
come from a bound that all close sets meet.  Two sets with a link and at most
m shingles differ in k = 30 m div 185 shingles at most.  With shingles dealt
to more than k buckets by hash, some bucket holds the same shingles in both;
its hash is a key they share.  Both sizes must use one bucket count, so sizes
fall in classes, and a set near a class border is replicated to the next one.
Only buckets of two shingles or more give keys, and shingles of which the
corpus has very many are left out (whichever they are, the bound holds).  So
that a shared bucket is one that gives a key, buckets are more than k + 1; a
set whose weak buckets outnumber the surplus also sends the 15 % least of its
shingles, frequent ones last, as two linked sets share one of these.  Sets
that share a key are tied to the least of them, in each task first; a region
is a component of these ties.  No link leaves its region.

The larger the corpus, the more of these ties are chance, and chains of them
grow into regions of sets that have nothing in common.  A large region is cut
again by the shingles that few of its sets hold: a set that shares none of its
rarest has no link, and goes.

Inside a region, pivots do the work.  A large region takes pivots from its
sets; each set goes to the Voronoi cell of its nearest pivot, and to each cell
whose pivot is at most two link distances farther, so that both ends of a link
meet in the home cell of either.  Sets within the link distance of a pivot are
linked to it; a pivot has then met all sets of its region and goes no further,
and a region whose other sets are one component is done.  The cells are
regions again.  A cell that is not smaller than its region is cut
into blocks: each set outside the largest component meets every set.  A region
that fits a task is joined there, again by pivots: one pivot after another is
compared with all sets, and sets whose distances to some pivot differ by more
than the link distance are never compared.

Distances are compared as integers: 100 * shared >= 85 * united.  Different
shingles count as equal with odds of 2^-64 a pair, and so do different sets.

Rows: a null text or one without words has the empty set, n_shingles 0, and is
linked with nothing (its component_id is its doc_id).  Fewer than four words
are one shingle.  Repeated rows and doc_ids are members like any other: a
doc_id with several texts gets a row for each; component_id is the least
doc_id (null only if all are null).  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import fresh, give_back, needed, slices, small_batches, small_side, stored, texts_of
from barlake.llm.graph import components

WORDS = 4
PERCENT = 85
#: Shingles of a region that one task joins (8 bytes each).
LEAF = 1 << 20
#: Pivots of a larger region in each step.
PIVOTS = 4
#: Shingles that make up more than this share of the documents' number are left out of keys, the
#: HOT_MOST most frequent of them (1 MB); this only steers the choice of keys.
HOT_SHARE, HOT_MOST = 0.0005, 1 << 17
#: Keys in a bucket of the key shuffle, about, and keys a task gathers before it sends them.
BUCKET_KEYS, GATHER = 500_000, 500_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of n words of all texts together, the words' hashes, and each text's first and last word."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    hashed = np.fromiter((xxhash.xxh64_intdigest(w.encode().lower()) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    w = hashed[coded.indices.to_numpy()]
    all_ = np.zeros(max(len(w) - n + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n if len(all_) else 0):
            all_ = _mix(all_ * _A + w[i:len(w) - n + 1 + i])
    return all_, w, bounds[:-1], bounds[1:]


def shingle_sets(texts: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    all_, w, first, last = shingles(texts, n)
    out = []
    for a, b in zip(first, last):
        if b - a >= n:
            out.append(np.unique(all_[a:b - n + 1]))
        else:
            h = np.full(1, b - a, np.uint64)
            with np.errstate(over="ignore"):
                for x in w[a:b]:
                    h = _mix(h * _A + x)
            out.append(h if b > a else h[:0])
    return out


def hot_shingles(docs: DataFrame, n_docs: int, share: float = HOT_SHARE, words: int = WORDS) -> np.ndarray:
    """The most frequent shingles, sorted.  Each slice of texts reports those it holds three times or more.

    One that is spread thinner than that stays in the keys, which costs ties and no link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for cut in slices(got):
                found, n = np.unique(shingles(texts_of(cut), words)[0], return_counts=True)
                found, n = found[n > 2], n[n > 2]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["h", "n"])

    counts = docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") > max(n_docs * share, 8)).orderBy(F.desc("n"), "h").limit(HOT_MOST).select("h").collect()
    return np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def set_key(s: np.ndarray) -> int:
    """A 63-bit hash of a set."""
    return xxhash.xxh64_intdigest(s.tobytes()) >> 1


def _size_classes() -> np.ndarray:
    """First sizes of the classes: 1, 2, 3, ..., then by a fifth."""
    first = [1]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, first[-1] * 6 // 5))
    return np.array(first)


CLASSES = _size_classes()


def buckets_of(cls: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in which linked sets of a class may differ, and its number of buckets (0: only equal sets link)."""
    differ = 2 * (100 - percent) * (CLASSES[cls + 1] - 1) // (100 + percent)
    return differ, np.where(differ > 0, differ + 7 + differ // 4, 0)


def region_keys(sets: list[np.ndarray], hot: np.ndarray = np.zeros(0, np.uint64), percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``sets``, key) such that sets with a link share a key."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    own = np.searchsorted(CLASSES, np.maximum(size, 1), side="right") - 1
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    rare = ~_among(flat, hot)
    token, holder = flat[rare], np.repeat(np.arange(len(sets)), size)[rare]
    mixed = _mix(token + _A)
    low, high = (mixed & np.uint64(0xFFFFFFFF)).astype(float), (mixed >> np.uint64(32)).astype(float)
    places, keys, irregular = [], [], np.zeros(len(sets), bool)
    cls = own
    while True:
        use = (size > 0) & (100 * size >= percent * CLASSES[cls])  # higher classes only near the border
        if not use.any():
            break
        differ, n = buckets_of(cls, percent)
        # a set is linked with none larger than the class, nor than itself by more than the least similarity allows
        differ = np.minimum(differ, (100 - percent) * (size + np.minimum(CLASSES[cls + 1] - 1, 100 * size // percent)) // (100 + percent))
        n = np.where(use, n, 0)
        first, total = np.cumsum(n) - n, int(n.sum())
        rows = n[holder]
        inside = rows > 0
        at = first[holder[inside]] + ((token[inside] >> np.uint64(20)) % rows[inside].astype(np.uint64)).astype(np.int64)
        strong = np.bincount(at, minlength=total) > 1
        who = np.repeat(np.arange(len(sets)), n)
        sums = [np.bincount(at, half[inside], total).astype(np.uint64) for half in (low, high)]
        with np.errstate(over="ignore"):
            tag = np.repeat(cls, n).astype(np.uint64) * _C + (np.arange(total) - np.repeat(first, n)).astype(np.uint64)
            key = _mix(_mix(sums[0] * _A + sums[1]) + tag * _B)
        places.append(who[strong])
        keys.append(key[strong])
        weak = np.bincount(who[~strong], minlength=len(sets))
        irregular |= (n > 0) & (weak >= n - differ)
        cls = cls + 1
    for i in np.flatnonzero(irregular):
        frequent = _among(sets[i], hot)
        order = np.concatenate([sets[i][~frequent], sets[i][frequent]])
        least = _mix(order[: len(order) - -(-percent * len(order) // 100) + 1] + _C)
        places.append(np.full(len(least), i))
        keys.append(least)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(keys)


def _ties(key: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each key with the least set that has it, and ties of the others to it."""
    order = np.lexsort((who, key))
    key, who = key[order], who[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    first = who[new]
    least = np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(key))))
    other = who != least
    pairs = np.unique(np.stack([who[other], least[other]]), axis=1)
    return key[new], first, pairs[0], pairs[1]


MEMBER = "doc_id bigint, th bigint, n bigint, set bigint"


def _members_and_ties(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of two kinds: a document with its set's key (doc_id, th, n, set), or a tie of two sets (a, b)."""
    n_docs, chars = docs.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    n_buckets = 1 + int(chars * 0.08 * (100 - percent) / (100 - PERCENT)) // BUCKET_KEYS
    hot = docs.sparkSession.sparkContext.broadcast(hot_shingles(docs, n_docs, words=words))
    names = ["bucket", "keys", "sets", "a", "b", "doc_id", "th", "n", "set"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 6]

    def batch(rows: int, /, **given) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(given[c], k) if c in given else pa.nulls(rows, k) for c, k in zip(names, kinds)], names)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, whos, held = [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            key, who, a, b = _ties(np.concatenate(keys), np.concatenate(whos))
            for x in (keys, whos, seen):
                x.clear()
            if len(a):
                yield batch(len(a), bucket=(a % n_buckets).astype(np.int32), a=a, b=b)
            to = (key >> np.uint64(33)) % np.uint64(n_buckets)
            order = np.argsort(to, kind="stable")
            key, who, to = key[order], who[order], to[order]
            cut = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]])
            pairs = [(i, j) for i, j in zip(cut[:-1], cut[1:]) if j > i]
            yield batch(len(pairs), bucket=[int(to[i]) for i, _ in pairs], keys=[key[i:j].tobytes() for i, j in pairs], sets=[who[i:j].tobytes() for i, j in pairs])

        for got in batches:
            for cut in slices(got):
                sets = shingle_sets(texts_of(cut), words)
                ids = np.fromiter(map(set_key, sets), np.int64, len(sets))
                yield batch(len(sets), bucket=(ids % n_buckets).astype(np.int32), doc_id=cut.column("doc_id"), th=cut.column("th"), n=[len(s) for s in sets], set=ids)
                new = [i for i, x in enumerate(ids.tolist()) if x not in seen and not seen.add(x)]
                place, key = region_keys([sets[i] for i in new], hot.value, percent)
                keys.append(key)
                whos.append(ids[new][place] if len(new) else ids[:0])
                held += len(key)
                if held > GATHER:
                    yield from send()
                    held = 0
        if keys:
            yield from send()

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, whos = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if keys:
                _, _, a, b = _ties(np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(whos), np.int64))
                keys.clear()
                whos.clear()
                if len(a):
                    yield batch(len(a), a=a, b=b)

        for got in batches:
            plain = got.filter(pc.is_null(got.column("keys")))
            if plain.num_rows:
                yield plain
            packed = got.filter(pc.is_valid(got.column("keys")))
            for bucket, k, w in zip(packed.column("bucket").to_pylist(), packed.column("keys"), packed.column("sets")):
                if bucket != now:
                    yield from close()
                    now = bucket
                keys.append(k.as_py())
                whos.append(w.as_py())
        yield from close()
        give_back()

    schema = f"bucket int, keys binary, sets binary, a bigint, b bigint, {MEMBER}"
    # a task of the shuffle takes its buckets one after another, so their number doesn't set the number of tasks
    sent = docs.mapInArrow(sketch, schema).repartition("bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(tie, schema).drop("bucket", "keys", "sets")


def _linked(shared: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (a + b - shared)


class _Components:
    """Labels of components; of two that meet, the smaller one is relabelled."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members: dict[int, list[np.ndarray]] = {}

    def _of(self, c: int) -> list[np.ndarray]:
        return self.members.get(c) or [np.array([c])]

    def tie(self, x: int, others: np.ndarray) -> None:
        for c in np.unique(self.label[others]):
            mine = self.label[x]
            if c != mine:
                one, two = self._of(int(mine)), self._of(int(c))
                if sum(map(len, one)) < sum(map(len, two)):
                    mine, c, one, two = c, mine, two, one
                moved = np.concatenate(two)
                self.label[moved] = mine
                self.members[int(mine)] = [*one, moved]
                self.members.pop(int(c), None)


#: Sets of a leaf whose distances to all others are taken first.
LEAF_PIVOTS = 8


def join_sets(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(id, least id of its component) for all sets but the least ones: an exact join by pivots.

    A few pivots are compared with all sets.  Two other sets are compared only
    if they are in different components yet, no pivot separates them, and they
    share one of their rarest shingles: with all shingles ordered by how many
    sets hold them, linked sets share one of the first n - ceil(share n) + 1.
    """
    n = len(ids)
    size = np.fromiter(map(len, sets), np.int64, n)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.bincount(token)
    rarity = np.empty(len(held), np.int64)
    rarity[np.argsort(held, kind="stable")] = np.arange(len(held))
    owner = np.repeat(np.arange(n), size)
    order = np.lexsort((rarity[token], owner))
    token = token[order]  # a set's shingles, rarest first
    own = np.concatenate([[0], np.cumsum(size)])
    first = size + (-percent * size) // 100 + 1
    leading = np.arange(len(token)) - own[owner] < first[owner]
    leading &= held[token] > 1
    by = np.argsort(token[leading], kind="stable")
    lead_token, lead_owner = token[leading][by], owner[leading][by]
    start = np.searchsorted(lead_token, np.arange(len(held) + 1))
    lead_own = np.searchsorted(owner[leading], np.arange(n + 1))
    lead_tokens = token[leading]
    found, mark = _Components(n), np.zeros(len(held), bool)
    far: list[np.ndarray] = []
    reach = (100 - percent) / 100 + 1e-9

    def shared_with(p: int, others: np.ndarray) -> np.ndarray:
        mine = token[own[p]:own[p + 1]]
        mark[mine] = True
        ends = np.cumsum(size[others])
        hits = mark[token[np.arange(ends[-1]) + np.repeat(own[others] - (ends - size[others]), size[others])]]
        mark[mine] = False
        return np.add.reduceat(hits.astype(np.int64), ends - size[others])

    everyone = np.arange(n)
    for p in range(min(LEAF_PIVOTS, n)):
        shared = shared_with(p, everyone)
        far.append(1 - shared / (size + size[p] - shared))
        found.tie(p, everyone[_linked(shared, size, size[p], percent)])
    for p in np.flatnonzero(np.diff(lead_own)):
        t = lead_tokens[lead_own[p]:lead_own[p + 1]]
        others = np.concatenate([lead_owner[start[x]:start[x + 1]] for x in t])
        others = others[(others > p) & (found.label[others] != found.label[p])]
        if len(others):
            others = np.unique(others)
            near = 100 * np.minimum(size[others], size[p]) >= percent * np.maximum(size[others], size[p])
            for d in far:
                near &= np.abs(d[others] - d[p]) <= reach
            others = others[near]
        if len(others):
            found.tie(p, others[_linked(shared_with(p, others), size[others], size[p], percent)])
    comp = found.label
    order = np.lexsort((ids, comp))
    new = np.concatenate([[True], comp[order[1:]] != comp[order[:-1]]])
    least = np.repeat(ids[order[new]], np.diff(np.append(np.flatnonzero(new), n)))
    other = ~new
    return ids[order[other]], least[other]


def _leaf_links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links from (region, id, shingles); a region fits a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, held, a, b = None, [], [], [], []

        def close() -> None:
            if len(ids) > 1:
                x, y = join_sets(np.array(ids), held, percent)
                a.append(x)
                b.append(y)
            ids.clear()
            held.clear()

        for got in batches:
            for region, i, s in zip(got.column("region").to_pylist(), got.column("id").to_pylist(), got.column("shingles")):
                if region != now:
                    close()
                    now = region
                if not ids or ids[-1] != i:  # a set can come to a block twice
                    ids.append(i)
                    held.append(np.frombuffer(s.as_py(), np.uint64))
        close()
        give_back()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return sets.select("region", "id", "shingles").repartition("region").sortWithinPartitions("region", "id").mapInArrow(run, "a bigint, b bigint")


def _cells(big: DataFrame, pivots: int, percent: int, leaf: int) -> DataFrame:
    """(region, id, n, shingles, pivot, cells, linked): distances to the pivots of the region decide.

    A region is cut into blocks of about a leaf; its pivots come to each block once, ahead of its sets.
    """
    blocks = F.expr(f"1 + weight div {leaf}")
    row = ["region", "block", "kind", "id", "n", "shingles"]
    chosen = big.withColumn("r", F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("id"), "id"))).where(F.col("r") <= pivots)
    ahead = chosen.select("region", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"), F.lit(0).alias("kind"), "id", "n", "shingles")
    members = big.select("region", F.pmod(F.xxhash64("id", F.lit(3)), blocks).alias("block"), F.lit(1).alias("kind"), "id", "n", "shingles")
    two = 2 * (100 - percent) / 100 + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, held = None, [], []
        for got in batches:
            keep, pivot, cells, linked = [], [], [], []
            for k, (region, block, kind, i, s) in enumerate(zip(*(got.column(c).to_pylist() for c in ("region", "block", "kind", "id")), got.column("shingles"))):
                x = np.frombuffer(s.as_py(), np.uint64)
                if kind == 0:
                    if now != (region, block):
                        now, names, held = (region, block), [], []
                    names.append(i)
                    held.append(x)
                    continue
                sizes = np.fromiter(map(len, held), np.int64, len(held))
                shared = np.array([len(np.intersect1d(x, p, assume_unique=True)) for p in held])
                d = 1 - shared / (len(x) + sizes - shared)
                keep.append(k)
                pivot.append(i in names)
                cells.append(np.flatnonzero(d <= d.min() + two).tolist())
                linked.append([p for p, hit in zip(names, _linked(shared, len(x), sizes, percent)) if hit])
            own = got.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[own.column(c) for c in ("region", "id", "n", "shingles")], pa.array(pivot, pa.bool_()), pa.array(cells, pa.list_(pa.int32())), pa.array(linked, pa.list_(pa.int64()))],
                                             ["region", "id", "n", "shingles", "pivot", "cells", "linked"])

    dealt = ahead.unionByName(members).select(*row).repartition("region", "block").sortWithinPartitions("region", "block", "kind", "id")
    return dealt.mapInArrow(run, "region bigint, id bigint, n bigint, shingles binary, pivot boolean, cells array<int>, linked array<bigint>")


def _dealt(to: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket of ``to``: the bucket, and the bytes of its part of each column."""
    order = np.argsort(to, kind="stable")
    cut = np.flatnonzero(np.diff(to[order], prepend=-1, append=-1)) if len(to) else np.zeros(0, np.int64)
    pairs = list(zip(cut[:-1], cut[1:]))
    packed = [pa.array([c[order[i:j]].tobytes() for i, j in pairs], pa.binary()) for c in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array([int(to[order[i]]) for i, _ in pairs], pa.int32()), *packed], ["bucket", *columns])


def _by_bucket(batches: Iterator[pa.RecordBatch], **kinds: type) -> Iterator[list[np.ndarray]]:
    """The columns of each bucket, from rows of ``_dealt`` that are sorted by bucket."""
    now, held = None, [[] for _ in kinds]
    joined = lambda: [np.frombuffer(b"".join(x), kind) for x, kind in zip(held, kinds.values())]
    for got in batches:
        for i, bucket in enumerate(got.column("bucket").to_pylist()):
            if bucket != now and held[0]:
                yield joined()
                held = [[] for _ in kinds]
            now = bucket
            for x, name in zip(held, kinds):
                x.append(got.column(name)[i].as_py())
    if held[0]:
        yield joined()
    give_back()


def _rare_keys(big: DataFrame, percent: int, shingles: int) -> DataFrame:
    """(key, id): the shingles by which a set of (region, id, n, shingles) can be linked within its region.

    With the shingles of a region ordered by how many of its sets hold them,
    linked sets share one of the first n - ceil(share n) + 1, and no set shares
    one that it holds alone.  ``shingles`` is the number of all.
    """
    buckets = 1 + shingles // BUCKET_KEYS

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            part = np.cumsum(got.column("n").to_numpy(zero_copy_only=False)) // GATHER
            for x in np.unique(part):
                cut = got.take(pa.array(np.flatnonzero(part == x)))
                sets = [np.frombuffer(s.as_py(), np.uint64) for s in cut.column("shingles")]
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                with np.errstate(over="ignore"):  # the same shingle has another key in each region
                    key = _mix(np.concatenate(sets) + np.repeat(_mix(cut.column("region").to_numpy(zero_copy_only=False).astype(np.uint64) + _A), size))
                whose = np.repeat(cut.column("id").to_numpy(zero_copy_only=False), size)
                yield _dealt(((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32), keys=key, ids=whose, sizes=np.repeat(size, size).astype(np.uint32))

    def held_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, whose, size in _by_bucket(batches, keys=np.uint64, ids=np.int64, sizes=np.uint32):
            order = np.lexsort((whose, key))
            key, whose, size = key[order], whose[order], size[order]
            once = np.concatenate([[True], (key[1:] != key[:-1]) | (whose[1:] != whose[:-1])])  # a set can come twice
            key, whose, size = key[once], whose[once], size[once]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.diff(np.append(first, len(key)))
            count = np.repeat(count, count)
            more = count > 1
            key, whose, size, count = key[more], whose[more], size[more], count[more]
            yield _dealt((whose % buckets).astype(np.int32), keys=key, ids=whose, sizes=size, counts=count.astype(np.uint32))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, whose, size, count in _by_bucket(batches, keys=np.uint64, ids=np.int64, sizes=np.uint32, counts=np.uint32):
            order = np.lexsort((key, count, whose))
            key, whose, size = key[order], whose[order], size[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]])) if len(whose) else np.zeros(0, np.int64)
            shared = np.diff(np.append(first, len(whose)))
            place = np.arange(len(whose)) - np.repeat(first, shared)
            leading = place < size + (-percent * size) // 100 + 1 - (size - np.repeat(shared, shared))
            yield pa.RecordBatch.from_arrays([pa.array(key[leading].view(np.int64)), pa.array(whose[leading])], ["key", "id"])

    packed = "bucket int, keys binary, ids binary, sizes binary"
    for step, schema in ((deal, packed), (held_by, f"{packed}, counts binary")):
        big = big.mapInArrow(step, schema).repartition("bucket").sortWithinPartitions("bucket")
    return big.mapInArrow(rarest, "key bigint, id bigint")


def refined(sets: DataFrame, percent: int = PERCENT, leaf: int = LEAF) -> DataFrame:
    """The stored ``sets`` of (region, id, n, shingles, weight) in smaller regions, where these are larger than a leaf.

    The keys of the first regions can be shared by chance, and a chain of such
    ties holds sets together that have nothing in common.  Within a region it
    is known which shingles are rare: only sets that share one of their rarest
    stay together.  Sets that share none have no link and go, which makes other
    shingles rarer, so this is done until the large regions stop shrinking.
    """
    sets, big = sets.where(F.col("weight") <= leaf), sets.where(F.col("weight") > leaf)
    before = big.agg(F.sum("n")).first()[0]
    while before:
        keys = stored(_rare_keys(big, percent, before), "rare-keys")
        least = keys.groupBy("key").agg(F.min("id").alias("b"))
        ties = keys.withColumnRenamed("id", "a").join(least, "key").where("a <> b").select("a", "b")
        tied = stored(components(ties), "refined-regions")
        roots = tied.select(F.col("root").alias("id"), F.col("root").alias("region")).distinct()
        finer = small_side(tied.select("id", F.col("root").alias("region")).unionByName(roots))
        big = stored(_weighed(big.select("id", "n", "shingles").join(finer, "id").select("region", "id", "n", "shingles")), "region-sets")
        sets = sets.unionByName(big.where(F.col("weight") <= leaf))
        big = big.where(F.col("weight") > leaf)
        now = big.agg(F.sum("n")).first()[0]
        if not now or now > 0.9 * before:
            break
        before = now
    return sets.unionByName(big)


def region_links(sets: DataFrame, leaf: int = LEAF, pivots: int = PIVOTS, percent: int = PERCENT) -> DataFrame:
    """(a, b) links that tie each component of the stored (region, id, n, shingles, weight) together.

    ``weight`` is the number of shingles of a region.
    """
    links = None
    while True:
        small = stored(_leaf_links(sets.where(F.col("weight") <= leaf), percent), "links")
        links = small if links is None else links.unionByName(small)
        big = sets.where(F.col("weight") > leaf)
        if big.isEmpty():
            return links
        placed = stored(_cells(big, pivots, percent, leaf), "region-cells")
        links = links.unionByName(placed.select(F.col("id").alias("a"), F.explode("linked").alias("b")).where("a <> b"))
        group = components(links)
        # a pivot has met every set of its region and goes, so a region loses members at each level
        named = placed.where("not pivot").join(group, "id", "left").select("region", "id", "n", "shingles", "cells", F.coalesce("root", "id").alias("comp"))
        # what each component weighs in its region; a region of one component is done
        by = named.groupBy("region", "comp").agg(F.sum("n").alias("n"))
        state = by.groupBy("region").agg(F.sum("n").alias("weight"), F.count("*").alias("comps"), F.max(F.struct("n", "comp"))["comp"].alias("main"))
        state = state.where("comps > 1")
        todo = stored(named.join(state, "region"), "regions-open")
        cells = todo.select("region", "id", "n", "shingles", "comp", "main", "weight", F.explode("cells").alias("cell"))
        cells = cells.withColumn("cell_region", F.xxhash64("region", "cell"))
        lighter = cells.groupBy("cell_region").agg(F.sum("n").alias("cell_weight"), F.max("weight").alias("w"))
        flat = cells.join(lighter, "cell_region").withColumn("flat", F.col("cell_weight") > 0.8 * F.col("w"))
        # all cells of a region with a flat one are covered by the region's blocks
        level = stored(flat.groupBy("region").agg(F.max("flat").alias("flat")), "flat-regions")
        onward = cells.join(level.where("not flat"), "region").select(F.col("cell_region").alias("region"), "id", "n", "shingles")
        sets = stored(_weighed(onward.unionByName(_blocks(todo.join(level.where("flat"), "region"), leaf))), "regions")


def _weighed(sets: DataFrame) -> DataFrame:
    """``sets`` with the weight of their region; regions of one member have no link and go."""
    weight = sets.groupBy("region").agg(F.sum("n").alias("weight"), F.count("*").alias("members"))
    return sets.join(weight.where("members > 1").drop("members"), "region")


def _blocks(flat: DataFrame, leaf: int) -> DataFrame:
    """Blocks in which each set outside its region's largest component meets every set of the region."""
    half = max(leaf // 2, 1)
    outer = flat.where("comp <> main").groupBy("region").agg(F.sum("n").alias("outer"))
    counted = flat.join(outer, "region").withColumns({
        "rows": F.expr(f"(weight + {half - 1}) div {half}"), "cols": F.expr(f"(outer + {half - 1}) div {half}")})
    # other places in each region, so that a block still too heavy is cut in another way
    row, col = F.expr("pmod(xxhash64(region, id, 1), rows)"), F.expr("pmod(xxhash64(region, id, 2), cols)")
    as_row = counted.withColumn("r", row).withColumn("c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cols") - 1)))
    as_col = counted.where("comp <> main").withColumn("c", col).withColumn("r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)))
    both = as_row.unionByName(as_col)
    return both.select(F.xxhash64("region", "r", "c").alias("region"), "id", "n", "shingles").dropDuplicates(["region", "id"])


def _with_sets(rows: DataFrame, words: int) -> DataFrame:
    """(region, id, n, shingles, weight) from (region, id, text, weight); a task gives a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for got in batches:
            new = [i for i, x in enumerate(got.column("id").to_pylist()) if x not in seen and not seen.add(x)]
            for cut in slices(got.take(pa.array(new, pa.int64()))):
                sets = shingle_sets(texts_of(cut), words)
                yield pa.RecordBatch.from_arrays(
                    [cut.column("region"), cut.column("id"), pa.array(list(map(len, sets)), pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary()), cut.column("weight")], ["region", "id", "n", "shingles", "weight"])

    return rows.select("region", "id", "text", "weight").mapInArrow(run, "region bigint, id bigint, n bigint, shingles binary, weight bigint")


def similarity_components(docs: DataFrame, leaf: int = LEAF, pivots: int = PIVOTS, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, th, n_shingles, component_id, set, component) of each document; th is the text's hash."""
    small_batches(docs)
    keyed = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    rows = stored(_members_and_ties(keyed, words, percent), "members-and-ties")
    members = rows.where("set is not null").select("doc_id", "th", "n", "set")
    tied = components(rows.where("a is not null").select("a", "b"))
    roots = tied.select(F.col("root").alias("id"), F.col("root").alias("region")).distinct()
    regions = small_side(stored(tied.select("id", F.col("root").alias("region")).unionByName(roots), "regions"))
    # one row stands for each set that has a region
    one = (members.join(regions, members["set"] == regions["id"]).groupBy("region", "id")
           .agg(F.min(F.struct("doc_id", "th")).alias("m"), F.first("n").alias("n"))
           .select("region", "id", "n", F.xxhash64("m.doc_id", "m.th").alias("k")))
    one = small_side(stored(_weighed(one).drop("n"), "region-members"))
    texts = keyed.withColumn("k", F.xxhash64("doc_id", "th")).join(one, "k").select("region", "id", "text", "weight")
    sets = refined(stored(_with_sets(texts, words), "region-sets"), percent, leaf)
    links = region_links(sets, leaf, pivots, percent)
    linked = small_side(stored(components(links), "linked"))
    placed = members.join(linked, members["set"] == linked["id"], "left").select("doc_id", "th", F.col("n").alias("n_shingles"), "set", F.coalesce("root", "set").alias("component"))
    # stored, so that the join is between plain tables: a component of very many members is split over tasks
    least = small_side(stored(placed.groupBy("component").agg(F.min("doc_id").alias("least")), "least-ids"))
    component_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return placed.join(least, "component").select("doc_id", "th", "n_shingles", component_id.alias("component_id"), "set", "component")


def join_digest(docs: DataFrame) -> DataFrame:
    return similarity_components(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the least doc_id, then text hash.

    Rows equal in doc_id and text are one document, of which the first row
    stays.  Documents without words are linked with nothing and stay.
    """
    own = fresh(docs, "row_key")
    found = similarity_components(docs, words=words, percent=percent).select("component", "n_shingles", F.xxhash64("doc_id", "th").alias("k"), F.struct("doc_id", "th").alias("place"))
    by = found.groupBy("component", "k").agg(F.count("*").alias("rows"), F.first("place").alias("place"), F.first("n_shingles").alias("n_shingles"))
    by = stored(by, "component-members")
    chosen = small_side(stored(by.groupBy("component").agg(F.min("place").alias("least")), "chosen"))
    # what has to go, or to be thinned: the keys that are not chosen, and those of several rows
    judged = by.join(chosen, "component").select("k", (F.col("place").eqNullSafe(F.col("least")) | (F.col("n_shingles") == 0)).alias("stays"), "rows")
    judged = stored(judged.where("not stays or rows > 1"), "duplicates")
    keyed = docs.withColumn(own, F.xxhash64(docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"])))
    single = keyed.join(small_side(judged.select(F.col("k").alias(own))), own, "left_anti")
    again = keyed.join(small_side(judged.where("stays").select(F.col("k").alias(own))), own, "left_semi").dropDuplicates([own])
    return single.unionByName(again).select(*[f"`{c}`" for c in docs.columns])
