"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The matrix X has a row for each vector, centred exactly: components are whole
numbers x = floor(64 c) + 1,000,000, so n x - S (S: the sum of a dimension over
the n vectors) is exact, and a row of X is (n x - S) / n.

From a start direction the method takes in turns left directions, u from X v,
and right directions, v from X'u, each made orthogonal to all before it.  In
these bases X is a small bidiagonal matrix, whose singular value decomposition
gives the components (unit eigenvectors of the covariance) and the deviations
along them.  A step is one pass over blocks of rows: each task forms its part
of X v and at once its share of X'(X v); the sums of d numbers come to the
driver.  A left direction has a number for each row of the table, so none is
stored: u = X y for a y of d numbers, and u_i'u_j = y_i'(X'u_j) from numbers at
hand.  Where a step loses too much to rounding it is taken again from its
result, which makes it orthogonal to working precision.  If a direction is
exhausted (beta is 0) a new one, orthogonal to all, goes on, so that d steps
always end with the whole space and equal eigenvalues are all found.

The driver holds a few matrices of d x d; sums over many tasks are added in a
second stage first.  Only matrices of that size are sent out.

Rows: vectors that are null, empty, or have null or non-finite entries take no
part.  Shorter vectors count as ended by zeros.  Rows without vec_id and rows
with repeated ones are rows of their own.  Components without variance (below
10^-12 of the total) are left out, so fewer than ``n_components`` may come;
none, if all vectors are equal.  The sign of a component makes its entry of
largest size positive.  Entries so large that n x leaves 62 bits raise an
error, as does a deviation beyond 63 bits.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import stored

SCALE = 64
N_COMPONENTS = 32
#: Rows in a block of vectors; partial sums that the driver adds at most.
BLOCK_ROWS, PARTIAL_SUMS = 2048, 256
#: Share of the total variance below which a component has none.
NO_VARIANCE = 1e-12


class CentredRows:
    """Blocks of whole-number vectors, their count and sums, and products of the centred matrix."""

    def __init__(self, embeddings: DataFrame):
        e = embeddings["embedding"]
        usable = F.forall(e, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
        kept = embeddings.select(embeddings["vec_id"].cast("bigint").alias("vec_id"), e.alias("v")).where(usable & (F.size(e) > 0))
        largest = F.aggregate("v", F.lit(0.0), lambda a, c: F.greatest(a, F.abs(c.cast("double"))))
        n, dim, top = kept.agg(F.count("*"), F.max(F.size("v")), F.max(largest)).first()
        self.n, self.dim = n, dim or 0
        if not n:
            return
        if SCALE * top * n >= 2.0**61:
            raise ValueError("entries too large for exact sums")
        d = self.dim
        # the constant of x cancels in n x - S, so the blocks leave it out
        whole = kept.select("vec_id", F.transform(F.concat("v", F.array_repeat(F.lit(0.0).cast(kept.schema["v"].dataType.elementType), F.lit(d) - F.size("v"))),
                                                  lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double"))).alias("x"))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(i, BLOCK_ROWS)
                    x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8")
                    ids = part.column("vec_id")
                    yield pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

        self.blocks = stored(whole.mapInArrow(pack, "ids array<bigint>, x binary"), "vector-rows")
        self.parts = self.blocks.rdd.getNumPartitions()
        # sums of whole numbers below 2^61: exact in 64 bits, in any order
        self.sums = self.total(lambda x: x.sum(0), centred=False, kind=np.int64)
        self.variance = float(self.total(lambda x: np.array([(x * x).sum()]))[0]) / n

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        n, sums = self.n, self.sums
        return lambda x: (n * x - sums) / n

    def total(self, share: Callable[[np.ndarray], np.ndarray], centred: bool = True, kind: type = np.float64) -> np.ndarray:
        """The sum over all blocks of what ``share`` makes of a block's rows."""
        dim, of = self.dim, self.centred() if centred else (lambda x: x)

        def sums(values: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            out = None
            for v in values:
                out = v if out is None else out + v
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(out, kind).tobytes()], pa.binary())], ["s"])

        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return sums(share(of(np.frombuffer(b.as_py(), "<i8").reshape(-1, dim))) for batch in batches for b in batch.column("x"))

        def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return sums(np.frombuffer(b.as_py(), kind) for batch in batches for b in batch.column("s"))

        found = self.blocks.select("x").mapInArrow(shares, "s binary")
        if self.parts > PARTIAL_SUMS:
            found = found.repartition(PARTIAL_SUMS).mapInArrow(more, "s binary")
        return np.sum([np.frombuffer(r.s, kind) for r in found.collect()], axis=0)

    def both_products(self, y: np.ndarray) -> tuple[np.ndarray, float]:
        """X'(X y) and the squared length of X y, in one pass."""
        def share(x: np.ndarray) -> np.ndarray:
            u = x @ y
            return np.append(u @ x, u @ u)

        out = self.total(share)
        return out[:-1], float(out[-1])


def bidiagonalise(both_products: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, length2: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) with X V = U B, U of orthonormal columns, B upper bidiagonal.  ``length2``: the sum of squares of X."""
    rnd = np.random.default_rng(seed)
    right = np.zeros((dim, dim))  # rows: right directions
    y_of, back = np.zeros((dim, dim)), np.zeros((dim, dim))  # rows: u = X y, and X'u
    small = np.zeros((dim, dim))
    least = 1e-13 * np.sqrt(length2)

    def orthogonal(w: np.ndarray, k: int) -> np.ndarray:
        for _ in range(2):
            w = w - right[:k].T @ (right[:k] @ w)
        return w

    v, beta = rnd.standard_normal(dim), 0.0
    v /= np.linalg.norm(v)
    for j in range(dim):
        right[j] = v
        y = v - beta * y_of[j - 1] if j else v
        for _ in range(4):
            g, length = both_products(y)
            if length <= least**2:
                break
            overlap = y_of[:j] @ g
            y = y - overlap @ y_of[:j]
            g = g - overlap @ back[:j]
            lost = overlap @ overlap
            length -= lost
            if lost <= 1e-22 * length:
                break
        alpha = np.sqrt(max(length, 0.0))
        if alpha <= least:
            alpha, y, g = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            y, g = y / alpha, g / alpha
        y_of[j], back[j], small[j, j] = y, g, alpha
        if j + 1 == dim:
            break
        w = orthogonal(g - alpha * v, j + 1)
        beta = float(np.linalg.norm(w))
        if beta <= least:  # the directions so far are closed under X'X: a new one
            beta, w = 0.0, orthogonal(rnd.standard_normal(dim), j + 1)
            v = w / np.linalg.norm(w)
        else:
            v = w / beta
        v = orthogonal(v, j + 1)
        v /= np.linalg.norm(v)
        small[j, j + 1] = beta
    return right.T, small


def components(rows: CentredRows, n_components: int = N_COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(unit components as rows, variances along them), by falling variance."""
    if rows.variance <= 0:
        return np.zeros((0, rows.dim)), np.zeros(0)
    right, small = bidiagonalise(rows.both_products, rows.dim, rows.variance * rows.n)
    _, s, turn = np.linalg.svd(small)
    variance = s**2 / rows.n
    k = int((variance > NO_VARIANCE * rows.variance).sum())
    k = min(k, n_components)
    out = (right @ turn.T).T[:k]
    sign = np.sign(out[np.arange(k), np.abs(out).argmax(1)])
    return out * sign[:, None], variance[:k]


def identity_error(rows: CentredRows, directions: np.ndarray, variance: np.ndarray) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    k = len(variance)
    if not k:
        return 0.0
    to = (directions / np.sqrt(variance)[:, None]).T
    mean = rows.total(lambda x: (x @ to).sum(0)) / rows.n

    def share(x: np.ndarray) -> np.ndarray:
        w = x @ to - mean
        return (w.T @ w).ravel()

    return float(np.abs(rows.total(share).reshape(k, k) / rows.n - np.eye(k)).max())


def whiten(embeddings: DataFrame, n_components: int = N_COMPONENTS) -> DataFrame:
    """(vec_id, component from 1, n, deviation, whitened, explained, identity_error), a row for each vector and component."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = CentredRows(embeddings)
    if not rows.n:
        return embeddings.sparkSession.createDataFrame([], schema)
    directions, variance = components(rows, n_components)
    k, n, dim, sums = len(variance), rows.n, rows.dim, rows.sums
    error, explained, centred = identity_error(rows, directions, variance), variance / rows.variance if k else variance, rows.centred()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = (directions / np.sqrt(variance)[:, None]).T
        for batch in batches:
            for ids, b in zip(batch.column("ids"), batch.column("x")):
                x = np.frombuffer(b.as_py(), "<i8").reshape(-1, dim)
                exact, m = n * x - sums, len(x)
                if float(np.abs(exact).max()) ** 2 * dim >= 2.0**62:
                    deviation = [sum(int(c) ** 2 for c in row) for row in exact.tolist()]
                else:
                    deviation = (exact * exact).sum(1)
                columns = [ids.values.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                           pa.array(np.full(m * k, n)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                           pa.array((centred(x) @ to).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.blocks.mapInArrow(run, schema)
