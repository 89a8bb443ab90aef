"""Document quality from a linear-chain conditional random field over lines.

Each line with a word is labelled good or bad from its own counts and those of
the lines before and after it; two neighbouring labels share a transition
weight.  Forward-backward gives each line's probability of being good, and a
document's raw value is their mean, weighted by line length.  A logistic curve
fitted on the training documents turns it into the score.

A label belongs to a document; in training it is the label of all its lines.
The model is fitted on a bounded sample of labelled documents, the least by
hash of those not held out: ``SAMPLE_DOCS`` rows of at most ``SAMPLE_LINES``
lines.  Only their line counts reach the driver.  Scoring reads every whole
text; a document's lines never leave its task.

Rows: a text that is null or has no line with a word scores 0.  Repeated
documents or labels count as often as they occur; labels other than 0 and 1
are not used; a null doc_id is not held out and has no label.  Without a label
of either kind nothing can be learned and every text with a word scores 0.5.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import fresh, needed, slices, small_batches

SAMPLE_DOCS = 3000
SAMPLE_LINES = 500
THRESHOLD = 0.3
STEPS = 150
RATE = 0.1
RIDGE = 1e-3

SYMBOLS = "#*$%&|<>~^_=+\\{}[]@"
#: Character kinds of a line, counted.
KINDS = ("space", "lower", "upper", "digit", "symbol", "shout", "stop", "other")
N_FEATURES = 13

_TABLE: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    if not _TABLE:
        kind = np.empty(0x110000, np.uint8)
        for c in range(0x110000):
            s = chr(c)
            kind[c] = (0 if s.isspace() else 2 if s.isupper() else 1 if s.isalpha() else 3 if s.isdigit() else 4 if s in SYMBOLS
                       else 5 if s == "!" else 6 if s in ".,;:?" else 7)
        _TABLE.append(kind)
    return _TABLE[0]


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and lengths of all lines with a word, and each text's bounds in them."""
    lines: list[str] = []
    again: list[bool] = []
    variety: list[float] = []
    ends = [0]
    for t in texts:
        seen: set[str] = set()
        for line in (t or "").split("\n"):
            if line.strip(" \t\n\v\f\r"):
                lines.append(line)
                again.append(line in seen)
                seen.add(line)
                words = line.split()
                variety.append(len(set(words)) / max(len(words), 1))
        ends.append(len(lines))
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    if not len(lines):
        return np.zeros((0, N_FEATURES), np.float32), size, np.array(ends)
    kind = _kinds()[np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)]
    stop = np.cumsum(size)
    start = stop - size
    counts = np.stack([np.add.reduceat(kind == k, start, dtype=np.int64) for k in range(len(KINDS))], 1).astype(float)
    space, lower, upper, _, _, _, _, _ = counts.T
    letters = lower + upper
    share = counts / size[:, None]
    last = kind[stop - 1]
    extra = np.stack([np.log1p(size), upper / np.maximum(letters, 1), np.minimum(letters / (space + 1), 30) / 10,
                      (last == 6) | (last == 5), np.array(again), np.array(variety)], 1)
    return np.hstack([share[:, 1:], extra]).astype(np.float32), size, np.array(ends)


def with_neighbours(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after in its text (zeros at the ends), and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    inner = bounds[(bounds > 0) & (bounds < len(x))]
    before[inner] = 0
    after[inner - 1] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1), x.dtype)])


class Chain:
    """Weights of a two-label chain: one for each feature (good against bad) and a 2 x 2 transition table."""

    def __init__(self, n: int):
        self.weights, self.steps = np.zeros(n), np.zeros((2, 2))

    def marginals(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of good for each line, and the expected transitions of all texts."""
        gain = np.clip(x @ self.weights, -30, 30)
        good, expected = np.zeros(len(x)), np.zeros((2, 2))
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        if not len(order):
            return good, expected
        first, size = bounds[:-1][order], size[order]
        open_ = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # texts with a line t
        step = np.exp(self.steps)
        local = np.stack([1 / (1 + np.exp(gain)), 1 / (1 + np.exp(-gain))], 1)
        ahead = np.zeros((len(x), 2))
        state = np.ones((len(order), 2))
        for t in range(size[0]):
            n = open_[t]
            at = first[:n] + t
            state = (state[:n] @ step if t else state[:n]) * local[at]
            state /= state.sum(1, keepdims=True)
            ahead[at] = state
        back = np.ones((len(order), 2))
        for t in range(size[0] - 1, -1, -1):
            n = open_[t]
            at = first[:n] + t
            both = ahead[at] * back[:n]
            good[at] = both[:, 1] / both.sum(1)
            if t:
                onward = local[at] * back[:n]
                pair = ahead[at - 1][:, :, None] * step[None] * onward[:, None, :]
                expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
                back[:n] = onward @ step.T
                back[:n] /= back[:n].sum(1, keepdims=True)
        return good, expected

    def fit(self, x: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> None:
        """Climb the conditional likelihood (Adam steps, ridge)."""
        size = np.diff(bounds)
        y = np.repeat(label, size)
        seen = np.zeros((2, 2))
        for v in (0, 1):
            seen[v, v] = np.maximum(size[label == v] - 1, 0).sum()
        m = np.zeros(x.shape[1] + 4)
        v = np.zeros_like(m)
        for i in range(1, STEPS + 1):
            good, expected = self.marginals(x, bounds)
            g = np.concatenate([x.T @ (y - good), (seen - expected).ravel()]) / len(x) - RIDGE * np.concatenate([self.weights, self.steps.ravel()])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            move = RATE * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
            self.weights += move[:-4]
            self.steps += move[-4:].reshape(2, 2)


class QualityModel:
    """Standardised features, the chain, and the curve from raw value to score."""

    def __init__(self, x: np.ndarray, size: np.ndarray, bounds: np.ndarray, label: np.ndarray):
        self.known = len(np.unique(label)) == 2 and len(x) > 0
        if not self.known:
            return
        wide = with_neighbours(x, bounds)
        self.mean, self.scale = wide.mean(0), wide.std(0) + 1e-6
        self.mean[-1], self.scale[-1] = 0, 1
        self.chain = Chain(wide.shape[1])
        self.chain.fit((wide - self.mean) / self.scale, bounds, label)
        self.curve = np.array([0.0, 1.0])
        raw = self.raw(x, size, bounds)
        some = np.diff(bounds) > 0
        z, y = np.stack([np.ones(some.sum()), raw[some]], 1), label[some]
        for _ in range(50):  # Newton steps of a ridge logistic regression
            p = 1 / (1 + np.exp(-z @ self.curve))
            h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
            self.curve += np.linalg.solve(h, z.T @ (y - p) - 1e-2 * self.curve)

    def raw(self, x: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        good, _ = self.chain.marginals((with_neighbours(x, bounds) - self.mean) / self.scale, bounds)
        ends = lambda a: np.concatenate([[0], np.cumsum(a)])[bounds]
        return np.diff(ends(good * size)) / np.maximum(np.diff(ends(size)), 1)

    def score(self, texts: list[str | None]) -> np.ndarray:
        x, size, bounds = line_features(texts)
        some = np.diff(bounds) > 0
        if not self.known:
            return np.where(some, 0.5, 0.0)
        value = self.raw(x, size, bounds)
        return np.where(some, 1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * value))), 0.0)


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> QualityModel:
    """Fit on the sampled labelled documents that are not held out."""
    small_batches(docs)
    picked = (needed(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
              .orderBy(F.xxhash64("doc_id"), "quality").limit(sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                x, size, bounds = line_features(cut.column("text").to_pylist())
                pairs = list(zip(bounds[:-1], bounds[1:]))
                yield pa.RecordBatch.from_arrays(
                    [cut.column("h"), cut.column("quality").cast(pa.int32()), pa.array(np.diff(bounds), pa.int64()),
                     pa.array([x[a:b].tobytes() for a, b in pairs], pa.binary()), pa.array([size[a:b].tobytes() for a, b in pairs], pa.binary())],
                    ["h", "quality", "n", "x", "size"])

    # the join's right side has sample_docs rows at most
    joined = needed(docs, "doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.xxhash64("doc_id", "text").alias("h"), "text", "quality")
    rows = (joined.mapInArrow(run, "h bigint, quality int, n bigint, x binary, size binary").where(F.col("n") <= sample_lines)
            .orderBy("h", "quality").limit(sample_docs).collect())
    x = np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(-1, N_FEATURES)
    size = np.frombuffer(b"".join(r["size"] for r in rows), np.int64)
    bounds = np.concatenate([[0], np.cumsum([r.n for r in rows])]).astype(np.int64)
    return QualityModel(x, size, bounds, np.array([r.quality for r in rows]))


def with_score(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of each whole text."""
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(sent.value.score(cut.column("text").to_pylist()))], [*cut.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def filter_documents(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns."""
    name = fresh(docs, "score")
    return with_score(docs, model, name).where(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_score(needed(docs, "doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
