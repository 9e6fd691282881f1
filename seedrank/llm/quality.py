"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered (here 0 low quality, 1 toxic, 2 clean). One weight vector over hashed text
features is shared by all cuts and each cut has its own threshold, ascending:
P(grade > k) = sigmoid(w . x - theta_k). That gives the tail probability of a grade and the expected
grade of every text. Features are the presence of lower-cased words, the shares of token shapes
(byte classes of both ends and the length), and the share of distinct words, hashed to ``DIM``
buckets. The fit runs with numpy on the driver on a bounded sample of rated rows, about ``SAMPLE``
documents a grade, whose hashed features (not texts) are collected; a feature must occur in
``MIN_DOCS`` of them. Scoring covers every whole text in one pass without a shuffle.

Null texts count as empty; a text without words scores from the thresholds alone. Rows with null
ratings are not learned from; of conflicting ratings of one document the lowest counts. Without
rated rows the expected grade is 0 and nothing is kept. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import text as T
from seedrank.llm.tables import ship

DIM = 1 << 18
SAMPLE = 1500
MIN_DOCS = 4
EPOCHS = 8
RATE = 0.1
L2 = 1e-5


def _byte_class() -> np.ndarray:
    t = np.arange(256, dtype=np.uint64)  # punctuation and control bytes stand for themselves
    t[97:123], t[65:91], t[48:58], t[128:] = 1, 2, 3, 4
    return t


CLASS = _byte_class()


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature buckets of each document and their bounds (n + 1)."""
    n = len(offs) - 1
    low = T.lower_ascii(data)
    starts, ends, first = T.words(low, offs, T.ALNUM_WORDS)
    word = T.span_hash(T.byte_hash(low), starts, ends)
    doc = np.repeat(np.arange(n), np.diff(first))
    a, b, t_first = T.words(data, offs, T.SPACE_SEPARATED)
    t_doc = np.repeat(np.arange(n), np.diff(t_first))
    with np.errstate(over="ignore"):
        shape = ((CLASS[data[a]] * np.uint64(257) + CLASS[data[np.minimum(a + 1, b - 1)]]) * np.uint64(257)
                 + CLASS[data[np.maximum(b - 2, a)]]) * np.uint64(257) + CLASS[data[b - 1]]
        shape = shape * np.uint64(8) + np.minimum((b - a) // 4, 7).astype(np.uint64)
    pair, count = np.unique(np.stack([t_doc.astype(np.uint64), shape]), axis=1, return_counts=True) if len(a) else (np.zeros((2, 0), np.uint64), np.zeros(0, np.int64))
    s_doc = pair[0].astype(np.int64)
    level = np.floor(np.log2(np.maximum(1, np.diff(t_first)[s_doc] / np.maximum(count, 1)))).clip(0, 6).astype(np.uint64)
    with np.errstate(over="ignore"):
        by_shape = T.mix64(pair[1] * np.uint64(8) + level + np.uint64(1 << 60))
    every = np.concatenate([doc, s_doc])
    bucket = np.concatenate([word, by_shape]) % np.uint64(DIM - 16)
    key = np.unique(every.astype(np.uint64) * np.uint64(DIM) + bucket)
    distinct = np.bincount((key // np.uint64(DIM)).astype(np.int64), minlength=n)
    share = np.minimum(15, 16 * distinct // np.maximum(1, np.diff(first) + np.bincount(s_doc, minlength=n)))
    key = np.sort(np.concatenate([key, np.arange(n, dtype=np.uint64) * np.uint64(DIM) + np.uint64(DIM - 16) + share.astype(np.uint64)]))
    bounds = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) * np.uint64(DIM))
    return (key % np.uint64(DIM)).astype(np.int32), bounds


class CumulativeLink:
    """Shared weights and ascending thresholds."""

    def __init__(self, grades: int):
        self.w = np.zeros(DIM)
        self.theta = np.zeros(max(0, grades - 1))
        self.grades = grades

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0 .. grades - 2."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.theta, -60, 60)))

    def fit(self, xs: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 0) -> "CumulativeLink":
        """Maximum likelihood by AdaGrad, one document at a time; grades weigh alike."""
        counts = np.bincount(y, minlength=self.grades)
        above = (np.cumsum(counts[::-1])[::-1][1:] + 0.5) / (len(y) + 1)
        self.theta = np.maximum.accumulate(-np.log(above / (1 - above)) + 1e-6 * np.arange(self.grades - 1))
        seen = np.bincount(np.concatenate(xs), minlength=DIM) if xs else np.zeros(DIM)
        xs = [x[seen[x] >= MIN_DOCS] for x in xs]
        weight = len(y) / np.maximum(1, counts) / max(1, (counts > 0).sum())
        g2, t2 = np.full(DIM, 1e-2), np.full(len(self.theta), 1e-2)
        r = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in r.permutation(len(xs)):
                x, k = xs[i], y[i]
                s = self.w[x].sum()
                up = 1 / (1 + np.exp(-np.clip(s - self.theta, -60, 60)))  # P(grade > j)
                # P(grade = k) = up[k - 1] - up[k]; the derivative of its log by the score
                hi = up[k - 1] if k else 1.0
                lo = up[k] if k < self.grades - 1 else 0.0
                p = max(hi - lo, 1e-9)
                d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
                g = weight[k] * (d_hi - d_lo) / p
                gx = np.clip(g, -5, 5) - L2 * self.w[x]
                g2[x] += gx * gx
                self.w[x] += rate * gx / np.sqrt(g2[x])
                for j, d in ((k - 1, -d_hi), (k, d_lo)):
                    if 0 <= j < self.grades - 1:
                        gt = np.clip(weight[k] * d / p, -5, 5)
                        t2[j] += gt * gt
                        self.theta[j] += rate * gt / np.sqrt(t2[j])
                self.theta = np.sort(self.theta)
        return self


def rated_features(docs: DataFrame, ratings: DataFrame, sample: int) -> tuple[list[np.ndarray], np.ndarray, int]:
    """Features and grades of about ``sample`` rated documents a grade, chosen by a hash of the id.

    ``ratings`` has (doc_id, grade). The chosen ids are bounded by the sample and so are broadcast."""
    rated = ratings.filter("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    counts = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}
    if not counts:
        return [], np.zeros(0, np.int64), 0
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1_000_000))
    chosen = F.lit(False)
    for grade, n in counts.items():
        chosen = chosen | ((F.col("grade") == grade) & (draw < int(1_000_000 * min(1, sample / n))))

    def run(batches):
        for rows, data, offs in T.chunks(batches, "text"):
            f, bounds = features(data, offs)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([f[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])], pa.binary())], names=["doc_id", "grade", "x"])

    got = (docs.join(F.broadcast(rated.filter(chosen)), "doc_id").select("doc_id", F.col("grade").cast("int").alias("grade"), "text")
           .mapInArrow(run, "doc_id long, grade int, x binary").collect())
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    return [np.frombuffer(r["x"], np.int32) for r in got], np.array([r["grade"] for r in got], np.int64), max(counts) + 1


def fit(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> CumulativeLink:
    xs, y, grades = rated_features(docs, ratings, sample)
    model = CumulativeLink(max(1, grades))
    return model.fit(xs, y) if len(xs) and grades > 1 else model


def score(docs: DataFrame, model: CumulativeLink, min_tail: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, keep): the tail is that of the highest grade."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for rows, data, offs in T.chunks(batches, "text"):
            f, bounds = features(data, offs)
            total = np.concatenate(([0.0], np.cumsum(model.w[f])))
            tails = model.tails(total[bounds[1:]] - total[bounds[:-1]])
            top = tails[:, -1] if tails.shape[1] else np.zeros(rows.num_rows)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(tails.sum(axis=1)), pa.array(top), pa.array(top >= min_tail)],
                                             names=["doc_id", "expected_grade", "tail_probability", "keep"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, keep boolean")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, min_tail: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Grades from ``labels`` (doc_id, quality, toxic): 0 for quality 0, 1 for toxic, 2 for the rest."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return score(rows, fit(rows, labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")), sample), min_tail)
