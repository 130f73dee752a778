"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A grade is 0 for a toxic document, 1 for one of low quality, 2 for a good one. A text has one score,
a weighted sum of its hashed words and shape features, shared by all grades; ordered thresholds cut
the score: P(grade > k) = sigmoid(score - threshold k). Weights and thresholds are fitted in numpy
by stochastic gradient descent on a bounded sample of rated documents (``max_rows`` of the smallest
id hashes, whole texts). Every document then gets its expected grade and the tail probability of the
top grade, by which it is selected.

Words count by presence: a feature is on if any of its words occurs, so that a few decisive words
weigh the same in a long text. Only buckets that tell grades apart in the sample get weights. Shape
features (shares of symbols, capitals, exclamation marks, repeated words and lines) catch junk whose
words are unknown.

Defined results: a null or empty text has no features and gets the grade of the thresholds alone;
ratings with a null id, quality or toxic are left out, and so are those of unknown documents; of
several ratings of one document each counts; without any rating the expected grade is null and all
documents are kept; equal rows get equal results; an empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import texts_of

BITS = 18
SHAPES = 6
GRADES = 3
CACHED_WORDS = 200_000

_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_known: dict[bytes, int] = {}


def shape(text: bytes, words: list[bytes]) -> list[float]:
    """Shape features between 0 and 1, and a constant."""
    if not words:
        return [0.0] * (SHAPES - 1) + [1.0]
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    spread = (text.count(b"!"), len(text) - len(text.translate(None, _SYMBOLS)))
    return [min(1.0, spread[0] / n), min(1.0, spread[1] / n),
            (len(text) - len(text.translate(None, _CAPITALS))) / max(1, sum(map(len, words))),
            1 - len({*zip(words, words[1:])}) / max(1, n - 1) if n > 20 else 0.0,
            1 - len(set(lines)) / len(lines) if len(lines) > 3 else 0.0, 1.0]


def features(text: bytes) -> tuple[np.ndarray, list[float]]:
    """Distinct buckets of the words, and the shape features."""
    if len(_known) > CACHED_WORDS:
        _known.clear()
    words = text.lower().split()
    buckets = []
    for w in set(words):
        h = _known.get(w)
        if h is None:
            h = _known[w] = xxhash.xxh3_64_intdigest(w.strip(b".,;:!?\"'()")) >> (64 - BITS)
        buckets.append(h)
    return np.unique(np.array(buckets, np.int64)), shape(text, words)


class Model:
    def __init__(self, weights: np.ndarray, shapes: np.ndarray, thresholds: np.ndarray):
        self.weights, self.shapes, self.thresholds = weights, shapes, thresholds

    def score(self, buckets: np.ndarray, shapes: list[float]) -> float:
        return float(self.weights[buckets].sum() + self.shapes @ shapes)

    def tails(self, score: float) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -40, 40)))


def telling(rows: list[tuple[np.ndarray, list[float], int]], least: int = 4,
            z: float = 4.5) -> np.ndarray:
    """Buckets whose documents' mean grade is off the overall mean by ``z`` standard errors."""
    grades = np.array([g for _, _, g in rows], np.float64)
    buckets = np.concatenate([b for b, _, _ in rows])
    n = np.bincount(buckets, minlength=1 << BITS)
    off = np.bincount(buckets, np.repeat(grades - grades.mean(), [len(b) for b, _, _ in rows]), 1 << BITS)
    return (n >= least) & (np.abs(off) > z * max(grades.std(), 1e-9) * np.sqrt(np.maximum(n, 1)))


def train(rows: list[tuple[np.ndarray, list[float], int]], epochs: int = 8, rate: float = 0.3,
          decay: float = 1e-4, seed: int = 3) -> Model | None:
    """Maximize the likelihood of grades under ordered thresholds."""
    if not rows:
        return None
    keep = telling(rows)
    rows = [(b[keep[b]], s, g) for b, s, g in rows]
    rng = np.random.RandomState(seed)
    model = Model(np.zeros(1 << BITS), np.zeros(SHAPES), np.linspace(-2, 0, GRADES - 1))
    squares, shape_squares, cut_squares = np.full(1 << BITS, 1e-2), np.full(SHAPES, 1e-2), np.full(GRADES - 1, 1e-2)
    counts = np.bincount([g for _, _, g in rows], minlength=GRADES)
    balance = np.sqrt(len(rows) / np.maximum(1, counts) / GRADES)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, shapes, grade = rows[i]
            s = np.asarray(shapes)
            tail = np.concatenate([[1.0], model.tails(model.score(buckets, shapes)), [0.0]])
            p = max(1e-9, tail[grade] - tail[grade + 1])
            slope = tail * (1 - tail)
            g = balance[grade] * (slope[grade] - slope[grade + 1]) / p  # of the log likelihood by score
            # AdaGrad: rare words take large steps, common ones settle.
            step = g - decay * model.weights[buckets]
            squares[buckets] += step * step
            model.weights[buckets] += rate * step / np.sqrt(squares[buckets])
            step = g * s
            shape_squares += step * step
            model.shapes += rate * step / np.sqrt(shape_squares)
            step = np.zeros(GRADES - 1)
            if grade > 0:
                step[grade - 1] -= balance[grade] * slope[grade] / p
            if grade < GRADES - 1:
                step[grade] += balance[grade] * slope[grade + 1] / p
            cut_squares += step * step
            model.thresholds += rate * step / np.sqrt(cut_squares)
            model.thresholds = np.maximum.accumulate(model.thresholds + [0, 1e-6])
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in texts_of(batch.column(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b.tobytes() for b, _ in found], pa.binary()),
             pa.array([s for _, s in found], pa.list_(pa.float64())), batch.column(1)],
            ["buckets", "shapes", "grade"])


def _graded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        expected, top = [], []
        for t in texts_of(batch.column(1)):
            tails = model.tails(model.score(*features(t))) if model else None
            expected.append(float(tails.sum()) if model else None)
            top.append(float(tails[-1]) if model else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(expected, pa.float64()), pa.array(top, pa.float64())],
            ["doc_id", "expected_grade", "top_probability"])


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 8000) -> Model | None:
    """A model from at most ``max_rows`` rated documents."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    rated = (labels.filter("doc_id is not null and quality is not null and toxic is not null")
             .select("doc_id", grade.cast("int").alias("grade"), F.xxhash64("doc_id").alias("h"))
             .orderBy("h", "doc_id", "grade").limit(max_rows))
    rows = (docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id")  # max_rows rows
            .select("text", "grade")
            .mapInArrow(_featured, "buckets binary, shapes array<double>, grade int")
            .orderBy("buckets", "grade").collect())
    return train([(np.frombuffer(r.buckets, np.int64), r.shapes, r.grade) for r in rows])


def grade(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, top_probability, and kept where the latter reaches ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights
    return (docs.select("doc_id", "text").mapInArrow(
        lambda it: _graded(it, shared), "doc_id long, expected_grade double, top_probability double")
        .withColumn("kept", F.coalesce(F.col("top_probability") >= least, F.lit(True))))


def op7(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return grade(docs, learn(docs, labels))
