"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text's features are the n-grams of 2 to 4 bytes of its words with their borders (UTF-8, A-Z
lower-cased), hashed to ``BUCKETS`` rows of an embedding table. The average embedding goes through a
linear layer and a softmax. Both are trained by stochastic gradient descent in numpy on a bounded
sample of whole labelled rows (``max_rows`` in all, dealt to the values of ``lang``, in each the
smallest hashes); a fifth of the sample is held back to calibrate a softmax
temperature and the score below which a prediction is rejected (``reject_share`` of the correct
held-back rows score lower). Prediction reads whole texts: the layer is linear, so a text's logits
are its counts of buckets times the logits of the buckets.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if
no labelled row can be learned from; rows with a null ``lang`` teach nothing; a null id counts as
the empty text in the fold; equal rows get equal results; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import id_bucket, texts_of

BITS = 15
BUCKETS = 1 << BITS
DIMENSIONS = 16
#: Words of a text that are looked at in one array.
PART_WORDS = 50_000
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def bucket_counts(text: bytes) -> np.ndarray:
    """How often each bucket occurs in a text."""
    counts = np.zeros(BUCKETS, np.int64)
    words = text.lower().split()
    for i in range(0, len(words), PART_WORDS):
        b = np.frombuffer(b" " + b" ".join(words[i:i + PART_WORDS]) + b" ", np.uint8)
        inner = b != 32
        codes = b.astype(np.uint64)
        for n in (2, 3, 4):
            if len(b) < n:
                break
            gram = codes[:len(b) - n + 1].copy()
            whole = np.ones(len(gram), bool)
            for k in range(1, n):
                gram |= codes[k:len(gram) + k] << np.uint64(8 * k)
                if k < n - 1:  # a border may be at the ends alone
                    whole &= inner[k:len(gram) + k]
            hashed = (gram + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((hashed >> np.uint64(64 - BITS))[whole].astype(np.int64),
                                  minlength=BUCKETS)
    return counts


def text_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    counts = bucket_counts(text)
    at = np.flatnonzero(counts)
    return at, counts[at] / max(1, counts.sum())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Per-bucket logits of a trained embedding and softmax, with temperature and rejection score."""

    def __init__(self, langs: list[str], logits: np.ndarray, temperature: float, reject: float):
        self.langs, self.logits = langs, logits
        self.temperature, self.reject = temperature, reject


def train(rows: list[tuple[bytes, str]], **options) -> Model | None:
    """Fit on (text, lang); every fifth row calibrates."""
    return train_features([(text_features(text), lang) for text, lang in rows], **options)


def train_features(rows: list[tuple[tuple[np.ndarray, np.ndarray], str]], epochs: int = 4,
                   rate: float = 0.5, seed: int = 7, reject_share: float = 0.01) -> Model | None:
    """Fit on (features, lang)."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return None
    data = [(f, langs.index(lang)) for f, lang in rows if len(f[0])]
    held, fit = data[::5], [d for i, d in enumerate(data) if i % 5] or data
    rng = np.random.RandomState(seed)
    emb = rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    out = np.zeros((DIMENSIONS, len(langs)))
    steps, done = max(1, epochs * len(fit)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            (at, share), y = fit[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ emb[at]
            p = softmax(mean @ out)
            p[y] -= 1.0
            back = out @ p
            out -= step * np.outer(mean, p)
            emb[at] -= 4 * step * np.outer(share, back)
    logits = emb @ out
    if not held:
        return Model(langs, logits, 1.0, 0.0)
    z = np.array([share @ logits[at] for (at, share), _ in held])
    y = np.array([k for _, k in held])
    temperatures = np.geomspace(0.05, 4, 40)
    losses = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in temperatures]
    t = float(temperatures[int(np.argmin(losses))])
    p = softmax(z / t)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    return Model(langs, logits, t, float(np.quantile(right, reject_share)) if len(right) else 0.0)


def predict(model: Model, text: bytes) -> tuple[str, float]:
    if not _LETTER.search(text.decode("utf-8", "replace")):
        return UNKNOWN, 0.0
    counts = bucket_counts(text)
    p = softmax(counts @ model.logits / counts.sum() / model.temperature)
    k = int(p.argmax())
    return model.langs[k], float(p[k])


def _predicted(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        found = [predict(model, t) if model else (UNKNOWN, 0.0) for t in texts_of(batch.column(2))]
        langs, scores = [x for x, _ in found], [x for _, x in found]
        low = [x < (model.reject if model else 1.0) for x in scores]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(langs, pa.string()),
             pa.array(scores, pa.float64()), pa.array(low, pa.bool_())],
            ["doc_id", "held_out", "lang_pred", "score", "rejected"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) to the features of whole texts, as arrays of bytes."""
    for batch in batches:
        found = [text_features(t) for t in texts_of(batch.column(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([at.astype("<u2").tobytes() for at, _ in found], pa.binary()),
             pa.array([share.astype("<f8").tobytes() for _, share in found], pa.binary()),
             batch.column(1)], ["at", "share", "lang"])


def learn(docs: DataFrame, max_rows: int = 3000) -> Model | None:
    """A model from at most ``max_rows`` labelled rows (or one per lang), dealt to the values of ``lang``.

    A lang gives an equal share of the rows, the smallest hashes first, or all it has; what smaller
    ones leave goes to the others. Tasks turn the whole texts of these rows into features.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", "lang")
    taken, left = {}, max_rows
    counts = sorted((r["count"], r["lang"]) for r in rows.groupBy("lang").count().collect())
    for i, (n, lang) in enumerate(counts):
        taken[lang] = min(n, max(1, left // (len(counts) - i)))
        left -= taken[lang]
    if not taken:
        return None
    quota = F.create_map(*[F.lit(x) for pair in taken.items() for x in pair])
    by = ["doc_id", "text", "lang"]
    # A few more than the quota by hash, then exactly the smallest.
    total = F.create_map(*[F.lit(x) for n, lang in counts for x in (lang, n)])
    share = (1.5 * quota[F.col("lang")] + 100) / total[F.col("lang")]
    h = F.xxhash64(*by)
    order = Window.partitionBy("lang").orderBy("_hash", *by)
    sample = (rows.withColumn("_hash", h)
              .filter(F.pmod("_hash", F.lit(1 << 30)) < F.least(share, F.lit(1.0)) * (1 << 30))
              .withColumn("_place", F.row_number().over(order))
              .filter(F.col("_place") <= quota[F.col("lang")]))
    found = sample.orderBy("_hash", *by).select("text", "lang").mapInArrow(
        _featured, "at binary, share binary, lang string").collect()
    return train_features([((np.frombuffer(r["at"], "<u2").astype(np.int64),
                             np.frombuffer(r["share"], "<f8")), r["lang"]) for r in found])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of rows (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of a few logits
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        lambda it: _predicted(it, shared),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op10(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang", (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"))
    return identify(rows, learn(rows.filter(~F.col("held_out"))))
