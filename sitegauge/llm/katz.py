"""Katz backoff scores: Good-Turing discounted n-grams with exactly normalised backoff weights.

Tokens are the words of a text (A-Z lower-cased) and one end mark. The model is of order two: a token
seen after its history has the discounted share of the history's count; any other has the history's
backoff weight times the unigram probability; an unknown word has the unigram mass that discounting
left over. Counts up to ``K`` are discounted by Good-Turing, higher ones are kept. A history whose
counts are all higher gives up the share of one count more, so every backoff weight is positive, and
for each history the probabilities of all words and the unknown word add up to 1.

The work is a dialogue of chunks and buckets, in shuffles of packed arrays instead of one row per
token:

1. Texts become chunks of about ``CHUNK_TOKENS`` tokens: sorted word hashes and local numbers.
2. Every chunk sends its words and their training counts to buckets (of the hash). Buckets
   sum them, store the unigram table, and answer with count and number of each word.
3. Every chunk sends its distinct bigrams to the bucket of their history. A history with over
   ``1 / (4 * buckets)`` of all tokens goes to all buckets by bigram, so none holds it whole. Buckets
   sum them, store the bigram table, and answer with the count of each bigram and the sums that the
   backoff weight of a history is made of; sums of split histories (at most ``4 * buckets``) are
   added up and sent to all.
4. Chunks look up each token: bigram, else backoff weight and unigram, else unknown word.

Documents of a chunk never leave it, tables are partitioned by bucket, and nothing whole passes one
task or the driver, which sees counts of counts only. Words are compared by 63-bit hashes.

Defined results: a null or empty text is the end mark alone; a null id counts as the empty text in
the training fold; equal rows train each and score alike; without training rows all tokens are
unknown words of probability 1; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, id_bucket, partitions, texts_of

#: Counts up to this one are discounted.
K = 5
CHUNK_TOKENS = 2_000_000
#: A history of fewer tokens is never split.
HOT_TOKENS = 1000
END = b"\n"  # no word can be like this
_MASK = (1 << 63) - 1
CACHED_WORDS = 150_000

_known: dict[bytes, int] = {}


def pack(values: np.ndarray) -> bytes:
    """Numbers of 64 bits as compressed byte planes; high planes that are all zero cost nothing."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hash(word: bytes) -> int:
    h = _known.get(word)
    if h is None:
        if len(_known) > CACHED_WORDS:
            _known.clear()
        h = _known[word] = xxhash.xxh3_64_intdigest(word) & _MASK
    return h


# ------------------------------------------------------------------ 1. chunks

CHUNKS = ("chunk long, n_docs int, doc_ids binary, null_ids binary, held binary, sizes binary, "
          "words binary, tokens binary")


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, text) to chunks; the number of a chunk is set after."""
    ids, held, sizes, tokens, total = [], [], [], [], 0

    def flush():
        flat = np.concatenate(tokens)
        words, local = np.unique(flat, return_inverse=True)
        nulls = np.array([i is None for i in ids], np.int64)
        return pa.RecordBatch.from_pylist([{
            "chunk": 0, "n_docs": len(ids),
            "doc_ids": pack(np.array([i or 0 for i in ids], np.int64)), "null_ids": pack(nulls),
            "held": pack(np.array(held, np.int64)), "sizes": pack(np.array(sizes, np.int64)),
            "words": pack_sorted(words),
            "tokens": pack(local.astype(np.int64))}], schema=_CHUNK_SCHEMA)

    end = word_hash(END)
    for batch in batches:
        for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  texts_of(batch.column(2))):
            row = np.array([*map(word_hash, text.lower().split()), end], np.int64)
            ids.append(doc)
            held.append(bool(out))
            sizes.append(len(row))
            tokens.append(row)
            total += len(row)
            if total >= CHUNK_TOKENS:
                yield flush()
                ids, held, sizes, tokens, total = [], [], [], [], 0
    if ids:
        yield flush()


_CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("n_docs", pa.int32()), *(
    (c, pa.binary()) for c in ("doc_ids", "null_ids", "held", "sizes", "words", "tokens"))])


class _Chunk:
    """Arrays of one chunk row."""

    def __init__(self, row):
        self.sizes, self.held = unpack(row.sizes), unpack(row.held).astype(bool)
        self.words, self.tokens = unpack_sorted(row.words), unpack(row.tokens)
        self.ids = [None if n else int(i) for i, n in zip(unpack(row.doc_ids), unpack(row.null_ids))]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.trains = np.repeat(~self.held, self.sizes)

    def histories(self) -> np.ndarray:
        """Local number of the token before each token; the number of words stands for the start."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = len(self.words)
        return before


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(hashes) % np.uint64(buckets)).astype(np.int64)


# ---------------------------------------------------------------- 2. unigrams

WORD_ROWS = "bucket long, chunk long, words binary, counts binary"


def _send_words(frames: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples(index=False):
            c = _Chunk(row)
            counts = np.bincount(c.tokens[c.trains], minlength=len(c.words)).astype(np.int64)
            to = _bucket(c.words, buckets)
            yield pd.DataFrame([(b, row.chunk, pack_sorted(c.words[to == b]), pack(counts[to == b]))
                                for b in np.unique(to)], columns=["bucket", "chunk", "words", "counts"])


ANSWERS = "bucket long, chunk long, counts binary, numbers binary, stats array<long>"


def counts_of_counts(counts: np.ndarray) -> list[int]:
    """Sum, number of positive ones, and how many are 1, 2, ..., K + 1."""
    low = np.bincount(counts[(counts > 0) & (counts <= K + 1)], minlength=K + 2)
    return [int(counts.sum()), int((counts > 0).sum()), *map(int, low[1:K + 2])]


def _answer_words(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Sum a bucket's words; the row without chunk is the stored unigram table."""
    words = [unpack_sorted(w) for w in rows["words"]]
    known, at = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(at, np.concatenate([unpack(c) for c in rows["counts"]]),
                        len(known)).astype(np.int64)
    cut = np.cumsum([len(w) for w in words])[:-1]
    # Numbers of words are unique over all buckets: the bucket is in the low part.
    out = [(int(key[0]), int(chunk), pack(total[i]), pack_sorted(i), None)
           for chunk, i in zip(rows["chunk"], np.split(at.astype(np.int64), cut))]
    out.append((int(key[0]), -1, pack(total), pack_sorted(known), counts_of_counts(total)))
    return pd.DataFrame(out, columns=["bucket", "chunk", "counts", "numbers", "stats"])


# ----------------------------------------------------------------- 3. bigrams


class Discounts:
    """Good-Turing factors of counts 1 to K, and unigram probabilities."""

    def __init__(self, stats: list[int]):
        self.total, self.kinds, low = stats[0], stats[1], stats[2:]
        self.factor = np.ones(K + 2)
        if low[0]:
            common = (K + 1) * low[K] / low[0]
            for r in range(1, K + 1):
                if low[r - 1] and common < 1:
                    d = ((r + 1) * low[r] / (r * low[r - 1]) - common) / (1 - common)
                    if 0 < d < 1:
                        self.factor[r] = d
        seen = sum(self.factor[r] * r * low[r - 1] for r in range(1, K + 1))
        rest = self.total - sum(r * low[r - 1] for r in range(1, K + 1))
        self.scale, self.unknown = 1.0, 1.0
        if self.total:
            left = 1 - (seen + rest) / self.total
            if left < 1e-12:  # nothing is discounted: the unknown word gets the share of one count
                self.scale = self.total / (self.total + 1)
                left = 1 - self.scale * (seen + rest) / self.total
            self.unknown = left

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return self.factor[np.where(counts > K, 0, counts)] * counts

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.ones(len(counts))
        return np.where(counts > 0, self.scale * self.discounted(counts) / self.total, self.unknown)


class _Words:
    """Counts and numbers of a chunk's words, from the answers of all buckets."""

    def __init__(self, chunk: _Chunk, answers: pd.DataFrame, buckets: int):
        self.counts = np.zeros(len(chunk.words) + 1, np.int64)
        self.numbers = np.zeros(len(chunk.words) + 1, np.int64)
        to = _bucket(chunk.words, buckets)
        for row in answers.itertuples(index=False):
            at = np.flatnonzero(to == row.bucket)
            self.counts[at] = unpack(row.counts)
            self.numbers[at] = (unpack_sorted(row.numbers) + 1) * buckets + row.bucket
        # The start mark has number 0 and the number of training documents as count, set by the caller.


class _Bigrams:
    """Distinct bigrams of a chunk, sorted by bucket, history and word, with the place of each token."""

    def __init__(self, chunk: _Chunk, words: _Words, buckets: int, hot: int):
        before = chunk.histories()
        pair, at = np.unique(before * (len(chunk.words) + 1) + chunk.tokens, return_inverse=True)
        h, w = np.divmod(pair, len(chunk.words) + 1)
        counts = np.bincount(at[chunk.trains], minlength=len(pair)).astype(np.int64)
        h_no, w_no = words.numbers[h], words.numbers[w]
        split = words.counts[h] > hot
        to = _bucket(np.where(split, h_no * 1_000_003 + w_no, h_no), buckets)
        order = np.lexsort((w_no, h_no, to))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.at, self.to = place[at], to[order]
        self.h, self.w, self.counts = h[order], w[order], counts[order]
        self.h_no, self.w_no = h_no[order], w_no[order]
        self.ends = np.searchsorted(self.to, np.arange(buckets + 1))


BIGRAM_ROWS = "bucket long, chunk long, h binary, n binary, w binary, counts binary, w_counts binary"


def _runs(h: np.ndarray) -> np.ndarray:
    """Start of every run of equal values."""
    return np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)


def _send_bigrams(chunk_rows: pd.DataFrame, answers: pd.DataFrame, buckets: int, hot: int,
                  n_train: int) -> pd.DataFrame:
    out = []
    for row in chunk_rows.itertuples(index=False):
        c = _Chunk(row)
        words = _Words(c, answers, buckets)
        words.counts[-1] = n_train
        b = _Bigrams(c, words, buckets, hot)
        for k in range(buckets):
            i, j = b.ends[k], b.ends[k + 1]
            if i < j:
                starts = _runs(b.h_no[i:j])
                out.append((k, row.chunk, pack_sorted(b.h_no[i:j][starts]),
                            pack(np.diff(np.r_[starts, j - i])), pack(b.w_no[i:j]),
                            pack(b.counts[i:j]), pack(words.counts[b.w[i:j]])))
    return pd.DataFrame(out, columns=[x.split()[0] for x in BIGRAM_ROWS.split(", ")])


BIGRAM_ANSWERS = ("bucket long, chunk long, counts binary, h binary, low binary, mass binary, "
                  "stats array<long>, w binary")


def _sums(h: np.ndarray, counts: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per history: number, how many words follow 1 to K times, and unigram mass of all that follow."""
    starts = _runs(h)
    if not len(starts):
        return h, np.empty(0, np.int64), np.empty(0)
    low = np.stack([np.add.reduceat((counts == r).astype(np.int64), starts) for r in range(1, K + 1)], 1)
    return h[starts], low.ravel(), np.add.reduceat(np.where(counts > 0, p, 0.0), starts)


def _answer_bigrams(key, rows: pd.DataFrame, unigrams: Discounts) -> pd.DataFrame:
    """Sum a bucket's bigrams; the row without chunk is the stored bigram table with its sums."""
    h = [np.repeat(unpack_sorted(x), unpack(n)) for x, n in zip(rows["h"], rows["n"])]
    size = [len(x) for x in h]
    all_h, all_w = np.concatenate(h), np.concatenate([unpack(w) for w in rows["w"]])
    counts = np.concatenate([unpack(c) for c in rows["counts"]])
    w_counts = np.concatenate([unpack(c) for c in rows["w_counts"]])
    order = np.lexsort((all_w, all_h))
    sh, sw = all_h[order], all_w[order]
    new = np.r_[True, (sh[1:] != sh[:-1]) | (sw[1:] != sw[:-1])]
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], starts)
    kh, kw, kp = sh[starts], sw[starts], unigrams.unigram(w_counts[order][starts])
    of = np.empty(len(order), np.int64)
    of[order] = group
    hist, low, mass = _sums(kh, total, kp)
    low = low.reshape(-1, K)
    out, first = [], 0
    for chunk, part, n in zip(rows["chunk"], h, size):
        own = part[_runs(part)]
        at = np.searchsorted(hist, own)
        out.append((int(key[0]), int(chunk), pack(total[of[first:first + n]]), pack_sorted(own),
                    pack(low[at].ravel()), pack(mass[at]), None, None))
        first += n
    out.append((int(key[0]), -1, pack(total), pack_sorted(kh), pack(low.ravel()), pack(mass),
                counts_of_counts(total), pack(kw)))
    return pd.DataFrame(out, columns=[x.split()[0] for x in BIGRAM_ANSWERS.split(", ")])


def _split_sums(frames: Iterator[pd.DataFrame], hot: set[int]) -> Iterator[pd.DataFrame]:
    """Sums of split histories in each bucket's table."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            h = np.unique(unpack_sorted(row.h))
            at = np.flatnonzero(np.isin(h, list(hot)))
            low, mass = unpack(row.low).reshape(-1, K), unpack(row.mass, np.float64)
            yield pd.DataFrame({"h": h[at], "low": pd.Series(list(low[at]), dtype=object),
                                "mass": mass[at]})


# ------------------------------------------------------------------ 4. scores

SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def history_weights(counts: np.ndarray, low: np.ndarray, mass: np.ndarray,
                    bigrams: Discounts) -> tuple[np.ndarray, np.ndarray]:
    """Factor of seen words and backoff weight of histories from their sums."""
    r = np.arange(1, K + 1)
    seen = (low * r * bigrams.factor[1:K + 1]).sum(axis=1) + counts - (low * r).sum(axis=1)
    safe = np.maximum(counts, 1)
    scale = np.where(1 - seen / safe > 1e-9, 1.0, counts / (counts + 1.0))
    left = np.where(counts > 0, 1 - scale * seen / safe, 1.0)
    return scale / safe, left / np.maximum(1 - mass, 1e-12)


def _score(chunk_rows: pd.DataFrame, answers: pd.DataFrame, buckets: int, hot: int, n_train: int,
           unigrams: Discounts, bigrams: Discounts, hot_sums: dict) -> pd.DataFrame:
    out = []
    word_rows = answers[answers["low"].isna()]
    pair_rows = answers[answers["low"].notna()]
    for row in chunk_rows.itertuples(index=False):
        c = _Chunk(row)
        words = _Words(c, word_rows, buckets)
        words.counts[-1] = n_train
        b = _Bigrams(c, words, buckets, hot)
        counts = np.empty(len(b.h), np.int64)
        low, mass = np.zeros((len(c.words) + 1, K), np.int64), np.zeros(len(c.words) + 1)
        local = np.argsort(words.numbers)
        for a in pair_rows.itertuples(index=False):
            counts[b.ends[a.bucket]:b.ends[a.bucket + 1]] = unpack(a.counts)
            at = local[np.searchsorted(words.numbers, unpack_sorted(a.numbers), sorter=local)]
            low[at], mass[at] = unpack(a.low).reshape(-1, K), unpack(a.mass, np.float64)
        for at in np.flatnonzero(words.counts > hot):
            if int(words.numbers[at]) in hot_sums:  # the end mark is no history
                low[at], mass[at] = hot_sums[int(words.numbers[at])]
        share, backoff = history_weights(words.counts, low, mass, bigrams)
        p_word = unigrams.unigram(words.counts[:-1])
        p = np.where(counts > 0, share[b.h] * bigrams.discounted(counts), backoff[b.h] * p_word[b.w])
        token_score = np.log10(p)[b.at]
        token_base = np.log10((words.counts[:-1] + 0.5)
                              / (unigrams.total + 0.5 * (unigrams.kinds + 1)))[c.tokens]
        known = (words.counts[:-1] > 0)[c.tokens].astype(np.int64)
        out.append(pd.DataFrame({
            "doc_id": pd.array(c.ids, "Int64"), "held_out": c.held, "n_tokens": c.sizes,
            "n_known": np.add.reduceat(known, c.starts), "train_tokens": unigrams.total,
            "base_score": np.add.reduceat(token_base, c.starts),
            "score": np.add.reduceat(token_score, c.starts)}))
    return pd.concat(out) if out else pd.DataFrame(
        {x.split()[0]: [] for x in SCORES.split(", ")})


def _sum_stats(rows: DataFrame) -> list[int]:
    """Sums of the statistics of all buckets: K + 3 numbers."""
    got = rows.filter("chunk = -1").select(*[
        F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0)) for i in range(K + 3)]).first()
    return [int(x) for x in got]


def score(docs: DataFrame) -> DataFrame:
    """Scores of rows (doc_id, held_out, text), learned from those that are not held out."""
    spark = docs.sparkSession
    buckets = partitions(spark)
    chunks = cut_lineage(
        docs.select("doc_id", "held_out", "text").mapInArrow(_chunked, CHUNKS)
        .withColumn("chunk", F.monotonically_increasing_id()))
    n_train = docs.filter(~F.col("held_out")).count()

    sent = chunks.mapInPandas(lambda it: _send_words(it, buckets), WORD_ROWS)
    words = cut_lineage(sent.groupBy("bucket").applyInPandas(_answer_words, ANSWERS))
    unigrams = Discounts(_sum_stats(words))
    hot = max(HOT_TOKENS, (unigrams.total + n_train) // (4 * buckets))

    word_answers = words.filter("chunk >= 0").drop("stats")
    sent = (chunks.groupBy("chunk").cogroup(word_answers.groupBy("chunk")).applyInPandas(
        lambda a, b: _send_bigrams(a, b, buckets, hot, n_train), BIGRAM_ROWS))
    pairs = cut_lineage(sent.groupBy("bucket").applyInPandas(
        lambda key, rows: _answer_bigrams(key, rows, unigrams), BIGRAM_ANSWERS))
    bigrams = Discounts(_sum_stats(pairs))

    # Words with over 1 / (4 * buckets) of all tokens: at most 4 * buckets, and the start mark.
    hot_numbers = {0} if n_train > hot else set()
    for row in words.filter("chunk = -1").mapInPandas(
            lambda it: _hot_words(it, buckets, hot), "number long").collect():
        hot_numbers.add(row.number)
    split = (pairs.filter("chunk = -1").select("h", "low", "mass")
             .mapInPandas(lambda it: _split_sums(it, hot_numbers), "h long, low array<long>, mass double")
             .groupBy("h").agg(*[F.sum(F.get("low", F.lit(i))).alias(f"low{i}") for i in range(K)],
                               F.sum("mass").alias("mass")))
    hot_sums = {r[0]: (np.array(r[1:K + 1], np.int64), r[K + 1]) for r in split.collect()}

    answers = (word_answers.select("chunk", "bucket", "counts", "numbers",
                                   F.lit(None).cast("binary").alias("low"),
                                   F.lit(None).cast("binary").alias("mass"))
               .unionByName(pairs.filter("chunk >= 0").select(
                   "chunk", "bucket", "counts", F.col("h").alias("numbers"), "low", "mass")))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        lambda a, b: _score(a, b, buckets, hot, n_train, unigrams, bigrams, hot_sums), SCORES)


def _hot_words(frames: Iterator[pd.DataFrame], buckets: int, hot: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples(index=False):
            at = np.flatnonzero(unpack(row.counts) > hot)
            yield pd.DataFrame({"number": (at + 1) * buckets + row.bucket})


def op9(docs: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text", (id_bucket(F.col("doc_id"), 5) == 1).alias("held_out")))
