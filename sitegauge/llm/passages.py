"""Repeated passages: intervals of a Burrows-Wheeler transform, expanded breadth first.

A byte goes if a string of ``length`` bytes covers it that also starts in a document with a smaller
id. Documents are packed into chunks; buckets meet all equal strings, in a dialogue of packed arrays:

1. Every window of ``length`` bytes has a key, the smallest hash of its ``GRAM``-byte grams.
   Neighbouring windows with one key form a string. Chunks send their distinct keys to buckets, which
   answer which keys a second document has (the others cannot repeat), and which of these are hot:
   their strings fill more than ``SLICE`` bytes.
2. Chunks send the distinct strings of repeated keys, each with the smallest document that holds it,
   to the bucket of the key. The windows of a hot key travel one by one to the bucket of their own
   hash, so no bucket gets all strings around a very common phrase.
3. A bucket concatenates its distinct strings, a slice of keys at a time, and builds the transform.
   Starting with the interval of the empty string, every level extends all live intervals backwards
   by every byte: this sets the common prefixes of that length between neighbours of the suffix
   order, and an interval lives on where it set one. After ``length`` levels what is not set is a
   common prefix of ``length`` bytes or more, so the rows between set ones start with equal windows.
   The smallest document of each such class goes back to the chunks.
4. Chunks mark the windows whose class has a smaller document than their own, and cut.

Equal windows have equal keys, so they always meet; equal hashes of different grams only add work.
Texts never leave their chunk but for repeated strings. Chunks and buckets are sized by bytes.

Defined results: a null or empty text has no bytes and gives empty bytes; texts shorter than
``length`` stay whole; a null id comes after all others, and rows with a null id count as one
document; rows with one id count as one document and do not cut each other; an empty table gives an
empty one; other columns are ignored. Bytes are cut wherever a match ends, so what is kept need not
be valid UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, texts_of
from .katz import mixed, pack, pack_sorted, unpack, unpack_sorted

LENGTH = 50
#: Bytes of a gram, text bytes of a chunk and of what one bucket serves.
GRAM, CHUNK, BUCKET = 20, 8 << 20, 12 << 20
#: String bytes of a key that is not hot; two such amounts are the most that one transform holds.
SLICE = 1 << 19
#: Windows of a string at most, and of the blocks in which keys are computed.
LONGEST, BLOCK = 4096, 1 << 17
BORDER = 0xFF  # in no UTF-8 text
NO_ID = (1 << 63) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ keys and strings

def _loads(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    n = len(data) - 7
    out = np.empty(n, np.uint64)
    for i in range(min(8, n)):
        m = (n - i + 7) // 8
        out[i::8] = data[i:i + 8 * m].view("<u8")
    return out


def window_keys(data: np.ndarray, length: int) -> np.ndarray:
    """Smallest gram hash of every window, as 48 bits; ``data`` holds one window at least."""
    gram = min(GRAM, length)
    if gram < 8:
        data = np.concatenate([data, np.zeros(8 - gram, np.uint8)])
    x = _loads(data)
    if gram < 8:
        x &= np.uint64((1 << 8 * gram) - 1)
    n = len(data) - max(gram, 8) + 1
    h = x[:n] * _MIX
    h ^= h >> np.uint64(29)
    for at in sorted({*range(8, gram - 7, 8), max(0, gram - 8)} - {0}):
        h += x[at:at + n]
        h *= _MIX
        h ^= h >> np.uint64(29)
    wide, span = length - gram + 1, 1
    while span * 2 <= wide:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < wide:
        h = np.minimum(h[:span - wide], h[wide - span:])
    return h >> np.uint64(16)


def strings_of(data: np.ndarray, sizes: np.ndarray, length: int):
    """(start, windows, key, document) of the strings of all documents laid end to end."""
    ends = np.cumsum(sizes)
    windows = np.maximum(0, sizes - length + 1)
    first = ends - sizes
    starts, counts, keys, docs = [], [], [], []
    for a in range(0, len(data) - length + 1, BLOCK):
        b = min(a + BLOCK, len(data) - length + 1)
        key = window_keys(data[a:b + length - 1], length)
        d0, d1 = np.searchsorted(ends, [a, b - 1], "right")
        lo = np.maximum(first[d0:d1 + 1], a) - a
        hi = np.minimum(first[d0:d1 + 1] + windows[d0:d1 + 1], b) - a
        has = lo < hi
        cut = np.zeros(b - a + 1, bool)
        cut[1:b - a] = key[1:] != key[:-1]
        cut[lo[has]] = True
        cut[hi[has]] = True  # what follows belongs to no window of this document
        at = np.flatnonzero(cut[:b - a])
        doc = d0 + np.searchsorted(ends[d0:d1 + 1], at + a, "right")
        n = np.diff(np.r_[at, b - a])
        ok = at + a < first[doc] + windows[doc]
        at, doc, n = at[ok], doc[ok], n[ok]
        if (n > LONGEST).any():
            parts = -(-n // LONGEST)
            step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            left = np.repeat(n, parts) - step * LONGEST
            at, doc, n = np.repeat(at, parts) + step * LONGEST, np.repeat(doc, parts), np.minimum(left, LONGEST)
        starts.append(at + a)
        counts.append(n)
        keys.append(key[at].astype(np.int64))
        docs.append(doc)
    if not starts:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in (starts, counts, keys, docs))


# ------------------------------------------------------------------ the transform

def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``data`` in the order of their first ``depth`` bytes at least."""
    n = len(data)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    place = np.arange(n, dtype=np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    step = max(1, (64 - int(bits)) // 8)
    key = np.zeros(n, np.uint64)
    for i in range(step):
        key = (key << np.uint64(8)) | np.roll(data, -i).astype(np.uint64)
    rows, known = None, 0
    while True:
        # A rank of two halves needs twice the bits of a place, and the place itself.
        packed = np.sort((key << bits) | place)
        rows, value = (packed & mask).astype(np.int64), packed >> bits
        known = known + min(known, depth - known) if known else step
        if known >= depth:
            return rows
        rank = np.empty(n, np.uint64)
        rank[rows] = np.cumsum(np.r_[False, value[1:] != value[:-1]]).astype(np.uint64)
        key = (rank << bits) | np.roll(rank, -min(known, depth - known))


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each row of the suffix order with the row before, ``depth`` at most."""
    n = len(data)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    back = place[order - 1]  # row of the rotation that starts one byte earlier
    head = np.r_[True, np.diff(data[order]) != 0]
    prefix = np.full(n + 1, depth, np.int32)
    prefix[0] = prefix[n] = 0
    low, high = np.array([0]), np.array([n])
    for level in range(depth):
        size = high - low
        total = int(size.sum())
        owner = np.repeat(np.arange(len(low)), size)
        rows = np.arange(total) + np.repeat(low - np.cumsum(size) + size, size)
        to = back[rows]
        if total > n // 8:
            marks = np.full(n, -1, np.int64)
            marks[to] = owner
            at = np.flatnonzero(marks >= 0)
            owner = marks[at]
        else:
            both = np.sort((to << 32) | owner)
            at, owner = both >> 32, both & 0xFFFFFFFF
        new = np.r_[True, (np.diff(at) != 1) | (np.diff(owner) != 0)] | head[at]
        first = np.flatnonzero(new)
        low, high = at[first], at[np.r_[first[1:], total] - 1] + 1
        fresh = prefix[high] == depth
        low, high = low[fresh], high[fresh]
        prefix[high] = level
        if not len(low):
            break
    return prefix[:n]


def smallest_holders(strings: list[bytes], docs: np.ndarray, length: int) -> list[np.ndarray]:
    """For every window of each string, the smallest document of an equal window."""
    sizes = np.array([len(s) for s in strings], np.int64) + 1
    border = bytes([BORDER])
    data = np.frombuffer(border.join(strings) + border, np.uint8)
    order = suffix_order(data, length)
    classes = np.flatnonzero(common_prefixes(data, order, length) < length)
    ends = np.cumsum(sizes)
    doc = np.repeat(docs, sizes)
    left = np.repeat(ends - 1, sizes) - np.arange(len(data))  # bytes up to the border
    doc[left < length] = NO_ID
    least = np.minimum.reduceat(doc[order], classes)
    out = np.empty(len(data), np.int64)
    out[order] = np.repeat(least, np.diff(np.r_[classes, len(data)]))
    return [out[e - s:e - length] for e, s in zip(ends, sizes)]


# ------------------------------------------------------------------ chunks

CHUNKS = "chunk long, doc_ids binary, null_ids binary, sizes binary, texts binary"
_CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), *(
    (c, pa.binary()) for c in ("doc_ids", "null_ids", "sizes", "texts"))])
ANSWERS = "chunk long, kind int, bucket long, data binary, more binary"


def _chunked(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    ids, texts, total = [], [], 0

    def flush():
        return pa.RecordBatch.from_pylist([{
            "chunk": 0, "doc_ids": pack(np.array([i or 0 for i in ids], np.int64)),
            "null_ids": pack(np.array([i is None for i in ids], np.int64)),
            "sizes": pack(np.array([len(x) for x in texts], np.int64)),
            "texts": zstandard.ZstdCompressor(level=1).compress(b"".join(texts))}], schema=_CHUNK_SCHEMA)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            ids.append(doc)
            texts.append(text)
            total += len(text)
            if total >= chunk_bytes:
                yield flush()
                ids, texts, total = [], [], 0
    if ids:
        yield flush()


class _Chunk:
    """Texts of one chunk row and their strings, grouped by key."""

    def __init__(self, row, length: int):
        null = unpack(row.null_ids).astype(bool)
        self.ids = np.where(null, NO_ID, unpack(row.doc_ids))
        self.null, self.sizes = null, unpack(row.sizes)
        self.text = zstandard.ZstdDecompressor().decompress(row.texts)
        self.start, self.count, key, doc = strings_of(np.frombuffer(self.text, np.uint8), self.sizes, length)
        self.doc = self.ids[doc]
        self.keys, self.at = np.unique(key, return_inverse=True)

    def parts(self, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        """Every bucket that has keys here, and the numbers of these keys."""
        bucket = (mixed(self.keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0][:len(order)])
        for a, b in zip(at, np.r_[at[1:], len(order)]):
            yield int(bucket[order[a]]), order[a:b]

    def repeated(self, answers: pd.DataFrame, length: int, buckets: int):
        """What takes part in the search: (bucket, start, windows, document) of the strings of
        repeated keys, with the single windows of hot ones."""
        state = np.zeros(len(self.keys), np.int64)
        said = dict(zip(answers["bucket"], answers["data"]))
        for bucket, keys in self.parts(buckets):
            if bucket in said:
                state[keys] = unpack(said[bucket])
        mine = state[self.at]
        cold, hot = np.flatnonzero(mine == 1), np.flatnonzero(mine == 2)
        start, count, doc = self.start[cold], self.count[cold], self.doc[cold]
        bucket = (mixed(self.keys[self.at[cold]]) % np.uint64(buckets)).astype(np.int64)
        if len(hot):
            n = self.count[hot]
            each = np.arange(n.sum()) + np.repeat(self.start[hot] - np.cumsum(n) + n, n)
            hashes = np.array([xxhash.xxh3_64_intdigest(self.text[i:i + length]) % buckets
                               for i in each.tolist()], np.int64)
            start, count = np.r_[start, each], np.r_[count, np.ones(len(each), np.int64)]
            doc, bucket = np.r_[doc, np.repeat(self.doc[hot], n)], np.r_[bucket, hashes]
        order = np.argsort(bucket, kind="stable")
        return bucket[order], start[order], count[order], doc[order]

    def distinct(self, bucket, start, count, length):
        """Per bucket: its number, its distinct strings, and the string of each of its rows."""
        at = np.flatnonzero(np.r_[True, np.diff(bucket) != 0][:len(bucket)])
        for a, b in zip(at, np.r_[at[1:], len(bucket)]):
            found: dict[bytes, int] = {}
            which = np.array([found.setdefault(self.text[i:i + n], len(found)) for i, n in zip(
                start[a:b].tolist(), (count[a:b] + length - 1).tolist())], np.int64)
            yield int(bucket[a]), a, b, found, which


def _only_row(rows: pd.DataFrame):
    return next(rows.itertuples(index=False))


def _sent_keys(batches: Iterator[pd.DataFrame], length: int, buckets: int) -> Iterator[pd.DataFrame]:
    """Step 1: distinct keys of a chunk, their string bytes, and whether two documents have them."""
    for frame in batches:
        for row in frame.itertuples(index=False):
            chunk = _Chunk(row, length)
            n = len(chunk.keys)
            size = np.bincount(chunk.at, weights=chunk.count + length, minlength=n).astype(np.int64)
            low, high = np.full(n, NO_ID), np.full(n, -NO_ID - 1)
            np.minimum.at(low, chunk.at, chunk.doc)
            np.maximum.at(high, chunk.at, chunk.doc)
            out = [(bucket, row.chunk, pack_sorted(chunk.keys[k]),
                    pack(size[k]), pack((low[k] < high[k]).astype(np.int64)))
                   for bucket, k in chunk.parts(buckets)]
            yield pd.DataFrame(out, columns=["bucket", "chunk", "keys", "size", "several"])


def _answered_keys(rows: pd.DataFrame, slice_bytes: int) -> pd.DataFrame:
    """Step 1 in a bucket: 0 for keys of one chunk's document, 1 for repeated ones, 2 for hot ones."""
    keys = [unpack_sorted(x) for x in rows["keys"]]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    size = np.bincount(at, weights=np.concatenate([unpack(x) for x in rows["size"]]))
    chunks = np.bincount(at)
    several = np.bincount(at, weights=np.concatenate([unpack(x) for x in rows["several"]]))
    state = np.where((chunks > 1) | (several > 0), np.where(size > slice_bytes, 2, 1), 0)[at]
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame({"chunk": rows["chunk"], "kind": 1, "bucket": rows["bucket"],
                         "data": [pack(x) for x in np.split(state, cuts)], "more": b""})


def _sent_strings(chunk_rows: pd.DataFrame, answers: pd.DataFrame, length: int,
                  buckets: int) -> pd.DataFrame:
    """Step 2: distinct strings of repeated keys, with their smallest document here."""
    row, out = _only_row(chunk_rows), []
    chunk = _Chunk(row, length)
    bucket, start, count, doc = chunk.repeated(answers, length, buckets)
    for number, a, b, found, which in chunk.distinct(bucket, start, count, length):
        least = np.full(len(found), NO_ID)
        np.minimum.at(least, which, doc[a:b])
        out.append((number, row.chunk, zstandard.ZstdCompressor(level=1).compress(b"".join(found)),
                    pack(np.array([len(x) for x in found], np.int64)), pack(least)))
    return pd.DataFrame(out, columns=["bucket", "chunk", "strings", "sizes", "docs"])


def _answered_strings(rows: pd.DataFrame, length: int, slice_bytes: int) -> pd.DataFrame:
    """Step 3: smallest holders of all windows, in runs."""
    found: dict[bytes, int] = {}
    which, docs = [], []
    for row in rows.itertuples(index=False):
        text, ends = zstandard.ZstdDecompressor().decompress(row.strings), np.cumsum(unpack(row.sizes)).tolist()
        which.append(np.array([found.setdefault(text[a:b], len(found))
                               for a, b in zip([0, *ends], ends)], np.int64))
        docs.append(unpack(row.docs))
    strings = list(found)
    least = np.full(len(strings), NO_ID)
    np.minimum.at(least, np.concatenate(which), np.concatenate(docs))
    sizes = np.array([len(s) for s in strings], np.int64)
    # Strings by key, cut into slices between keys. A hot key's windows are all different, so they
    # may be cut anywhere.
    heads = np.frombuffer(b"".join([s[:length] for s in strings]), np.uint8)
    key = np.concatenate([window_keys(heads[a:a + length * 4096], length)[::length]
                          for a in range(0, len(heads), length * 4096)])
    order = np.argsort(key, kind="stable")
    border = np.r_[True, np.diff(key[order]) != 0]
    weight = (sizes + 1)[order]
    group = np.cumsum(border) - 1
    heavy = np.bincount(group, weights=weight)[group] > slice_bytes
    place = np.cumsum(weight) - weight
    # A slice takes the groups (or single windows of a hot key) that begin in its range of bytes.
    slices = np.maximum.accumulate(np.where(border | heavy, place, 0)) // slice_bytes
    holders: list[np.ndarray | None] = [None] * len(strings)
    cut = np.flatnonzero(np.r_[True, np.diff(slices) != 0])
    for a, b in zip(cut, np.r_[cut[1:], len(order)]):
        part = order[a:b]
        for i, h in zip(part, smallest_holders([strings[i] for i in part], least[part], length)):
            holders[i] = h
    every = np.concatenate(holders)
    n = sizes - length + 1
    ends = np.cumsum(n)
    out = []
    for chunk, bucket, mine in zip(rows["chunk"], rows["bucket"], which):
        m = n[mine]
        value = every[np.arange(m.sum()) + np.repeat(ends[mine] - np.cumsum(m), m)]
        runs = np.flatnonzero(np.r_[True, np.diff(value) != 0])
        out.append((chunk, 2, bucket, pack(value[runs]), pack(np.diff(np.r_[runs, len(value)]))))
    return pd.DataFrame(out, columns=["chunk", "kind", "bucket", "data", "more"])


def _cut(chunk_rows: pd.DataFrame, answers: pd.DataFrame, length: int, buckets: int) -> pd.DataFrame:
    """Step 4: removed spans and kept bytes of the documents of a chunk."""
    row = _only_row(chunk_rows)
    chunk = _Chunk(row, length)
    total = len(chunk.text)
    change = np.zeros(total + 1, np.int32)
    bucket, start, count, doc = chunk.repeated(answers[answers["kind"] == 1], length, buckets)
    said = {r.bucket: (r.data, r.more) for r in answers[answers["kind"] == 2].itertuples(index=False)}
    for number, a, b, found, which in chunk.distinct(bucket, start, count, length):
        data, more = said[number]
        holder = np.repeat(unpack(data), unpack(more))
        sizes = np.array([len(x) for x in found], np.int64) - length + 1
        n = count[a:b]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gone = (holder[np.repeat((np.cumsum(sizes) - sizes)[which], n) + step] < np.repeat(doc[a:b], n))
        at = (np.repeat(start[a:b], n) + step)[gone]
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
    covered = np.cumsum(change[:total]) > 0
    out, a = [], 0
    for doc_id, null, size in zip(chunk.ids.tolist(), chunk.null, chunk.sizes.tolist()):
        mask = covered[a:a + size]
        edge = np.flatnonzero(np.diff(np.r_[False, mask, False]))
        text = np.frombuffer(chunk.text, np.uint8, size, a)
        spans = edge.reshape(-1, 2).tolist()
        out.append((None if null else doc_id, size, [{"start": s, "end": e} for s, e in spans],
                    text[~mask].tobytes() if spans else text.tobytes()))
        a += size
    frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
    frame["doc_id"] = pd.array([x[0] for x in out], dtype="Int64")
    return frame


def repeated_passages(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK,
                      bucket_bytes: int = BUCKET, slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, n_bytes, spans (of bytes that go, end exclusive) and kept (bytes) of every row."""
    if not (1 <= length and 1 <= slice_bytes <= SLICE):
        raise ValueError("length must be positive and slice_bytes at most SLICE")
    chunks = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(lambda it: _chunked(it, chunk_bytes), CHUNKS)
        .withColumn("chunk", F.monotonically_increasing_id()))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    def keys(batches):
        return _sent_keys(batches, length, buckets)

    def answer_keys(rows):
        return _answered_keys(rows, slice_bytes)

    def strings(chunk, answers):
        return _sent_strings(chunk, answers, length, buckets)

    def answer_strings(rows):
        return _answered_strings(rows, length, slice_bytes)

    def cut(chunk, answers):
        return _cut(chunk, answers, length, buckets)

    said = cut_lineage(
        chunks.mapInPandas(keys, "bucket long, chunk long, keys binary, size binary, several binary")
        .groupBy("bucket").applyInPandas(answer_keys, ANSWERS))
    found = (chunks.groupBy("chunk").cogroup(said.groupBy("chunk"))
             .applyInPandas(strings, "bucket long, chunk long, strings binary, sizes binary, docs binary")
             .groupBy("bucket").applyInPandas(answer_strings, ANSWERS))
    return (chunks.groupBy("chunk").cogroup(said.unionByName(found).groupBy("chunk"))
            .applyInPandas(cut, "doc_id long, n_bytes long, "
                                "spans array<struct<start: long, end: long>>, kept binary"))


def removed(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def op13(docs: DataFrame) -> DataFrame:
    return repeated_passages(docs).select(
        "doc_id", "n_bytes", removed(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
         hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (
  SELECT r, o, k, substr(h, 1000 * k + 1, 1098) AS part
  FROM (SELECT r, o, h, unnest(range(0, length(h) // 1000 + 1)) AS k FROM d)),
w AS (
  SELECT r, o, 500 * k + x AS i, substr(part, 2 * x + 1, 100) AS win
  FROM (SELECT r, o, k, part, unnest(range(0, greatest(0, least(500, length(part) // 2 - 49)))) AS x FROM blocks)),
firsts AS (SELECT win, min(o) AS first_o FROM w GROUP BY win HAVING min(o) < max(o)),
gone AS (SELECT r, i FROM w JOIN firsts USING (win) WHERE first_o < o),
marked AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, true) AS fresh FROM gone),
grouped AS (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM marked),
spans AS (SELECT r, g, min(i) AS a, max(i) + 50 AS b FROM grouped GROUP BY r, g),
pieces AS (
  SELECT r, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS a, a AS b FROM spans
  UNION ALL SELECT r, max(b), NULL FROM spans GROUP BY r),
kept AS (
  SELECT p.r, string_agg(substr(h, 2 * a + 1, CASE WHEN b IS NULL THEN length(h) ELSE 2 * (b - a) END), '' ORDER BY a, b) AS k
  FROM pieces p JOIN d USING (r) GROUP BY p.r),
sums AS (SELECT r, sum(b - a) AS n, count(*) AS s FROM spans GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(s, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""
