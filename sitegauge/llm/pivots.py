"""Product codes of vectors, assigned through distances to fixed pivots (LAESA).

Components become whole numbers, vectors are cut into ``PARTS`` equal parts, and each part position
has a codebook of ``entries`` entries that a few rounds of assignment and averaging improve. Some of
the first entries are the pivots, chosen far from each other; the distances of all parts to them are
computed once and stored beside the parts. A round needs only the distances of entries to pivots: by
the triangle inequality, the largest difference between a part's and an entry's distance to a pivot
is a lower bound of their own distance. A part visits its entries in the order of these bounds and
stops where the bound exceeds its best exact distance, so results are those of a full search. Bounds
are rounded, and the stop leaves a margin far above the rounding; exact distances are whole numbers.

Tasks add up their parts per entry before the shuffle, and the driver sees one sum per entry. A round
that loses executors is computed again from the stored table.

Defined results: vectors that are null or hold a null or non-finite component are dropped; shorter
ones (empty too) are filled up with zeros to the longest, and all to a multiple of ``PARTS``; null ids
come last among the smallest, and rows of one id by their vectors; with fewer rows than entries the
codebook is shorter; ties go to the lower entry, repeated entries included; null labels are one label;
an empty table gives an empty one; other columns are ignored. Components of more than ``limit(d)``
stop there, which is 131,072 times 1024 for 64 components, so that all squares fit 64 bits; sums
of errors stop at the largest long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 64
#: Rows of one array of bounds, and entries that a part visits before it looks at its best again.
ROWS, STEP = 1024, 8
#: Relative margin for distances rounded to 4-byte floats.
MARGIN = 1e-6
MOST = (1 << 63) - 1


def limit(d: int) -> int:
    """The largest component whose squared differences still add up within 64 bits."""
    return math.isqrt((1 << 62) // d) // 2


def whole_numbers(vectors: list, d: int) -> np.ndarray:
    """floor(SCALE * x) of all components, filled up to ``d``."""
    out = np.zeros((len(vectors), d), np.int64)
    sizes = np.array([len(v) for v in vectors], np.int64)
    if sizes.sum():
        flat = np.floor(np.concatenate([np.asarray(v, np.float64) for v in vectors]) * SCALE)
        most = limit(d)
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, at] = np.clip(flat, -most, most).astype(np.int64)
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``x`` to the few rows of ``y``."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1).astype(np.float64)) for p in y], axis=1)


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Entries far from each other: each next one has the largest sum of distances to those before."""
    chosen, total = [0], distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(n, len(entries)):
        total[chosen] = -1
        chosen.append(int(total.argmax()))
        total = total + distances(entries, entries[chosen[-1:]])[:, 0]
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_to_pivots: np.ndarray):
    """Nearest entry of every row, its squared distance, and how many distances were computed."""
    n, m = len(x), len(entries)
    bound = np.zeros((n, m), np.float32)
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(np.subtract.outer(to_pivots[:, p], entry_to_pivots[:, p])), out=bound)
    order = np.argsort(bound, axis=1)
    bound = np.take_along_axis(bound, order, axis=1)
    margin = MARGIN * (1 + to_pivots.max(axis=1, initial=0) + entry_to_pivots.max(initial=0))
    best, entry = np.full(n, MOST), np.full(n, m)
    visited = np.zeros(n, np.int64)
    open_rows = np.arange(n)
    for a in range(0, m, STEP):
        reach = np.sqrt(best[open_rows].astype(np.float64)) + margin[open_rows]
        open_rows = open_rows[bound[open_rows, a] <= reach]
        if not len(open_rows):
            break
        reach = np.sqrt(best[open_rows].astype(np.float64)) + margin[open_rows]
        row, col = np.nonzero(bound[open_rows, a:a + STEP] <= reach[:, None])
        row = open_rows[row]
        candidate = order[row, a + col]
        square = ((x[row] - entries[candidate]) ** 2).sum(axis=1)
        visited += np.bincount(row, minlength=n)
        # The best of each row's step: rows come in order, the nearest and lowest entry first.
        by = np.lexsort((candidate, square, row))
        first = by[np.flatnonzero(np.r_[True, np.diff(row[by]) != 0])]
        r, s, c = row[first], square[first], candidate[first]
        better = (s < best[r]) | ((s == best[r]) & (c < entry[r]))
        best[r[better]], entry[r[better]] = s[better], c[better]
    return entry, best, visited


class Codebooks:
    """Entries of every part position, and the pivots that stay."""

    def __init__(self, first: np.ndarray, n_pivots: int):
        self.width = first.shape[1] // PARTS
        self.entries = np.stack(np.split(first, PARTS, axis=1))  # part, entry, component
        self.pivots = np.stack([choose_pivots(e, n_pivots) for e in self.entries])
        self.measure()

    def measure(self):
        self.entry_to_pivots = [distances(e, p).astype(np.float32)
                                for e, p in zip(self.entries, self.pivots)]

    def to_pivots(self, x: np.ndarray) -> np.ndarray:
        return np.stack([distances(part, p) for part, p in zip(np.split(x, PARTS, axis=1), self.pivots)],
                        axis=1).astype(np.float32)

    def assigned(self, x: np.ndarray, to_pivots: np.ndarray):
        """(entry, squared distance, visited) of every row and part."""
        out = [np.empty((len(x), PARTS), np.int64) for _ in range(3)]
        for a in range(0, len(x), ROWS):
            for p in range(PARTS):
                part = x[a:a + ROWS, p * self.width:(p + 1) * self.width]
                found = nearest(part, to_pivots[a:a + ROWS, p], self.entries[p], self.entry_to_pivots[p])
                for o, f in zip(out, found):
                    o[a:a + ROWS, p] = f
        return out

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _prepared(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    d = books.width * PARTS
    for batch in batches:
        x = whole_numbers(batch.column("embedding").to_pylist(), d)
        near = books.to_pivots(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"),
             pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()),
             pa.array([r.tobytes() for r in near.astype("<f4")], pa.binary())],
            ["vec_id", "label", "parts", "to_pivots"])


def _arrays(batch: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column("parts").to_pylist()), "<i4")
    near = np.frombuffer(b"".join(batch.column("to_pivots").to_pylist()), "<f4")
    n = batch.num_rows
    return (x.reshape(n, books.width * PARTS).astype(np.int64),
            near.reshape(n, PARTS, books.pivots.shape[1]))


def _summed(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """Counts and sums of the parts of each entry in this task."""
    m, w = books.entries.shape[1], books.width
    count, total = np.zeros(PARTS * m, np.int64), np.zeros((PARTS * m, w), np.int64)
    for batch in batches:
        x, near = _arrays(batch, books)
        entry = books.assigned(x, near)[0]
        for p in range(PARTS):
            np.add.at(count, p * m + entry[:, p], 1)
            np.add.at(total, p * m + entry[:, p], x[:, p * w:(p + 1) * w])
    used = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int64()), pa.array(count[used], pa.int64()),
         pa.array(list(total[used]), pa.list_(pa.int64()))], ["entry", "n", "sums"])


def _coded(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        entry, square, visited = books.assigned(*_arrays(batch, books))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"),
             pa.array(["".join(f"{e:02x}" for e in row) for row in entry.tolist()], pa.string()),
             pa.array(square.sum(axis=1), pa.int64()), pa.array(visited.sum(axis=1), pa.int64())],
            ["vec_id", "label", "code", "error", "visited"])


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS,
             pivots: int = PIVOTS) -> tuple[DataFrame, str]:
    """(vec_id, label, code, error, visited) of every vector, and the digest of all entries.

    ``visited`` counts the exact distances computed for the row's parts in the last assignment.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits")
    spark = vectors.sparkSession
    kinds = dict(vectors.dtypes)
    rows = vectors.select("vec_id", "label", "embedding").filter(finite(F.col("embedding")))
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    if longest is None:
        empty = spark.createDataFrame([], f"{schema}, code string, error long, visited long")
        return empty, hashlib.sha256(b"").hexdigest()
    d = max(1, -(-longest // PARTS)) * PARTS
    first = rows.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries)
    books = Codebooks(whole_numbers([r["embedding"] for r in first.collect()], d), pivots)
    table = cut_lineage(rows.mapInArrow(lambda it: _prepared(it, books),
                                        f"{schema}, parts binary, to_pivots binary"))
    m, w = books.entries.shape[1], books.width
    for _ in range(rounds):
        sums = (table.select("parts", "to_pivots")
                .mapInArrow(lambda it: _summed(it, books), "entry long, n long, sums array<long>")
                .groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}")
                                                               for i in range(w)]))
        for r in sums.collect():  # one row per entry
            p, e = divmod(r["entry"], m)
            books.entries[p, e] = [s // r["n"] for s in r[2:]]
        books.measure()
    return table.mapInArrow(lambda it: _coded(it, books),
                            f"{schema}, code string, error long, visited long"), books.digest()


def op12(vectors: DataFrame) -> DataFrame:
    coded, digest = compress(vectors)
    coded = cut_lineage(coded.select("vec_id", "label", "code", "error"))
    by_label = (coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
                .select(F.col("label").alias("same"),
                        F.least("total", F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error")))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("same")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def _oracle() -> str:
    steps = ["""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL
    AND length(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
wide AS (SELECT greatest(1, (max(length(embedding)) + 3) // 4) AS w FROM v),
x AS MATERIALIZED (
  SELECT r, i // w AS p, i % w AS j, CAST(floor(1024 * coalesce(embedding[i + 1], 0)::DOUBLE) AS BIGINT) AS c
  FROM (SELECT r, embedding, w, unnest(range(0, 4 * w)) AS i FROM v, wide)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, c FROM x WHERE r <= 256)"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, p, e, s FROM (
    SELECT x.r, x.p, b.e, sum((x.c - b.c) * (x.c - b.c)) AS s FROM x JOIN b{i} b USING (p, j)
    GROUP BY x.r, x.p, b.e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY s, e) = 1)""")
        if i < ROUNDS:
            steps.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, coalesce(m.c, b.c) AS c
  FROM b{i} b LEFT JOIN (
    SELECT p, e, j, CAST(floor(sum(c)::DOUBLE / count(*)) AS BIGINT) AS c
    FROM a{i} JOIN x USING (r, p) GROUP BY p, e, j) m USING (p, e, j))""")
    steps.append(f"""
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(s) AS error FROM a{ROUNDS} GROUP BY r)""")
    return ",".join(steps) + f"""
SELECT vec_id, code, CAST(error AS BIGINT) AS error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded JOIN v USING (r)
"""


ORACLE = _oracle()
