"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Vectors are scaled to length 1, centred on the mean of a bounded sample, scaled again and turned by
a random rotation; a vector's code is the signs of the result, packed to bits. With the code go two
scalars: the length of the centred vector and the inner product of the turned vector with its own
code. They make the estimate of an inner product with a query unbiased and bound its error: with
``d`` dimensions the error is below ``epsilon`` / sqrt(d - 1) times a factor of the scalars, except
with a probability that falls as exp(-epsilon**2 / 2).

Vectors are dealt to blocks of ``block_rows``, each packed into one row. Blocks of queries meet
blocks of codes through an equi-join on the query block's number, so no task holds more than one of
each. Within a pair of blocks a query first takes the exact cosines of the ``FIRST`` best estimates;
then it reranks every vector whose upper bound reaches the k-th best of these, by the exact cosine
in double precision. The best ``k`` of each block are then ranked.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no
part, as query or candidate; vectors of another length are compared among themselves; a query skips
all rows with its own id, and rows with a null id are never queries but have no name as candidates
either, so they take no part; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import bounded_sample, cut_lineage

SAMPLE = 2000
FIRST = 48
#: Rounding of a cosine by a matrix product, and rows whose exact cosines one array takes.
MARGIN, SLICE = 1e-9, 1024


def rotation(d: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.RandomState(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, centred lengths, and inner products of turned vectors with their codes."""
    unit = vectors / np.sqrt((vectors ** 2).sum(axis=1))[:, None]
    rest = unit - centre
    length = np.sqrt((rest ** 2).sum(axis=1))
    turned = rest / np.where(length > 0, length, 1.0)[:, None] @ rotation(vectors.shape[1])
    signs = turned > 0
    own = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(signs, axis=1), length, own


def signs_of(codes: np.ndarray, d: int) -> np.ndarray:
    """Codes as unit vectors."""
    return (np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(d))


def bounds(signs: np.ndarray, length: np.ndarray, own: np.ndarray, centre: np.ndarray,
           queries: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of every query (rows) and coded vector (columns), and its error bound."""
    d = len(centre)
    unit = queries / np.sqrt((queries ** 2).sum(axis=1))[:, None]
    own = np.maximum(own, 1e-9)
    # Inner products of queries with centred unit vectors.
    inner = (unit @ rotation(d)).astype(np.float32) @ signs.T
    estimate = (unit @ centre).astype(np.float32)[:, None] + inner * (length / own).astype(np.float32)
    spread = np.sqrt(np.maximum(0.0, 1 - own ** 2)) / own
    return estimate, (epsilon * length * spread / np.sqrt(max(1, d - 1)) + 1e-5).astype(np.float32)


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, summed in the order of the components."""
    dot = np.cumsum(x * y, axis=1)[:, -1]
    return dot / np.sqrt(np.cumsum(x * x, axis=1)[:, -1] * np.cumsum(y * y, axis=1)[:, -1])


def _blocks(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "d": [rows["d"].iloc[0]],
                         "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
                         "vectors": [np.stack(rows["embedding"].to_list()).astype("<f4").tobytes()]})


def _coded(frames: Iterator[pd.DataFrame], shared) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = {"codes": [], "length": [], "own": []}
        for d, vectors in zip(frame["d"], frame["vectors"]):
            v = np.frombuffer(vectors, "<f4").reshape(-1, d).astype(np.float64)
            codes, length, own = encode(v, shared[int(d)])
            out["codes"].append(codes.tobytes())
            out["length"].append(length.astype("<f4").tobytes())
            out["own"].append(own.astype("<f4").tobytes())
        yield frame.assign(**out)


def _kth(ids: np.ndarray, scores: np.ndarray, k: int) -> float:
    """The k-th best score of different ids."""
    names, pos = np.unique(ids, return_inverse=True)
    if len(names) < k:
        return -np.inf
    top = np.full(len(names), -np.inf)
    np.maximum.at(top, pos, scores)
    return np.partition(top, -k)[-k]


def _nearest(at: np.ndarray, ids: np.ndarray, vectors: np.ndarray, unit: np.ndarray,
             query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows among ``at`` of the ``k`` best different ids and their exact cosines; ties by id.

    Every row whose rounded cosine is within ``MARGIN`` of the k-th best is compared exactly.
    """
    rounded = unit[at] @ query / np.sqrt(query @ query)
    kth = _kth(ids[at], rounded, k)
    near, score = np.empty(0, np.int64), np.empty(0)
    keep = at[rounded >= kth - MARGIN]
    for part in np.array_split(keep, 1 + len(keep) // SLICE):
        x = vectors[part].astype(np.float64)
        near, score = np.r_[near, part], np.r_[score, exact_cosine(x, np.broadcast_to(query, x.shape))]
        order = np.lexsort((ids[near], -score))
        order = order[np.sort(np.unique(ids[near[order]], return_index=True)[1])][:k]
        near, score = near[order], score[order]
    return near, score


def _searched(batches: Iterator[pa.RecordBatch], centres, k: int,
              epsilon: float) -> Iterator[pa.RecordBatch]:
    """Pairs of a query block and a coded block to the best k of each query."""
    for batch in batches:
        for row in batch.to_pylist():
            d = row["d"]
            qids = np.frombuffer(row["q_ids"], np.int64)
            queries = np.frombuffer(row["q_vectors"], "<f4").reshape(-1, d).astype(np.float64)
            ids = np.frombuffer(row["ids"], np.int64)
            vectors = np.frombuffer(row["vectors"], "<f4").reshape(-1, d)
            codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
            length, own = (np.frombuffer(row[c], "<f4").astype(np.float64) for c in ("length", "own"))
            signs, out = signs_of(codes, d), []
            unit = vectors.astype(np.float64)
            unit /= np.sqrt((unit ** 2).sum(axis=1))[:, None]
            for i in range(0, len(qids), 64):
                estimate, error = bounds(signs, length, own, centres[d], queries[i:i + 64], epsilon)
                for r, query in enumerate(queries[i:i + 64]):
                    guess = np.where(ids == qids[i + r], np.float32(-np.inf), estimate[r])
                    first = np.argpartition(-guess, min(FIRST, len(ids)) - 1)[:FIRST]
                    cosines = unit[first] @ query / np.sqrt(query @ query)
                    cosines[ids[first] == qids[i + r]] = -np.inf
                    kth = _kth(ids[first], cosines, k)
                    at = np.flatnonzero((guess + error >= kth - 1e-9) & (ids != qids[i + r]))
                    if len(at):
                        near, score = _nearest(at, ids, vectors, unit, query, k)
                        out += [(int(qids[i + r]), int(b), float(s), len(at))
                                for b, s in zip(ids[near], score)]
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64())],
                ["query_id", "vec_id", "score", "n_reranked"])


def search(vectors: DataFrame, is_query, k: int = 5, epsilon: float = 4.0,
           block_rows: int = 8192, query_rows: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of each query."""
    spark = vectors.sparkSession
    usable = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & (F.size("embedding") > 0)
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    rows = cut_lineage(vectors.select("vec_id", "embedding").filter(usable)
                       .withColumn("d", F.size("embedding"))
                       .withColumn("spot", F.monotonically_increasing_id()))
    sizes = {r["d"]: (r["n"], r["q"]) for r in rows.groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(is_query, 1).otherwise(0)).alias("q")).collect()}
    centres = {}
    for d in sizes:
        part = bounded_sample(rows.filter(F.col("d") == d), ["vec_id", "spot"], SAMPLE)
        x = np.array([r[0] for r in part.select("embedding").collect()], np.float64)
        centres[d] = (x / np.sqrt((x ** 2).sum(axis=1))[:, None]).mean(axis=0)

    def dealt(df, at, per_block):
        """Rows packed into blocks by a hash of their place, so that equal ids spread."""
        if not sizes:
            number = F.lit(0)
        else:
            count = F.element_at(F.create_map(*[F.lit(x) for d, s in sizes.items()
                                                for x in (d, max(1, -(-s[at] // per_block)))]), F.col("d"))
            number = F.pmod(F.xxhash64("spot"), count)
        return (df.withColumn("block", number.cast("long")).groupBy("d", "block")
                .applyInPandas(_blocks, "block long, d int, ids binary, vectors binary"))

    coded = dealt(rows, 0, block_rows).mapInPandas(
        lambda it: _coded(it, centres),
        "block long, d int, ids binary, vectors binary, codes binary, length binary, own binary")
    queries = dealt(rows.filter(is_query), 1, query_rows).select(
        "d", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"))
    blocks = {d: max(1, -(-s[1] // query_rows)) for d, s in sizes.items()}
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    last = F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]),
                        F.col("d")).cast("long")
    met = (coded.withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), last - 1)))
           .join(queries, ["d", "q_block"]))
    near = met.select("d", "q_ids", "q_vectors", "ids", "vectors", "codes", "length", "own").mapInArrow(
        lambda it: _searched(it, centres, k, epsilon),
        "query_id long, vec_id long, score double, n_reranked long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A query row that comes twice finds everything twice: each neighbour counts once.
    return (near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("vec_id") % 50 == 0)


ORACLE = r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND length(embedding) > 0
    AND length(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND length(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, length(q.e) + 1), lambda i: q.e[i] * c.e[i]))
         / sqrt(list_sum(list_transform(c.e, lambda x: x * x)) * list_sum(list_transform(q.e, lambda x: x * x))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND length(q.e) = length(c.e)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""
