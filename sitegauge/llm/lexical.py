"""Ranked lexical search: an Aho-Corasick automaton of all item terms scans the documents.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A scan
turns every other character of a text into the guard, a space, and puts one at both ends; patterns
are terms between two guards, so only whole terms match, and a guard may end one and start the next.
There is no index of the documents: both passes count in the texts themselves.

1. The first scan counts, for every item term, the documents that hold it, and sums up documents
   and terms. Tasks send one row per term; the driver gets a weight for each.
2. The second scan counts every term in a document; the automaton's outputs lead to the items of
   the term, whose scores add up in whole numbers. A task keeps the best ``k`` documents of each item,
   and these are ranked in two rounds.

Items are cut into blocks of about ``block_bytes`` by a running sum of their terms' bytes; each block
has its own automaton, which is all that travels to the tasks, and its own two scans. The distinct
terms of one item stay together.

Defined results: a null or empty text has no term, and a document or item without terms ranks
nowhere; rows with one item id (null too) make one item of all their terms; every document row ranks
by itself, and equal scores go by ascending id, null last; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import LOWER, UPPER, ascii_lower, cut_lineage, running_totals, texts_of

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 8 << 20
#: Candidates a task holds before it keeps the best of each item, and shares of the first ranking.
HELD, SHARES = 200_000, 32
NO_ID = (1 << 63) - 1
_GUARDS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()
_DOCS, _TERMS = -1, -2  # numbers of the totals beside those of terms


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of each item that has any."""
    term = F.explode(F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))))
    return (items.select("item_id", term.alias("term")).distinct()
            .groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")))


def guarded(text: bytes) -> bytes:
    return b" " + text.translate(_GUARDS) + b" "


def automaton(terms: list[str]):
    """Matches of guarded terms, with their numbers. Bytes stand as characters of one byte each."""
    out = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        out.add_word(guarded(term.encode()).decode("latin-1"), i)
    out.make_automaton()
    return out


def n_terms(text: bytes) -> int:
    """Terms of a guarded text."""
    inside = np.frombuffer(text, np.uint8) != 32
    return int(np.count_nonzero(inside[1:] > inside[:-1]))


def _holders(batches: Iterator[pa.RecordBatch], terms: list[str]) -> Iterator[pa.RecordBatch]:
    """First scan: documents that hold each term, all documents with terms, and their terms."""
    find, number = automaton(terms), itemgetter(1)
    holders: Counter[int] = Counter()
    for batch in batches:
        for text in map(guarded, texts_of(batch.column("text"))):
            if n := n_terms(text):
                holders[_DOCS] += 1
                holders[_TERMS] += n
                holders.update(set(map(number, find.iter(text.decode("latin-1")))))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(holders), pa.int64()), pa.array(list(holders.values()), pa.int64())], ["term", "n"])


class _Best:
    """The best ``k`` documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)  # only scores above 0
        self.rows, self.held = [], 0

    def add(self, scores: np.ndarray, doc_id: int | None):
        at = np.flatnonzero(scores >= self.least)
        if len(at):
            self.rows.append((at, scores[at], np.full(len(at), NO_ID if doc_id is None else doc_id),
                              np.full(len(at), doc_id is None)))
            self.held += len(at)
            if self.held > HELD + self.k * len(self.least):
                self.cut()

    def cut(self):
        """Keep the best of each item; a later document needs at least the score of its last."""
        if not self.rows:
            return (np.empty(0, np.int64),) * 4
        item, score, doc, null = (np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        first = np.flatnonzero(np.r_[True, np.diff(item) != 0])
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        keep = place < self.k
        item, order, place = item[keep], order[keep], place[keep]
        kept = (item, score[order], doc[order], null[order])
        full = place == self.k - 1
        self.least[item[full]] = kept[1][full]
        self.rows, self.held = [kept], len(item)
        return kept


def _ranked(batches: Iterator[pa.RecordBatch], terms: list[str], weights: np.ndarray, ids: list,
            starts: np.ndarray, owners: np.ndarray, docs: int, all_terms: int,
            k: int) -> Iterator[pa.RecordBatch]:
    """Second scan: the best documents of each item in this task."""
    find, number = automaton(terms), itemgetter(1)
    best = _Best(len(ids), k)
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), map(guarded, texts_of(batch.column("text")))):
            counts = Counter(map(number, find.iter(text.decode("latin-1"))))
            if not counts:
                continue
            term = np.fromiter(counts.keys(), np.int64, len(counts))
            tf = np.fromiter(counts.values(), np.int64, len(counts))
            m = 10 + 90 * n_terms(text) * docs // all_terms
            gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            n = starts[term + 1] - starts[term]
            at = np.arange(n.sum()) + np.repeat(starts[term] - np.cumsum(n) + n, n)
            if gain.sum() < 1 << 53:  # doubles hold these whole numbers
                score = np.bincount(owners[at], np.repeat(gain, n), len(ids)).astype(np.int64)
            else:
                score = np.zeros(len(ids), np.int64)
                np.add.at(score, owners[at], np.repeat(gain, n))
            best.add(score, doc_id)
    item, score, doc, null = best.cut()
    yield pa.RecordBatch.from_arrays(
        [pa.array([ids[i] for i in item], pa.int64()), pa.array(doc, pa.int64(), mask=null.astype(bool)),
         pa.array(score, pa.int64())], ["item_id", "doc_id", "score"])


def _scan(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """Candidates of one block of items."""
    terms = sorted({t for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    held = docs.select("text").mapInArrow(lambda it: _holders(it, terms), "term long, n long")
    counts = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n, total = counts.get(_DOCS, 0), counts.get(_TERMS, 0)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(i, 0) + 1)))
                        for i in range(len(terms))], np.int64)
    pairs = sorted((number[t], i) for i, r in enumerate(rows) for t in r["terms"])
    owners = np.array([i for _, i in pairs], np.int64)
    starts = np.searchsorted(np.array([t for t, _ in pairs]), np.arange(len(terms) + 1))
    ids = [r["item_id"] for r in rows]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda it: _ranked(it, terms, weights, ids, starts, owners, n, total, k),
        "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item."""
    spark = docs.sparkSession
    sized = item_terms(items.select(F.col("item_id").cast("long").alias("item_id"), "text")).withColumn(
        "size", F.expr("aggregate(terms, 0L, (n, t) -> n + octet_length(t) + 8)"))
    placed = cut_lineage(
        running_totals(sized, [F.col("item_id").asc_nulls_last()], {"before": F.col("size")})
        .select("item_id", "terms", F.floor(F.col("before") / block_bytes).alias("block")))
    blocks = [r["block"] for r in placed.select("block").distinct().orderBy("block").collect()]
    found = []
    for block in blocks:  # the driver holds the terms of one
        part = _scan(docs, placed.filter(F.col("block") == block).orderBy("item_id").collect(), k)
        found.append(part if len(blocks) == 1 else cut_lineage(part))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
    rank = F.row_number()
    return (reduce(DataFrame.unionByName, found).withColumn("share", share)
            .withColumn("rank", rank.over(Window.partitionBy("item_id", "share").orderBy(*best)))
            .filter(F.col("rank") <= k)
            .withColumn("rank", rank.over(Window.partitionBy("item_id").orderBy(*best)))
            .filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))


def op11(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


ORACLE = rf"""
WITH doc_terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE text IS NOT NULL)),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM tfs GROUP BY r),
totals AS (SELECT count(*)::BIGINT AS N_, sum(n)::BIGINT AS L_ FROM sizes),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * N_ + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM dfs, totals),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_) // L_))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (r), totals
  GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0) WHERE rank <= 10
"""
