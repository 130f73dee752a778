"""Searches in pairs of blocks: whole results, and nothing copied per pair."""

import random

import numpy as np
from pyspark.sql import functions as F

from sitegauge.functions import blocks as bl
from sitegauge.operators import linking as li


def plan(df):
    return df._jdf.queryExecution().toString()


def test_bit_rows_beside_sets():
    rng = random.Random(3)
    items = [{rng.randrange(40) for _ in range(rng.randrange(9))} for _ in range(130)]
    table = bl.BitTable(np.array([k for s in items for k in s]), np.zeros(sum(map(len, items)), int),
                        np.repeat(np.arange(130), [len(s) for s in items]), 130, 1)
    words = bl.Words([[rng.randrange(60) for _ in range(5)] for _ in range(20)])
    number, rows = table.rows(words.keys)
    flags = np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little")
    for key, n in zip(words.keys, number):
        assert {i for i in range(130) if flags[n, i]} == {i for i, s in enumerate(items) if key in s}


def test_highest_beside_sorting():
    rng = np.random.default_rng(5)
    flags, gains, total = rng.random((4, 7, 192)) < 0.4, [50, 3, 3, 10], []
    total.append(np.zeros((7, 3), np.uint64))
    for f, gain in zip(flags, gains):
        bl.add(total, bl.as_bits(f.astype(np.uint8)), gain)
    points = sum(f * g for f, g in zip(flags, gains))
    want = [[(c, points[r, c]) for c in np.argsort(-points[r], kind="stable")[:5]] for r in range(7)]
    got = [[] for _ in range(7)]
    for row, column, value in bl.highest(total, 5):
        for r, c, v in zip(row, column, value):
            got[r].append((c, v))
    assert got == want


def test_coverage_copies_no_rows_per_pair(spark):
    q = spark.range(6).select(F.col("id").alias("query_id"), F.array(F.lit("a")).alias("q_tok"))
    none = F.array().cast("array<string>")
    f = spark.range(9).select(F.concat(F.lit("s"), F.col("id")).alias("slug"), *[
        (F.array(F.lit("a")) if c == "code" else none).alias(c) for c in li.FIELDS])
    got = li.best_articles(q, f, q_rows=2, i_rows=2)
    assert "CartesianProduct" in plan(got) and "explode" not in plan(got)
    assert {(r.best_match_slug, round(r.match_score * 145)) for r in got.collect()} == {("s0", 40)}


def test_article_search_copies_no_rows_per_pair(spark):
    q = spark.createDataFrame([(i, "404 pull docker") for i in range(5)], "query_id int, query string")
    a = spark.createDataFrame([(f"s{i}", "docker pull" if i % 2 else "none", "404", "/posts/x/") for i in range(9)],
                              "slug string, title string, code string, permalink string")
    got = li.search_articles(q, a, k=3, q_rows=2, i_rows=2)
    assert "CartesianProduct" in plan(got) and "explode" not in plan(got)
    assert {(r.slug, r.search_rank) for r in got.collect()} == {("s1", 0), ("s3", 0), ("s5", 0)}


def test_case_search_copies_no_rows_per_pair(spark):
    q = spark.createDataFrame([(i, "pull access denied") for i in range(5)], "query_id int, query string")
    c = spark.createDataFrame([(i, "Docker", "", "", "", "", ["pull access denied" if i > 3 else "no"], [])
                               for i in range(9)],
                              "case_id int, service string, code string, name string, cause string, "
                              "situation string, messages array<string>, aliases array<string>")
    got = li.search_cases(q, c, k=2, q_rows=2, i_rows=2)
    assert "CartesianProduct" in plan(got) and "explode" not in plan(got)
    assert {(r.case_id, r.position) for r in got.collect()} == {(4, 1), (5, 2)}


CASE = ("case_id int, service string, code string, name string, cause string, "
        "situation string, messages array<string>, aliases array<string>")


def test_case_ranks_store_packed_blocks_only(spark):
    """Cases are read once for their blocks: no stored copy, no join, no exchange but that of the blocks."""
    q = spark.createDataFrame([(i, "pull access denied") for i in range(5)], "query_id int, query string")
    c = spark.createDataFrame([(i, "Docker", "", "", "", "", ["pull access denied" if i > 3 else "no"], [])
                               for i in range(9)], CASE).coalesce(1)
    got = li.rank_cases(q, c, 2, i_rows=2)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in text and text.count("Join") == 1  # the pairs of blocks
    items = text[text.index("Repartition"):text.rindex("Repartition")]
    assert "i#" in items and "FlatMapGroups" not in items
    assert {(r.case_id, r.case_rank, r.position) for r in got.collect()} == {(4, -34.5, 1), (5, -34.5, 2)}


def test_blocks_of_items_are_bounded(spark):
    """A partition is cut into blocks of the given rows and characters; a longer item stands alone."""
    items = spark.createDataFrame([(i, "x" * n) for i, n in enumerate((3, 3, 3, 50, 1, 1, 1, 1))],
                                  "i int, t string").coalesce(1)
    q = spark.createDataFrame([(0,)], "q int")

    def search(q, sizes):
        yield np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([1000 * len(sizes) + sum(sizes)])

    got = bl.in_blocks(q, items, F.lit(1), F.length("t"), lambda q: None, lambda i: [len(t) for t in i["t"]], search,
                       "q int, i int, n long", 9, i_rows=3, i_chars=8)
    assert sorted((r.i, r.n) for r in got.collect()) == [(0, 2006), (2, 1003), (3, 1050), (4, 3003), (7, 1001)]
