"""Lexical search, pivot codes and repeated passages beside brute force and SQL."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from sitegauge.llm import lexical, passages, pivots

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def sql(query, **frames):
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    return con.sql(query).fetchall()


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ lexical search

def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranked(docs, items, k=10):
    terms = [TERM.findall(lower(t)) for _, t in docs]
    n_docs, total = sum(bool(t) for t in terms), sum(map(len, terms))
    df = {}
    for t in terms:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    merged = {}
    for i, t in items:
        merged.setdefault(i, set()).update(TERM.findall(lower(t)))
    out = []
    for i, words in merged.items():
        found = []
        for (doc, _), t in zip(docs, terms):
            score = 0
            for w in words:
                if tf := t.count(w):
                    m = 10 + 90 * len(t) * n_docs // total
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(i, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


DOCS = [(1, "The cat sat, THE cat_ran"), (2, None), (3, ""), (4, "cat " * 300), (None, "Émile's cat É"),
        (6, "the cat sat, the cat_ran"), (6, "the cat sat, the cat_ran"), (8, "caterpillar concat"),
        (9, "--- !!"), (10, "x" * 50_000 + " sat"), (11, "émile Zoë\x00ran　wide")]
ITEMS = [(7, "the cat"), (7, "sat sat"), (None, "Émile"), (2, None), (3, "!!"), (4, "ran zoë absent"),
         (5, "caterpillar")]


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 12])
def test_search_beside_brute_force(spark, block_bytes):
    docs = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, score long").repartition(3)
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, rank int")
    got = rows(lexical.search(docs, items, block_bytes=block_bytes), "item_id", "rank", "doc_id", "score")
    assert got == ranked(DOCS, ITEMS)


def test_search_keeps_ties_by_id(spark, monkeypatch):
    monkeypatch.setattr(lexical, "HELD", 3)
    many = [(i, "same words here" if i % 3 else "other words") for i in range(200, 0, -1)]
    docs = spark.createDataFrame(many, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    got = rows(lexical.search(docs, items, k=4), "item_id", "rank", "doc_id", "score")
    assert got == ranked(many, [(1, "same words")], k=4)


def test_best_is_cut_without_losing_ties():
    best = lexical._Best(2, 2)
    best.add(np.array([5, 0]), 3)
    best.add(np.array([5, 1]), 2)
    best.cut()
    best.add(np.array([4, 9]), 1)
    best.add(np.array([5, 9]), 1)
    item, score, doc, _ = best.cut()
    assert list(zip(item, score, doc)) == [(0, 5, 1), (0, 5, 2), (1, 9, 1), (1, 9, 1)]


@pytest.mark.parametrize("docs,items", [([], ITEMS), (DOCS, []), ([(1, None)], ITEMS)])
def test_search_of_nothing(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    found = lexical.search(d, i)
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


# ------------------------------------------------------------------ pivot codes

VEC = "vec_id long, embedding array<float>, label int"


def coded(table, n=256):
    """The dealt method by full search."""
    usable = [(i, v, lab) for i, v, lab in table if v is not None
              and all(x is not None and math.isfinite(x) for x in v)]
    if not usable:
        return []
    d = max(1, -(-max(len(v) for _, v, _ in usable) // 4)) * 4
    most = pivots.limit(d)
    x = [[max(-most, min(most, math.floor(1024 * float(np.float32(c))))) for c in v] + [0] * (d - len(v))
         for _, v, _ in usable]
    by = sorted(range(len(x)), key=lambda r: (usable[r][0] is None, usable[r][0] or 0,
                                              [float(np.float32(c)) for c in usable[r][1]]))
    w = d // 4
    books = [[x[r][p * w:(p + 1) * w] for r in by[:n]] for p in range(4)]

    def assign():
        out = []
        for v in x:
            row = []
            for p in range(4):
                part = v[p * w:(p + 1) * w]
                row.append(min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p])))
            out.append(row)
        return out

    for _ in range(4):
        found = assign()
        for p in range(4):
            for i in range(len(books[p])):
                mine = [x[r][p * w:(p + 1) * w] for r in range(len(x)) if found[r][p][1] == i]
                if mine:
                    books[p][i] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    error = [sum(s for s, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    by_label = {}
    for (_, _, lab), e in zip(usable, error):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), er, by_label[lab], digest)
                   for (i, _, lab), f, er in zip(usable, found, error)), key=repr)


COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_beside_full_search(spark, seed):
    rng = np.random.default_rng(seed)
    table = [(int(i), rng.normal(size=8).astype(np.float32).tolist(), int(i % 3) if i % 4 else None)
             for i in rng.permutation(400)]
    table += table[:20] + [(1000 + i, table[3][1], 1) for i in range(30)]  # repeated rows and copies
    df = spark.createDataFrame([(*t, "x") for t in table], VEC + ", code string").repartition(3)
    assert rows(pivots.op12(df), *COLUMNS) == coded(table)


@pytest.mark.parametrize("table", [
    [],
    [(1, None, 1), (2, [float("nan"), 1.0], 1), (3, [float("inf")], 2), (4, [None, 1.0], 2)],
    [(1, [], None)],
    [(None, [1.0, 2.0, 3.0], None), (2, [0.5] * 5, 7), (None, [1.0, -2.0], 7), (2, [0.25] * 8, None), (5, [], 1)],
    [(1, [1e30, -1e30, 3.0, 0.0], 1), (2, [-1e30, 2.0, 3e38, 1.0], 1), (3, [0.0] * 4, 2)],
])
def test_codes_of_odd_vectors(spark, table):
    assert rows(pivots.op12(spark.createDataFrame(table, VEC)), *COLUMNS) == coded(table)


def test_codes_beside_sql_and_pruning(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert rows(pivots.op12(df), *COLUMNS) == sorted(
        sql(pivots.ORACLE, embeddings=df.toArrow()), key=repr)
    found, _ = pivots.compress(df)
    visited = found.agg({"visited": "avg"}).first()[0]
    assert visited < 0.6 * 4 * min(256, df.count())


# ------------------------------------------------------------------ repeated passages

def cut(docs, length):
    first = {}
    for doc, text in docs:
        t, key = (text or "").encode(), math.inf if doc is None else doc
        for i in range(len(t) - length + 1):
            first[t[i:i + length]] = min(first.get(t[i:i + length], math.inf), key)
    out = []
    for doc, text in docs:
        t, key = (text or "").encode(), math.inf if doc is None else doc
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < key:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, kept))
    return sorted(out, key=repr)


def passed(df, length, **sizes):
    found = passages.repeated_passages(df, length, **sizes).collect()
    return sorted(((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept))
                   for r in found), key=repr)


SMALL = {"chunk_bytes": 700, "bucket_bytes": 500, "slice_bytes": 300}


@pytest.mark.parametrize("length,sizes", [(5, {}), (12, SMALL), (50, {}), (50, SMALL)])
def test_passages_beside_brute_force(spark, length, sizes):
    rng = random.Random(length)
    pool = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 90))) for _ in range(12)]
    docs = [(rng.choice([None, i, i % 7]) if i % 5 == 0 else i,
             "".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    docs += [(100, None), (101, ""), (None, docs[1][1]), *docs[:3]]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_bytes long").repartition(4)
    assert passed(df, length, **sizes) == cut(docs, length)


def test_passages_in_runs_of_one_byte(spark):
    docs = [(1, "a" * 9000), (2, "b" + "a" * 20_000 + "c"), (3, "a" * 49), (4, "a" * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert passed(df, 50) == [(1, 9000, 0, 0, b"a" * 9000), (2, 20_002, 20_000, 1, b"bc"),
                              (3, 49, 0, 0, b"a" * 49), (4, 50, 50, 1, b"")]


def test_common_phrase_in_different_contexts(spark):
    """A hot key is split into single windows and gives the same rows."""
    rng = random.Random(3)
    phrase = "all rights to this passage are kept by its owner, "
    docs = [(i, "".join(rng.choices("wxyz ", k=40)) + phrase + "".join(rng.choices("wxyz ", k=40)))
            for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert passed(df, 50, chunk_bytes=4000, slice_bytes=2000) == cut(docs, 50)


def test_no_passages(spark):
    assert passages.op13(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_common_prefixes_beside_sorting():
    rng = random.Random(4)
    for _ in range(60):
        data = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 200))) + bytes([passages.BORDER])
        depth = rng.randint(1, 20)
        order = passages.suffix_order(np.frombuffer(data, np.uint8), depth)
        found = passages.common_prefixes(np.frombuffer(data, np.uint8), order, depth)
        turned = [(data * (depth // len(data) + 2))[i:i + depth] for i in order]
        assert turned == sorted(turned)
        for k in range(1, len(order)):
            shared = next((i for i, (a, b) in enumerate(zip(turned[k - 1], turned[k])) if a != b), depth)
            assert found[k] == shared


def test_passages_and_search_beside_sql(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows(passages.op13(docs), *columns) == sorted(
        sql(passages.ORACLE, documents=docs.toArrow()), key=repr)
    assert rows(lexical.op11(docs, items), "item_id", "rank", "doc_id", "score") == sorted(
        sql(lexical.ORACLE, documents=docs.toArrow(), benchmark=items.toArrow()), key=repr)


# ------------------------------------------------------------------ very long texts

def test_line_dedup_of_a_million_lines(spark):
    from sitegauge.llm import linededup
    n = 1_000_000
    one = "\n".join(f"a line of its own number {i}" for i in range(n))
    two = "\n".join(f"a line of its own number {i}" if i % 2 else f"another line with number {i}" for i in range(n))
    df = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.op5(df).collect()}
    kept = "\n".join(two.split("\n")[::2])
    assert (got[1].n_lines, got[1].n_dropped) == (n, 0)
    assert (got[2].n_lines, got[2].n_dropped) == (n, n // 2)
    assert got[2].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_personal_data_in_a_run_of_a_million_characters():
    from sitegauge.llm import pii
    text = "x@ " + "a" * 1_000_000 + " " + "7" * 1_000_000 + " me@example.org 1.2.3.4"
    end = len(text)
    assert pii.base_spans(text) == [(end - 22, end - 8, 0), (end - 7, end, 1)]


def test_base_spans_beside_the_plain_patterns():
    """Leftmost matches of the patterns as the contract states them."""
    from sitegauge.llm import pii
    plain = [re.compile(p) for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("ab1.2@@-+_ 0(é\n") for _ in range(rng.randint(0, 40)))
        want = sorted(((m.start(), m.end(), k) for k, p in enumerate(plain) for m in p.finditer(text)
                       if pii.passes(k, m[0])), key=lambda s: (s[0], s[2]))
        assert pii.base_spans(text) == want, text
    assert pii.passes(1, "0" * 30 + "1.2.3.255") and not pii.passes(1, "1.2.3.256")
