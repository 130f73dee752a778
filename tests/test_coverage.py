"""Coverage of queries by articles: tokens of long texts, and blocks that leave out what cannot win."""

import random

import numpy as np
import pandas as pd

from sitegauge.functions import blocks as bl
from sitegauge.functions import text as tx
from sitegauge.operators import linking as li


def test_text_tokens_equal_tokens(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("aZ09 é語ΣКK😀.,'-_/\n\t", k=rnd.randint(0, 30))) for _ in range(300)] + [None, "", "aé"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    assert df.filter(~tx.tokens("t").eqNullSafe(tx.text_tokens("t"))).count() == 0
    text = df.select(tx.text_tokens("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in text


def made(seed, n):
    rnd = random.Random(seed)
    w = [f"w{i}" for i in range(40)]
    some = lambda a, b: rnd.sample(w, rnd.randint(a, b))
    return [(f"s{rnd.randrange(10 ** 6)}-{i}", *(some(0, 1) if f in ("svc", "code") else some(0, 5) for f in li.FIELDS))
            for i in range(n)], [(i, some(0, 6)) for i in range(50)]


def points(q, item):
    return sum(sum(li.COVERAGE_POINTS[f][:len(set(q) & set(words))]) for f, words in zip(li.FIELDS, item[1:]))


def test_best_articles_beside_all_pairs(spark):
    for seed in (1, 2):
        items, queries = made(seed, 90)
        f = spark.createDataFrame(items, "slug string, " + ", ".join(f"{c} array<string>" for c in li.FIELDS))
        q = spark.createDataFrame(queries, "query_id int, q_tok array<string>")
        want = []
        for i, words in queries:
            best, slug = min(((-points(words, x), x[0]) for x in items), default=(0, ""))
            want.append((i, slug if best else "", -best))
        for sizes in ({}, {"q_rows": 9, "i_rows": 4}):
            got = li.best_articles(q, f, **sizes).collect()
            assert sorted((r.query_id, r.best_match_slug, round(r.match_score * 145)) for r in got) == want


def test_named_articles_only_once_a_query_has_more_points():
    """Before, every block gave its best article of every query, and looked at all of its articles for that."""
    def block(items):
        a = pd.DataFrame(items, columns=["slug", *li.FIELDS])
        key = [w for f in li.FIELDS for x in a[f] for w in x]
        plane = [i for i, f in enumerate(li.FIELDS) for x in a[f] for _ in x]
        column = [n for f in li.FIELDS for n, x in enumerate(a[f]) for _ in x]
        return (vars(bl.BitTable(np.array(key), np.array(plane), np.array(column), len(a), len(li.FIELDS))),
                np.arange(len(a)))

    none = [[] for _ in li.FIELDS]
    state = vars(bl.Words([[1, 2, 3]]))
    found = [list(map(int, (c[0], p[0]))) for _, c, p in li._coverage(state, block([
        ("a", [], [1], [2, 3], [], [], [], [1])]))]  # 40 + 20 + 10
    weak = ("b", [], [], [1, 2], [1], [1, 2, 3], [1], [1])  # all fields but those that name it
    assert found == [[0, 70]] and li.WEAK == 55 and sum(len(r) for r, _, _ in li._coverage(state, block([weak]))) == 0
    better = ("c", [2], [1], *none[2:])
    found = [list(map(int, (c[0], p[0]))) for _, c, p in li._coverage(state, block([weak, better]))]
    assert found == [[1, 90]]


def brute_search(queries, articles, k):
    out = []
    for qid, code, terms in queries:
        found = []
        for slug, title, own, cls in articles:
            hits, same = sum(t in title for t in terms), bool(code) and own == code
            tool = bool(terms) and hits == len(terms)
            if same or hits:
                rank = (0 if tool else 1) if same else 2 if tool and code else 3 + cls
                late = rank > 2 and not code and not tool
                found.append((rank, cls, late, slug))
        out += [(qid, s, r, n + 1) for n, (r, _, _, s) in enumerate(sorted(found)[:k])]
    return sorted(out)


def test_article_search_beside_all_pairs(spark):
    """With few and many articles of a code, with ties by slug over all codes, in one block and in many."""
    rnd = random.Random(8)
    w = ["".join(rnd.choices("abcé", k=rnd.randint(1, 3))) for _ in range(30)]
    codes = ["", "404", "500", "403"]
    articles = []
    for i in range(150):
        cls = rnd.choice((0, 0, 1, 2))
        code = rnd.choice(codes[1:]) if cls == 0 else rnd.choice(codes) if cls == 2 else ""
        articles.append((f"s{rnd.randrange(10 ** 6):06d}", " ".join(rnd.choices(w, k=rnd.randint(0, 5))), code, cls))
    queries = [(i, rnd.choice([*codes, "599"]), list(dict.fromkeys(rnd.choices(w, k=rnd.randint(0, 4))))) for i in range(60)]
    a = spark.createDataFrame([(s, t, c, "/glossary/" if cls == 2 else "/posts/") for s, t, c, cls in articles],
                              "slug string, title string, code string, permalink string").coalesce(2)
    q = spark.createDataFrame([(i, " ".join([c, *t]).strip()) for i, c, t in queries], "query_id int, query string")
    for k in (2, 10):
        want = brute_search(queries, articles, k)
        for sizes in ({}, {"q_rows": 20, "i_rows": 7}, {"i_rows": 70}):
            got = li.search_articles(q, a, k, **sizes).collect()
            assert sorted((r.query_id, r.slug, r.search_rank, r.position) for r in got) == want


def test_queries_with_enough_articles_of_their_code_look_at_these_only():
    """Before, a block without the code of a query still gave its best articles for it."""
    def block(codes):
        a = pd.DataFrame({"t": ["pull docker"] * len(codes)})
        return vars(bl.Held(a["t"])), np.array(codes, object), np.zeros(len(codes), np.int64), np.arange(len(codes))

    q = vars(bl.Words([["docker"]])), np.array(["404"], object)
    found = lambda codes: sum(len(r) for r, _, _ in li._articles_found(q, block(codes), 2))
    assert [found(c) for c in (["500"], ["404", "404"], ["500"] * 3, ["404"])] == [1, 2, 0, 1]
