import random

from pyspark.sql import functions as F

from sitegauge.functions.pyudf import possible_terms
from sitegauge.operators import linking as li
from sitegauge.operators import termlinks as te

CASE = ("case_id string, service string, code string, name string, cause string, situation string, "
        "messages array<string>, aliases array<string>")


def ranked(spark, query, cases):
    """(case, signal, message), best first; cases without a signal come last."""
    q = spark.createDataFrame([("q", query)], "query_id string, query string")
    c = spark.createDataFrame(cases, CASE)
    found = [(x.case_id, True, x.message) for x in li.search_cases(q, c).orderBy("position").collect()]
    return found + [(c[0], False, "") for c in cases if c[0] not in {f[0] for f in found}]


PULL = "pull access denied"


def test_pasted_pull_error(spark):
    q = ("Error response from daemon: pull access denied for example, repository does not exist "
         "or may require 'docker login'")
    got = ranked(spark, q, [
        ("secret", "Kubernetes", "ErrImagePull", "ErrImagePull", "imagePullSecretが不足している", None, [PULL], []),
        ("auth", "Docker", PULL, PULL, "非公開リポジトリへ未認証でアクセスしている", None,
         ["may require 'docker login'"], ["requested access to the resource is denied"]),
        ("repo", "Docker", PULL, PULL, "リポジトリ名、所有者名、Registryが違う", None,
         ["repository does not exist"], ["pull access denied for"])])
    assert [g[0] for g in got][:2] == ["repo", "auth"]
    assert got[0][1:] == (True, "repository does not exist")


def test_message_before_cause(spark):
    got = ranked(spark, "repository does not exist", [
        ("cause", "Docker", PULL, PULL, "repository does not exist", None, ["access denied"], []),
        ("message", "Docker", PULL, PULL, "参照名が違う", None, ["repository does not exist"], [])])
    assert got[0][0] == "message"


def test_situation_and_missing_code(spark):
    q = "ローカルではpullできるがCIでは失敗する"
    got = dict((c, s) for c, s, _ in ranked(spark, q, [
        ("with", "Docker", PULL, PULL, "CIだけ別の認証設定を使っている", q, [], []),
        ("without", "Docker", PULL, PULL, "", None, [], [])]))
    assert got == {"with": True, "without": False}
    miss = ranked(spark, "Docker 500", [
        ("x", "Docker", PULL, PULL, "CIだけ別の認証設定を使っている", "CI環境でのみ発生する",
         ["may require 'docker login'"], [])])
    assert miss[0][1] is False


def article_order(spark, query, hits):
    """Titles in order of the search; equal ranks go by the slug, here the score."""
    a = spark.createDataFrame([(f"{s:.3f}-{i}", t, c, p) for i, (t, c, p, s) in enumerate(hits)],
                              "slug string, title string, code string, permalink string")
    q = spark.createDataFrame([(1, query)], "query_id int, query string")
    return [r.title for r in li.search_articles(q, a).join(a, "slug").orderBy("position").collect()]


HITS = [("Docker の 400 エラー", "400", "/posts/docker-400/", 0.05),
        ("Docker の 500 エラー", "500", "/posts/docker-500/", 0.15),
        ("GitHub API の 401 エラー", "401", "/posts/github-api-401/", 0.15),
        ("Nginx の 500 エラー", "500", "/posts/nginx-500/", 0.01),
        ("Docker とは", "", "/glossary/docker/", 0.001)]


def test_article_search_order(spark):
    first = lambda q: article_order(spark, q, HITS)[0]
    assert first("docker 400") == "Docker の 400 エラー"
    assert first("github 401") == "GitHub API の 401 エラー"
    assert first("500") == "Nginx の 500 エラー"
    assert first("docker　　500") == "Docker の 500 エラー"
    assert first("DOCKER 500") == "Docker の 500 エラー"
    assert first("docker") == "Docker の 400 エラー"
    assert article_order(spark, "docker 500", HITS)[1] == "Nginx の 500 エラー"


def test_coverage_is_exact_for_any_block_size(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(12)]

    def some(k):
        return rnd.sample(vocab, k)

    fields = [(f"a{i:03d}", some(1), some(1), some(2), some(1), some(4), some(1), some(2)) for i in range(60)]
    queries = [(f"q{i}", some(rnd.randint(1, 6))) for i in range(30)]
    f = spark.createDataFrame(fields, "slug string, svc array<string>, code array<string>, comp array<string>, "
                              "tag array<string>, title array<string>, rel array<string>, tq array<string>")
    q = spark.createDataFrame(queries, "query_id string, q_tok array<string>")

    def score(q, a):
        _, svc, code, comp, tag, title, rel, tq = a
        hit = lambda x: bool(set(x) & set(q))
        n = lambda x: len(set(x) & set(q))
        return (5 * hit(svc) + 4 * hit(code) + min(n(comp), 2) + hit(tag) + min(n(title) * .3, 1)
                + .5 * hit(rel) + hit(tq)) / 14.5

    want = {qid: max((round(score(t, a), 9), -i) for i, a in enumerate(fields)) for qid, t in queries}
    for sizes in ({}, {"q_rows": 7, "i_rows": 11}):
        rows = li.best_articles(q, f, **sizes).collect()
        assert len(rows) == len(queries)
        for r in rows:
            best, i = want[r.query_id]
            assert abs(r.match_score - best) < 1e-8
            assert r.best_match_slug == (fields[-i][0] if best > 0 else ""), (sizes, r)


def test_related_items_with_one_dominant_service(spark):
    rnd = random.Random(9)
    types, parts = ["t0", "t1", "guide"], ["x", "y", "z", "w"]
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", rnd.choice(types), rnd.sample(parts, 2)) for i in range(80)]
    got = {}
    df = spark.createDataFrame(rows, "item int, service string, error_type string, components array<string>")
    for r in li.related_items(df, k=7, guide="guide").collect():
        got.setdefault(r.item, []).append((-r.score, r.related))
    for a in rows:
        pairs = []
        for b in rows:
            if a[0] != b[0]:
                s = (5 + (100 if b[2] == "guide" else 0)) * (a[1] == b[1]) + (a[2] == b[2]) + 3 * len(set(a[3]) & set(b[3]))
                if s >= 3:
                    pairs.append((-s, b[0]))
        assert sorted(got[a[0]]) == sorted(pairs)[:7]


def same_code(rows, k):
    out = []
    for item, code, tags in rows:
        if code:
            free = [i for i, c, t in rows if c == code and i != item and not set(t) & set(tags)]
            out += [(item, i) for i in sorted(free)[:k]]
    return sorted(out)


def test_same_code_without_shared_tags(spark):
    """Tags that nearly all items share, items without tags, and codes of very different sizes."""
    rnd = random.Random(4)
    rows = [(i, "hot" if i % 3 else f"c{i % 4}" if i % 2 else "", rnd.sample("abcdefgh", rnd.choice([0, 1, 2, 5, 7]))
             + (["all"] if i % 40 else [])) for i in range(500)]
    df = spark.createDataFrame(rows, "item int, code string, tags array<string>").repartition(5)
    for block in (2, 64):
        got = sorted((r.item, r.related) for r in li.same_code_other_tags(df, 3, block).collect())
        assert got == same_code(rows, 3)
    assert li.same_code_other_tags(df.limit(0)).count() == 0


def test_same_code_with_many_tag_sets(spark):
    """100,000 different tag sets in one code are not paired with each other."""
    df = spark.range(100_000).select(
        F.col("id").alias("item"), F.lit("one").alias("code"),
        F.array(F.concat(F.lit("t"), F.col("id").cast("string")), F.concat(F.lit("u"), (F.col("id") % 9).cast("string"))).alias("tags"))
    got = li.same_code_other_tags(df).filter("item in (0, 5, 99999)").collect()
    assert sorted((r.item, r.related) for r in got) == [
        (0, 1), (0, 2), (0, 3), (5, 0), (5, 1), (5, 2), (99999, 1), (99999, 2), (99999, 3)]


def test_occurrences_beside_brute_force(spark):
    rnd = random.Random(6)
    some = lambda n: "".join(rnd.choices("abcé ", k=n))
    texts = [(i, some(rnd.randint(0, 60))) for i in range(80)] + [(80, None), (3, "again abc")]
    terms = sorted({some(rnd.randint(1, 5)) for _ in range(200)}) + ["abc abc", "é", "  ", "", "ab  c"]
    t = spark.createDataFrame([(x,) for x in terms + terms[:5]], "term string")
    df = spark.createDataFrame(texts, "i int, body string").repartition(3)
    got = sorted((r.i, r.term) for r in te.term_occurrences(t, df, "i").collect())
    words = {x.strip(" ") for x in terms} - {""}
    assert got == sorted({(i, x) for i, body in texts for x in words if x in (body or "")})
    assert te.term_occurrences(t.limit(0), df, "i").count() == te.term_occurrences(t, df.limit(0), "i").count() == 0


def test_bounded_terms_beside_brute_force(spark):
    import re
    rnd = random.Random(7)
    some = lambda n: "".join(rnd.choices("ab1éカ+ ", k=n))
    texts = [(i, some(rnd.randint(0, 60))) for i in range(80)]
    terms = sorted({some(rnd.randint(2, 6)).strip() for _ in range(300)} - {""})
    terms = [x for x in terms if len(x) > 1]
    t = spark.createDataFrame([(x,) for x in terms], "term string")
    df = spark.createDataFrame(texts, "i int, body string").repartition(3)
    got = sorted((r.i, r.term) for r in te.dictionary_hits(t, df, "i").collect())

    def bounded(x):
        cls = lambda c: "[A-Za-z0-9]" if c in "ab1" else "[ァ-ヿ]" if c == "カ" else None
        left, right = cls(x[0]), cls(x[-1])
        return (f"(?<!{left})" if left else "") + re.escape(x) + (f"(?!{right})" if right else "")

    assert got == sorted((i, x) for i, body in texts for x in terms if re.search(bounded(x), body))


def test_a_large_dictionary(spark):
    """100,000 terms: each text meets its own terms only."""
    terms = spark.range(100_000).select(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("x")).alias("term"))
    texts = spark.createDataFrame([(1, "w12x and vw99999xy"), (2, "w100000x w7x"), (3, "none")], "i int, body string")
    found = sorted((r.i, r.term) for r in te.term_occurrences(terms, texts, "i").collect())
    assert found == [(1, "w12x"), (1, "w99999x"), (2, "w7x")]
    hits = sorted((r.i, r.term) for r in te.dictionary_hits(terms, texts, "i").collect())
    assert hits == [(1, "w12x"), (2, "w7x")]
    linked = te.link_terms(texts, terms.withColumn("url", F.concat(F.lit("/g/"), "term", F.lit("/"))), "i")
    assert {r.i: r.linked for r in linked.collect()} == {
        1: "[w12x](/g/w12x/) and vw99999xy", 2: "w100000x [w7x](/g/w7x/)", 3: "none"}


def test_first_documents_beside_brute_force(spark, monkeypatch):
    """Also where most parts share a hash with some term; texts are read once, few rows leave a batch."""
    rnd = random.Random(8)
    some = lambda n: "".join(rnd.choices("abé カ1", k=n))
    texts = [(rnd.randrange(300), some(rnd.randint(0, 40))) for _ in range(200)] + [(7, None)]
    words = {some(rnd.randint(1, 4)).strip(" ") for _ in range(60)} - {""}
    t = spark.createDataFrame([(x,) for x in words], "term string")
    df = spark.createDataFrame(texts, "i long, body string").repartition(3)
    want = sorted((x, i) for x in words for i in sorted({i for i, body in texts if x in (body or "")})[:3])
    for least, most in ((te.LEAST, te.MOST), (1 << 15, 1 << 15)):
        monkeypatch.setattr(te, "LEAST", least)
        monkeypatch.setattr(te, "MOST", most)
        got = te.term_documents(t, df, "i", 3)
        assert sorted((r.term, r.i) for r in got.collect()) == want
    every = {"low": 1, "high": 4, "mask": 7, "bits": b"\xff", "starts": b"\xff"}  # every part may be a term
    rows = possible_terms(df.coalesce(1), "i", every, False, 3)
    assert max(r["count"] for r in rows.groupBy("term").count().collect()) == 3
    many = possible_terms(df.coalesce(1), "i", every, True)
    assert many.count() > many.filter(F.length("term") > 2).count() > 0


def test_texts_are_read_once_for_terms_without_spaces(spark):
    t = spark.createDataFrame([("abc",), ("b+c",)], "term string")
    df = spark.createDataFrame([(1, "abc xabc b+c")], "i int, body string")
    for got in (te.dictionary_hits(t, df, "i"), te.term_occurrences(t, df, "i"), te.term_documents(t, df, "i")):
        text = got._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("MapInArrow") == 1 and "Generate" not in text and text.count("Join") == 1


def test_dictionary_hits_need_clean_boundaries(spark):
    terms = spark.createDataFrame([("ポート",), ("HTTP",), ("docker compose",), ("C++",)], "term string")
    texts = spark.createDataFrame([(1, "サポート HTTPS"), (2, "このポートをHTTPで"), (3, "docker compose up"),
                                   (4, "docker composer, C++ と")], "i int, body string")
    got = sorted((r.i, r.term) for r in te.dictionary_hits(terms, texts, "i").collect())
    assert got == [(2, "HTTP"), (2, "ポート"), (3, "docker compose"), (4, "C++")]


def test_incidents_match_both_directions(spark):
    arts = spark.createDataFrame([(1, "GitHub API", ["Actions"]), (2, "Git", []), (3, "", ["iam"]), (4, "", [])],
                                 "id int, service string, components array<string>")
    inc = spark.createDataFrame([("GitHub", ["IAM"]), ("", ["none"])], "service string, keywords array<string>")
    assert sorted(r.id for r in li.match_incidents(arts, inc, "id").collect()) == [1, 2, 3]


def test_title_rules(spark):
    q = {"docker 404 pull": "Docker 404 Pull エラー：原因と解決策", "aws access denied":
         "AWS Access Denied 認証・権限エラー：原因と解決策", "npm tls handshake": "NPM TLS Handshake SSL/TLS エラー：解決方法"}
    df = spark.createDataFrame([(k,) for k in q], "q string")
    assert {r.q: r.t for r in df.select("q", li.suggest_title(F.col("q")).alias("t")).collect()} == q


def brute_cases(queries, cases, k):
    """All cases of all queries by plain string search; words are already normalized."""
    out = []
    for qid, query in queries:
        words = [w for w in query.split() if len(w) > 1 and w not in ("error", "from")]
        rows = []
        for cid, messages, code, name, service, situation, aliases, cause in cases:
            fields = {"m": " ".join(messages), "code": code, "name": name, "service": service,
                      "sit": situation, "al": " ".join(aliases), "cause": cause}
            own = [w for w in service.split() if len(w) > 1 and w not in ("error", "from")]
            whole = [m for m in messages if m and m in query]
            free = [w for w in words if w not in own]
            if whole:
                message = max(whole, key=len)
            else:
                common = [sum(w in m for w in free) for m in messages]
                message = messages[common.index(max(common))] if messages and max(common) else ""
            told = message != ""
            everything = " ".join(v for f, v in fields.items() if f != "service")
            if not (told or (code and code in query) or (name and name in query)
                    or any(w != service and w in everything for w in words)):
                continue
            points = 300 * told
            points += sum(p for f, p in (("code", 120), ("name", 100), ("service", 60))
                          if fields[f] and fields[f] in query)
            points += sum(p for f, p in (("sit", 50), ("al", 30), ("cause", 10))
                          if fields[f] and (fields[f] in query or query in fields[f]))
            points += sum(p * sum(w in fields[f] for w in words) for f, p in (
                ("m", 15), ("code", 12), ("name", 10), ("service", 8), ("sit", 6), ("al", 4), ("cause", 1)))
            rows.append((-points, cid, message))
        out += [(qid, cid, m, p / 10, i + 1) for i, (p, cid, m) in enumerate(sorted(rows)[:k])]
    return sorted(out)


def test_case_search_equals_all_pairs(spark):
    rnd = random.Random(2)
    w = [a + b for a in ("ka", "lo", "mi", "x", "error") for b in ("", "ka", "zu", "mi")]
    some = lambda a, b: " ".join(rnd.choices(w, k=rnd.randint(a, b)))
    cases = [(i, [some(0, 3) for _ in range(rnd.randint(0, 3))], some(0, 1), some(0, 2), rnd.choice(w[1:3]),
              some(0, 4), [some(1, 1) for _ in range(rnd.randint(0, 2))], some(0, 2)) for i in range(80)]
    queries = [(i, some(1, 6)) for i in range(25)] + [(25, ""), (26, "none")]
    c = spark.createDataFrame(cases, "case_id int, messages array<string>, code string, name string, "
                              "service string, situation string, aliases array<string>, cause string")
    q = spark.createDataFrame(queries, "query_id int, query string")
    want = brute_cases(queries, cases, 5)
    for sizes in ({}, {"q_rows": 4, "i_rows": 9}):
        got = li.search_cases(q, c, k=5, **sizes).select("query_id", "case_id", "message", "case_rank", "position")
        assert sorted(map(tuple, got.collect())) == want
    assert li.search_cases(q, c.limit(0)).count() == li.search_cases(q.limit(0), c).count() == 0


def test_case_search_with_missing_fields(spark):
    c = spark.createDataFrame([(1, ["a timeout"], None, None, None, None, None, None), (2, None, "504", *[None] * 5),
                               (3, [None, "time"], None, None, None, None, None, None)],
                              "case_id int, messages array<string>, code string, name string, service string, "
                              "situation string, aliases array<string>, cause string")
    q = spark.createDataFrame([(1, "time 504"), (2, None)], "query_id int, query string")
    got = [(r.query_id, r.case_id, r.message) for r in li.search_cases(q, c).orderBy("position").collect()]
    assert got == [(1, 1, "a timeout"), (1, 3, "time"), (1, 2, "")]  # a tie of 1 and 3


def test_article_search_meets_words_inside_titles(spark):
    a = spark.createDataFrame([("a", "Dockerエラーの原因", "", "/posts/a/"), ("b", "docker-compose の使い方", "", "/posts/b/"),
                               ("c", "GitHub", "", "/posts/c/"), ("d", None, None, None)],
                              "slug string, title string, code string, permalink string")
    q = spark.createDataFrame([(1, "エラー"), (2, "compose"), (3, "docker"), (4, ""), (5, None)], "query_id int, query string")
    for sizes in ({}, {"q_rows": 1, "i_rows": 1}):
        got = sorted((r.query_id, r.slug) for r in li.search_articles(q, a, **sizes).collect())
        assert got == [(1, "a"), (2, "b"), (3, "a"), (3, "b")]
