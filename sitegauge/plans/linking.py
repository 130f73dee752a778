"""Matching, linking and ranking queries (V1, V4, V5, V6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.common import explode_once, r6
from ..operators import corpus as co
from ..operators import linking as li
from ..operators import search as se
from ..operators import termlinks as te
from ..session import cut_lineage
from .bindings import (ARTICLE_FIELDS, ARTICLES, CITED_URLS, ENTITIES, FACTS, SEARCH_QUERIES,
                       SQL_WORDS, article_fields, articles, cited_urls, entities, facts,
                       search_queries, table, words)
from .registry import query

# ------------------------------------------------------------------ query coverage

STOPS = ("'a','an','the','in','on','at','for','to','of','and','or','is','are','was','be','with','by','from','as',"
         "'it','i','not','how','what','why','when','where','error','vs','get','cannot','can','could','that','this',"
         "'these','those','using','use','via','make','do','did','does','my'")


def tok(c: str) -> str:
    return (f"list_filter(list_distinct(regexp_split_to_array(lower(regexp_replace(regexp_replace({c}, "
            "'([a-zA-Z0-9])([^\\x00-\\x7F])', '\\1 \\2', 'g'), '([^\\x00-\\x7F])([a-zA-Z0-9])', '\\1 \\2', 'g')), "
            "'[ \\t\\r\\n\\-_./,()\\[\\]\"'':]+')), lambda t: length(t) >= 2 AND t NOT IN (" + STOPS + "))")


COVER = f"""{ARTICLE_FIELDS}, {SEARCH_QUERIES},
ft AS (SELECT slug, {tok('service')} AS svc, CASE WHEN code <> '' THEN [code] ELSE [] END AS code,
  {tok('components')} AS comp, {tok('tags')} AS tag, {tok('title')} AS title, {tok('related_services')} AS rel,
  {tok('top_queries')} AS tq FROM article_fields),
qt AS (SELECT *, {tok('query')} AS q FROM search_queries),
sc AS (SELECT query_id, slug, (CASE WHEN list_has_any(svc, q) THEN 50 ELSE 0 END
  + CASE WHEN list_has_any(code, q) THEN 40 ELSE 0 END + 10 * least(len(list_intersect(comp, q)), 2)
  + CASE WHEN list_has_any(tag, q) THEN 10 ELSE 0 END + least(3 * len(list_intersect(title, q)), 10)
  + CASE WHEN list_has_any(rel, q) THEN 5 ELSE 0 END
  + CASE WHEN list_has_any(tq, q) THEN 10 ELSE 0 END) / 145.0::DOUBLE AS score FROM qt CROSS JOIN ft),
bst AS (SELECT query_id, slug, score FROM sc WHERE score > 0
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, slug) = 1),
cov AS (SELECT q.query_id, query, impressions, ctr, position, coalesce(slug, '') AS best_match_slug, coalesce(score, 0.0) AS match_score,
  CASE WHEN coalesce(score, 0) >= 0.3 THEN 'covered' WHEN coalesce(score, 0) >= 0.1 THEN 'partial' ELSE 'uncovered' END AS coverage,
  CASE WHEN impressions < 50 THEN 0.0 ELSE impressions * 0.6 + (1 - ctr) * 20 + position * 0.2 END AS opportunity_score
  FROM search_queries q LEFT JOIN bst USING (query_id))"""


def _covered(spark, sf):
    # the queries' tokens are counted and joined: write them once to the shared folder
    q = cut_lineage(search_queries(spark, sf).withColumn("q_tok", tx.text_tokens("query")))
    best = li.best_articles(q, li.field_tokens(article_fields(spark, sf)))
    return (q.join(best, "query_id")
            .withColumn("coverage", li.coverage_class(F.col("match_score"), 0.3, 0.1))
            .withColumn("opportunity_score", se.opportunity()))


@query("j04_best_article", f"WITH {COVER} SELECT query_id, best_match_slug FROM cov")
def j04_best(spark, sf):
    return _covered(spark, sf).select("query_id", "best_match_slug")


@query("g03_coverage_score", f"WITH {COVER} SELECT query_id, round(match_score, 6) AS match_score, coverage FROM cov")
def g03_coverage(spark, sf):
    return _covered(spark, sf).select("query_id", r6("match_score").alias("match_score"), "coverage")


@query("a11_coverage_summary", f"""WITH {COVER}
SELECT count(*) AS total_queries, count(*) FILTER (coverage = 'covered') AS covered, count(*) FILTER (coverage = 'partial') AS partial,
  count(*) FILTER (coverage = 'uncovered') AS uncovered, round(count(*) FILTER (coverage = 'covered') / count(*), 6) AS coverage_rate FROM cov""")
def a11_summary(spark, sf):
    return li.coverage_summary(_covered(spark, sf)).withColumn("coverage_rate", r6("coverage_rate"))


@query("k04_gap_candidates", f"""WITH {COVER}
SELECT query_id, coverage, round(opportunity_score, 6) AS opportunity_score FROM cov
WHERE coverage <> 'covered' AND opportunity_score > 0
ORDER BY round(opportunity_score, 6) DESC, CASE WHEN coverage = 'uncovered' THEN 0 ELSE 1 END, query_id LIMIT 20""")
def k04_gaps(spark, sf):
    return li.gap_candidates(_covered(spark, sf)).select(
        "query_id", "coverage", r6("opportunity_score").alias("opportunity_score"))


SERVICES = {"le": "Lemma", "que": "Query", "der": "Derby", "und": "Undo", "la": "Lane", "is": "Isle", "de": "Delta"}
PARTS = {"les": "Les", "die": "Die", "sh": "Shell", "tion": "Tion", "in": "In", "un": "Un"}
_CASE_S = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SERVICES.items())
_CASE_P = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PARTS.items())


@query("t34_infer_fields", f"""WITH {SEARCH_QUERIES},
t AS (SELECT query_id, query, {tok('query')} AS q FROM search_queries),
s AS (SELECT *, list_sort(list_filter(q, lambda x: x IN ('le', 'que', 'der', 'und', 'la', 'is', 'de'))) AS ks,
  list_slice(list_transform(list_sort(list_filter(q, lambda x: x IN ('les', 'die', 'sh', 'tion', 'in', 'un'))),
    lambda x: CASE x {_CASE_P} END), 1, 3) AS comps,
  array_to_string(list_transform(list_filter(regexp_split_to_array(query, '\\s+'), lambda w: w <> ''),
    lambda w: CASE WHEN length(w) <= 3 AND regexp_matches(w, '^\\p{{L}}+$') THEN replace(upper(w), 'ẞ', 'SS')
      ELSE replace(upper(substr(w, 1, 1)), 'ẞ', 'Ss') || lower(substr(w, 2)) END), ' ') AS capped FROM t)
SELECT query_id, coalesce(CASE ks[1] {_CASE_S} END, '') AS service, array_to_string(comps, ',') AS components,
  capped || CASE WHEN regexp_matches(query, '(^|[^\\p{{L}}\\p{{N}}_])[1-5][0-9][0-9]([^\\p{{L}}\\p{{N}}_]|$)') THEN ' エラー：原因と解決策'
   WHEN regexp_matches(lower(query), 'access denied|permission|forbidden|unauthorized|auth') THEN ' 認証・権限エラー：原因と解決策'
   WHEN regexp_matches(lower(query), 'timeout|connection|refused|unreachable|connect') THEN ' 接続・タイムアウトエラー：解決方法'
   WHEN regexp_matches(lower(query), 'not found|missing|404') THEN ' Not Found エラー：原因と解決策'
   WHEN regexp_matches(lower(query), 'rate limit|quota|throttl|429') THEN ' レート制限エラー：対処法'
   WHEN regexp_matches(lower(query), 'ssl|tls|certificate|cert') THEN ' SSL/TLS エラー：解決方法'
   ELSE ' エラー：トラブルシューティングガイド' END AS title FROM s""")
def t34_infer(spark, sf):
    q = search_queries(spark, sf).withColumn("q_tok", tx.tokens("query"))
    return q.select("query_id", li.infer_service(F.col("q_tok"), SERVICES).alias("service"),
                    F.array_join(li.infer_components(F.col("q_tok"), PARTS), ",").alias("components"),
                    li.suggest_title(F.col("query")).alias("title"))


@query("k10_distinct_queries", f"""WITH {SEARCH_QUERIES},
d AS (SELECT trim(query) AS top_query, query_id FROM search_queries)
SELECT top_query FROM d WHERE top_query <> '' GROUP BY top_query ORDER BY min(query_id) LIMIT 25""")
def k10_distinct(spark, sf):
    q = search_queries(spark, sf).select(F.trim("query").alias("top_query"), "query_id")
    return (se.first_wins(q.filter(F.col("top_query") != ""), F.col("top_query"), ["query_id"])
            .orderBy("query_id").limit(25).select("top_query"))


@query("j18_context_lookup", f"""WITH {ARTICLE_FIELDS}, {SEARCH_QUERIES},
w AS (SELECT query_id AS ord, unnest(regexp_split_to_array(lower(query), '\\s+')) AS word FROM search_queries),
m AS (SELECT word, min(ord) AS ord FROM w WHERE length(word) > 2 GROUP BY word)
SELECT a.slug, coalesce(min(m.ord), (SELECT min(query_id) FROM search_queries)) AS ord
FROM article_fields a LEFT JOIN m ON contains(lower(a.title), m.word) GROUP BY a.slug""")
def j18_context(spark, sf):
    r = search_queries(spark, sf).select(F.col("query_id").alias("ord"), "query")
    return li.context_lookup(article_fields(spark, sf).select("slug", "title"), r, "slug")


# ------------------------------------------------------------------ related items


@query("j07_related_items", f"""WITH {ENTITIES},
p AS (SELECT a.item, b.item AS related,
  CASE WHEN a.service = b.service THEN 5 + CASE WHEN b.error_type = 'PROMO' THEN 100 ELSE 0 END ELSE 0 END
  + CASE WHEN a.error_type = b.error_type THEN 1 ELSE 0 END
  + 3 * len(list_intersect(a.components, b.components)) AS score
  FROM entities a JOIN entities b ON a.item <> b.item)
SELECT item, related, score::INTEGER AS score FROM p WHERE score >= 3
QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, related) <= 20""")
def j07_related(spark, sf):
    return li.related_items(entities(spark, sf), guide="PROMO").select("item", "related", "score")


@query("j08_related_by_tag", f"""WITH {ENTITIES},
p AS (SELECT DISTINCT a.item, b.item AS related FROM entities a JOIN entities b
  ON a.item <> b.item AND len(list_intersect(a.components, b.components)) > 0)
SELECT item, related FROM p QUALIFY row_number() OVER (PARTITION BY item ORDER BY related) <= 3""")
def j08_tags(spark, sf):
    e = entities(spark, sf).withColumnRenamed("components", "tags")
    return li.related_by_tag(e).select("item", "related")


@query("j08_same_code", f"""WITH {ENTITIES},
p AS (SELECT a.item, b.item AS related FROM entities a JOIN entities b
  ON a.item <> b.item AND a.code = b.code AND len(list_intersect(a.components, b.components)) = 0)
SELECT item, related FROM p QUALIFY row_number() OVER (PARTITION BY item ORDER BY related) <= 3""")
def j08_code(spark, sf):
    e = entities(spark, sf).withColumnRenamed("components", "tags")
    return li.same_code_other_tags(e).select("item", "related")


# ------------------------------------------------------ containment, grids, terms


def _site_name():
    return F.regexp_extract("host", "^(?:m\\.|blog\\.)?([^.]+)\\.", 1)


@query("j05_incident_articles", f"""WITH {CITED_URLS},
inc AS (SELECT DISTINCT regexp_extract(host, '^(?:m\\.|blog\\.)?([^.]+)\\.', 1) AS service,
   regexp_extract(url, '/(?:en|fr|de|es)/([0-9]{{2}})', 1) AS kw FROM cited_urls WHERE page_id % 25 = 0),
art AS (SELECT page_id, regexp_extract(host, '^(?:m\\.|blog\\.)?([^.]+)\\.', 1) AS service,
   regexp_extract(url, '/(?:en|fr|de|es)/([0-9]{{2}})', 1) AS comp FROM cited_urls)
SELECT page_id FROM art a WHERE EXISTS (SELECT 1 FROM inc i WHERE
  (i.service <> '' AND a.service <> '' AND (contains(a.service, i.service) OR contains(i.service, a.service))) OR a.comp = i.kw)""")
def j05_incidents(spark, sf):
    u = cited_urls(spark, sf)
    kw = F.array(F.regexp_extract("url", "/(?:en|fr|de|es)/([0-9]{2})", 1))
    inc = u.filter(F.col("page_id") % 25 == 0).select(
        _site_name().alias("service"), kw.alias("keywords"))
    art = u.select("page_id", _site_name().alias("service"), kw.alias("components"))
    return li.match_incidents(art, inc, "page_id").select("page_id")


CODES = [str(i) for i in range(100)]


@query("j06_coverage_grid", f"""WITH {FACTS},
g AS (SELECT user_id AS tool, c::VARCHAR AS code FROM (SELECT DISTINCT user_id FROM facts) CROSS JOIN range(100) r(c)),
cv AS (SELECT DISTINCT user_id AS tool, k::VARCHAR AS code FROM facts)
SELECT g.tool, g.code, g.code IN ('1', '2', '3') AND g.tool % 10 = 0 AS trending FROM g
WHERE NOT EXISTS (SELECT 1 FROM cv WHERE cv.tool = g.tool AND cv.code = g.code)
ORDER BY trending DESC, md5('42:' || g.tool || ':' || g.code) LIMIT 500""")
def j06_grid(spark, sf):
    f = facts(spark, sf).select(F.col("user_id").alias("tool"), F.col("k").cast("string").alias("code"))
    tools = f.select("tool").distinct()
    trending = tools.filter(F.col("tool") % 10 == 0).withColumn(
        "code", F.explode(F.array(F.lit("1"), F.lit("2"), F.lit("3"))))
    return li.coverage_grid(tools, CODES, f.distinct(), trending, 500)


@query("j19_work_grid", f"""WITH {ARTICLES},
j AS (SELECT 'doc' || article_id AS path, r AS round FROM articles CROSS JOIN range(1, 4) x(r))
SELECT path, round::INTEGER AS round FROM j WHERE NOT (round = 1 OR (round = 2 AND CAST(substr(path, 4) AS BIGINT) % 2 = 0))""")
def j19_grid(spark, sf):
    d = articles(spark, sf).select(
        F.concat(F.lit("doc"), F.col("article_id").cast("string")).alias("path"), "article_id")
    one = d.select(F.concat("path", F.lit("::1")).alias("key"))
    two = d.filter(F.col("article_id") % 2 == 0).select(F.concat("path", F.lit("::2")).alias("key"))
    return li.work_grid(d, 3, one.union(two)).select("path", "round")


def _pages(spark, sf):
    """One term page per benchmark item; its own term is the second word."""
    return table(spark, sf, "benchmark").select(
        "item_id", F.lower(F.get(words(F.col("text")), F.lit(1))).alias("own"), F.col("text").alias("body"))


def _terms(spark, sf):
    """The dictionary: all words of four or more characters of the term pages."""
    w = explode_once(_pages(spark, sf), [], F.array_distinct(words(F.lower("body"))), "term")
    return w.filter(F.length("term") >= 4).distinct()


PAGES = f"""pages_ AS (SELECT item_id, lower({SQL_WORDS.format(c='text')}[2]) AS own, text AS body FROM benchmark),
terms AS (SELECT DISTINCT term FROM (SELECT unnest({SQL_WORDS.format(c='lower(text)')}) AS term FROM benchmark) WHERE length(term) >= 4)"""


@query("j17_related_terms", f"""WITH {PAGES}
SELECT item_id, term FROM pages_ JOIN terms ON term IS DISTINCT FROM own AND contains(body, term)""")
def j17_terms(spark, sf):
    pages = _pages(spark, sf)
    occ = te.term_occurrences(_terms(spark, sf), pages, "item_id")
    return occ.join(pages.select("item_id", "own"), "item_id").filter(
        ~F.col("term").eqNullSafe(F.col("own"))).select("item_id", "term")


@query("j17_term_documents", f"""WITH {PAGES}, {ARTICLES}
SELECT t.term, article_id FROM terms t JOIN articles ON contains(body, t.term)
QUALIFY row_number() OVER (PARTITION BY t.term ORDER BY article_id) <= 8""")
def j17_documents(spark, sf):
    return te.term_documents(_terms(spark, sf), articles(spark, sf), "article_id").select("term", "article_id")


# A term with its ends, found in the body with a line feed at both ends.
_BOUNDED = """CASE WHEN regexp_matches(term[1], '[A-Za-z0-9]') THEN '[^A-Za-z0-9]' ELSE '' END || regexp_escape(term)
  || CASE WHEN regexp_matches(term[-1], '[A-Za-z0-9]') THEN '[^A-Za-z0-9]' ELSE '' END"""


@query("j09_dictionary_hits", f"""WITH {PAGES}, {ARTICLES},
p AS (SELECT term, {_BOUNDED} AS pat FROM terms)
SELECT article_id, term FROM articles JOIN p
  ON contains(body, term) AND regexp_matches(chr(10) || body || chr(10), pat)""")
def j09_hits(spark, sf):
    """Terms with clean boundaries."""
    return te.dictionary_hits(_terms(spark, sf), articles(spark, sf), "article_id")


#: Links per document and term: all places of all terms with clean ends, outside of headings, fences
#: and protected spans; then from left to right, the longest first, none into the one before. Places
#: that meet form a chain, and each chain is walked by itself.
LINKS = rf"""{PAGES}, {ARTICLES},
ln AS (SELECT article_id, unnest(range(1, len(l) + 1)) AS n, unnest(l) AS line
  FROM (SELECT article_id, string_split(body, chr(10)) AS l FROM articles)),
fe AS (SELECT *, regexp_matches(line, '^(`{{3,}}|~{{3,}})') AS fence FROM ln),
op AS (SELECT article_id, n, chr(10) || regexp_replace(line,
    '!?\[[^\]\n]*\]\([^)\n]*\)|`[^`\n]+`|<a\b[^>]*>.*?</a>|<[^>\n]+>|https?://\S+', chr(10), 'g') || chr(10) AS line
  FROM (SELECT *, sum(fence::INT) OVER (PARTITION BY article_id ORDER BY n) AS f FROM fe)
  WHERE NOT fence AND f % 2 = 0 AND NOT regexp_matches(line, '^#{{1,6}}\s')),
sz AS (SELECT DISTINCT length(term) AS k FROM terms),
bl AS (SELECT article_id, n, b, substr(line, 200 * b + 1, 200 + (SELECT max(k) FROM sz) + 1) AS part
  FROM (SELECT *, unnest(range(0, length(line) // 200 + 1)) AS b FROM op)),
ps AS (SELECT article_id, n, 200 * b + x AS pos, substr(part, x, k) AS term, k, substr(part, x - 1, 1) AS bf, substr(part, x + k, 1) AS af
  FROM (SELECT *, unnest(range(2, least(202, length(part)))) AS x FROM bl), sz WHERE x + k <= length(part)),
ok AS (SELECT article_id, n, pos, pos + k AS fin, term FROM ps JOIN terms USING (term)
  WHERE NOT (regexp_matches(term[1], '[A-Za-z0-9]') AND regexp_matches(bf, '[A-Za-z0-9]'))
    AND NOT (regexp_matches(term[-1], '[A-Za-z0-9]') AND regexp_matches(af, '[A-Za-z0-9]'))),
lo AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY article_id, n, pos ORDER BY fin DESC) = 1),
ch AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY article_id, n ORDER BY pos) AS c FROM (
  SELECT *, pos >= coalesce(max(fin) OVER (PARTITION BY article_id, n ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fresh FROM lo)),
nx AS (SELECT a.article_id, a.n, a.c, a.pos, a.fin, a.term, min(b.pos) AS nxt FROM ch a
  LEFT JOIN ch b ON a.article_id = b.article_id AND a.n = b.n AND a.c = b.c AND b.pos >= a.fin GROUP BY ALL)"""


@query("t23_term_links", f"""WITH RECURSIVE {LINKS},
wk AS (SELECT article_id, n, c, pos, term, nxt FROM nx
    QUALIFY row_number() OVER (PARTITION BY article_id, n, c ORDER BY pos) = 1
  UNION ALL SELECT x.article_id, x.n, x.c, x.pos, x.term, x.nxt FROM wk JOIN nx x
    ON x.article_id = wk.article_id AND x.n = wk.n AND x.c = wk.c AND x.pos = wk.nxt)
SELECT article_id, term, count(*) AS links, true AS undone FROM wk GROUP BY article_id, term""")
def t23_links(spark, sf):
    """Links per article and term, and whether undoing gives the body back."""
    linked = te.link_terms(articles(spark, sf), _terms(spark, sf).select(
        "term", F.concat(F.lit("/glossary/"), F.sha2("term", 256), F.lit("/")).alias("url")), "article_id")
    put = F.regexp_extract_all("linked", F.lit("\\[([^\\]\\n]+)\\]\\(/glossary/[0-9a-f]{64}/\\)"), F.lit(1))
    undone = co.undo_term_links("linked") == F.col("body")
    # both are made once per article, before the explode
    made = linked.select("article_id", put.alias("put"), undone.alias("undone"))
    rows = F.transform("put", lambda t: F.struct(t.alias("term"), F.col("undone").alias("undone")))
    return (explode_once(made, ["article_id"], rows, "r").groupBy("article_id", "r.term")
            .agg(F.count(F.lit(1)).alias("links"), F.bool_and("r.undone").alias("undone")))


# -------------------------------------------------------------- sources and tiers

TABLE = (("vendor_community", "label", ("blog.",)), ("unverifiable", "label", ("spam-farm.",)),
         ("official", "under", ("example.org",)), ("community_blog", "under", ("example.net",)))
KIND = """CASE WHEN host LIKE 'blog.%' THEN 'vendor_community' WHEN host LIKE 'spam-farm.%' THEN 'unverifiable'
  WHEN host = 'example.org' OR host LIKE '%.example.org' THEN 'official'
  WHEN host = 'example.net' OR host LIKE '%.example.net' THEN 'community_blog' ELSE 'unknown' END"""


def _kinds(spark, sf):
    return cited_urls(spark, sf).withColumn("kind", tx.resolved_kind("host", TABLE))


@query("j11_domain_kind", f"WITH {CITED_URLS} SELECT page_id, {KIND} AS kind FROM cited_urls")
def j11_kind(spark, sf):
    return _kinds(spark, sf).select("page_id", "kind")


@query("a09_tier_counts", f"""WITH {CITED_URLS}, k AS (SELECT doc, {KIND} AS kind FROM cited_urls)
SELECT doc, count(*) FILTER (kind = 'official') AS official, count(*) FILTER (kind = 'vendor_community') AS vendor_community,
  count(*) FILTER (kind = 'unverifiable') AS unverifiable, count(*) AS urls,
  round(count(*) FILTER (kind = 'unverifiable') / count(*), 6) AS redirect_share FROM k GROUP BY doc""")
def a09_tiers(spark, sf):
    t = li.tier_counts(_kinds(spark, sf), "doc", "kind",
                       ("official", "vendor_community", "unverifiable"), "unverifiable")
    return t.withColumn("redirect_share", r6("redirect_share"))


@query("a10_review_triggers", f"""WITH {CITED_URLS},
k AS (SELECT doc, CASE WHEN page_id % 3 = 0 THEN 'unresolved' ELSE {KIND} END AS kind,
   doc % 7 <> 0 AS valid, contains(url, 'utm_') AS tm FROM cited_urls),
s AS (SELECT doc, count(*) FILTER (valid) AS sources, count(*) FILTER (valid AND kind IN ('official', 'vendor_community')) AS good,
  count(*) FILTER (valid AND tm) AS tool_matches, count(*) FILTER (valid AND kind = 'unresolved') AS unresolved FROM k GROUP BY doc)
SELECT *, concat_ws(',', CASE WHEN sources = 0 THEN 'incomplete' END, CASE WHEN sources > 0 AND good = 0 THEN 'no official sources' END,
  CASE WHEN sources > 0 AND tool_matches = 0 THEN 'no tool match' END,
  CASE WHEN sources > 0 AND unresolved / sources >= 0.4 THEN 'many unresolved' END) AS reasons FROM s""")
def a10_triggers(spark, sf):
    k = _kinds(spark, sf).withColumn("kind", F.when(F.col("page_id") % 3 == 0, "unresolved")
                                     .otherwise(F.col("kind")))
    s = li.evidence_summary(k.withColumn("tool_match", F.col("url").contains("utm_")), "doc",
                            F.col("doc") % 7 != 0)
    return s.withColumn("reasons", F.array_join(li.review_triggers(0.4), ","))


def _cite_text():
    return F.concat(F.lit("See [x]("), F.col("url"), F.lit("). Also "), F.col("url"),
                    F.lit(", and https://docs.example.org/a."))


CITE = "'See [x](' || url || '). Also ' || url || ', and https://docs.example.org/a.'"


@query("t10_url_tiers", f"""WITH {CITED_URLS},
u AS (SELECT page_id, unnest(list_concat(regexp_extract_all({CITE}, '\\]\\((\\S+?)\\)', 1),
   regexp_extract_all({CITE}, 'https?://\\S+'))) AS u FROM cited_urls),
h AS (SELECT page_id, regexp_extract(u, '^https?://([^/?#:]+)', 1) AS h FROM u)
SELECT page_id, count(*) AS urls, count(*) FILTER (h LIKE 'docs.%') AS official,
  count(*) FILTER (h NOT LIKE 'docs.%') AS other FROM h GROUP BY page_id""")
def t10_tiers(spark, sf):
    from ..operators.corpus import url_tiers
    u = cited_urls(spark, sf).withColumn("body", _cite_text()).withColumn("tiers", url_tiers())
    n = lambda t: F.size(F.filter("tiers", lambda x: x == t)).cast("long")
    return u.select("page_id", F.size("tiers").cast("long").alias("urls"),
                    n("official").alias("official"), n("other").alias("other"))


@query("t19_citation_count", f"""WITH {CITED_URLS},
u AS (SELECT page_id, unnest(list_concat(regexp_extract_all({CITE}, '\\[[^\\]]+\\]\\((https?://[^)]+)\\)', 1),
   regexp_extract_all({CITE}, '(^|[^(])(https?://[^\\s)]+)', 2))) AS u FROM cited_urls)
SELECT page_id, count(DISTINCT regexp_replace(u, '[.,)]+$', '')) AS citations FROM u GROUP BY page_id""")
def t19_citations(spark, sf):
    return cited_urls(spark, sf).select(
        "page_id", F.size(tx.distinct_urls(_cite_text())).cast("long").alias("citations"))


SOURCE_TYPES = ("official", "blog", "other", "unknown", "documentation")


@query("g10_source_quality", f"""WITH {CITED_URLS},
s AS (SELECT doc, page_id AS ord, regexp_extract(url, '/(en|fr|de|es)/', 1) AS claim,
  CASE WHEN page_id % 9 = 0 THEN 'ftp://' || host ELSE 'https://' || regexp_extract(host, '([^.]+\\.[^.]+)$', 1) || '/' END AS url,
  CASE WHEN doc % 3 = 0 THEN 'blog' ELSE ['official', 'blog', 'other', 'unknown', 'documentation'][1 + page_id % 5] END AS st,
  {KIND} AS kind FROM cited_urls),
v AS (SELECT * FROM s WHERE url LIKE 'https%' QUALIFY row_number() OVER (PARTITION BY doc, claim, url ORDER BY ord) = 1),
g AS (SELECT doc, count(*) AS valid, count(*) FILTER (st IN ('blog', 'other', 'unknown', '')) AS low,
  count(*) FILTER (st IN ('official', 'documentation')) AS high, count(*) FILTER (kind = 'official') AS off FROM v GROUP BY doc)
SELECT s.doc, coalesce(valid, 0) AS valid, count(*) - coalesce(valid, 0) AS invalid,
  CASE WHEN coalesce(valid, 0) = 0 THEN 0 ELSE CASE WHEN low = valid THEN -20 WHEN high > 0 THEN 10 ELSE 0 END
    + CASE WHEN off = 0 THEN -10 WHEN off / valid >= 0.5 THEN 5 ELSE 0 END END AS quality_delta
FROM s LEFT JOIN g USING (doc) GROUP BY s.doc, valid, low, high, off""")
def g10_quality(spark, sf):
    k = _kinds(spark, sf)
    i = F.col("page_id")
    st = F.when(F.col("doc") % 3 == 0, "blog").otherwise(
        F.get(F.array(*[F.lit(s) for s in SOURCE_TYPES]), (i % 5).cast("int")))
    s = k.select("doc", i.alias("ord"), F.regexp_extract("url", "/(en|fr|de|es)/", 1).alias("claim"),
                 F.when(i % 9 == 0, F.concat(F.lit("ftp://"), "host")).otherwise(F.concat(
                     F.lit("https://"), F.regexp_extract("host", "([^.]+\\.[^.]+)$", 1),
                     F.lit("/"))).alias("url"),
                 st.alias("source_type"), "kind")
    return li.source_quality(s, "doc")


@query("a24_submitted_urls", f"""WITH {CITED_URLS},
l AS (SELECT DATE '2024-01-01' + (page_id % 60)::INTEGER AS d, page_id % 6 <> 0 AS ok, unnest([url, 'https://' || host]) AS u FROM cited_urls)
SELECT count(DISTINCT u) AS urls FROM l WHERE d >= DATE '2024-01-20' AND ok""")
def a24_submitted(spark, sf):
    log = cited_urls(spark, sf).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 60).cast("int")).alias("date"),
        F.when(F.col("page_id") % 6 == 0, "error").otherwise("ok").alias("status"),
        F.array("url", F.concat(F.lit("https://"), "host")).alias("urls"))
    return li.submitted_urls(log, "2024-01-20")


# ------------------------------------------------------------------------- search


@query("g09_article_search", f"""WITH {ARTICLE_FIELDS}, {SEARCH_QUERIES},
q AS (SELECT query_id, (100 + impressions * 7 % 400)::VARCHAR AS qc, list_distinct(list_filter(regexp_split_to_array(trim(lower(query)), '\\s+'), lambda w: w <> '')) AS terms
  FROM search_queries),
a AS (SELECT slug, lower(title) AS t, (100 + article_id % 400)::VARCHAR AS code, CASE WHEN article_id % 11 = 0 THEN 2 ELSE 0 END AS cls FROM article_fields),
p AS (SELECT query_id, slug, cls, qc = code AS same, len(terms) AS n, len(list_filter(terms, lambda w: contains(t, w))) AS hits
  FROM q CROSS JOIN a),
r AS (SELECT *, CASE WHEN same AND n > 0 AND hits = n THEN 0 WHEN same THEN 1 WHEN n > 0 AND hits = n THEN 2 ELSE 3 + cls END AS search_rank
  FROM p WHERE same OR hits > 0)
SELECT query_id, slug, search_rank::INTEGER AS search_rank FROM r
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY search_rank, cls, slug) <= 10""")
def g09_search(spark, sf):
    q = search_queries(spark, sf)
    code = (100 + F.col("impressions") * 7 % 400).cast("string")
    q = q.select("query_id", F.concat(code, F.lit(" "), F.col("query")).alias("query"))
    i = F.col("article_id")
    a = article_fields(spark, sf).select(
        "slug", "title", (100 + i % 400).cast("string").alias("code"),
        F.when(i % 11 == 0, "/glossary/x/").otherwise("/posts/x/").alias("permalink"))
    return li.search_articles(q, a).select("query_id", "slug", "search_rank")


def _cases(spark, sf):
    """Error cases from whole articles: lines as messages, a number, first and last line, long words."""
    return article_fields(spark, sf).select(
        F.col("article_id").alias("case_id"), F.col("top_queries").alias("messages"),
        F.regexp_extract(F.coalesce("body", F.lit("")), "[0-9]{3}", 0).alias("code"), F.col("code").alias("name"),
        "service", F.col("title").alias("situation"), F.col("components").alias("aliases"),
        F.get("related_services", F.lit(0)).alias("cause"))


def _sql_norm(c):
    """Masked text, as t26_mask_error_text."""
    for pattern, mark in (("[“”]", '"'), ("[‘’]", "''"), ("https?://\\S+", " <url> "),
                          ("([0-9]{1,3}(\\.[0-9]{1,3}){3})", " <ip> "), ("[a-f0-9]{12,}", " <id> "),
                          ("[a-z]:\\\\[^\\s]+", " <path> "), ("/[^\\s]+(?:/[^\\s]+)+", " <path> "),
                          ("[<>{}()\\[\\],:;]+", " "), ("\\s+", " ")):
        c = f"regexp_replace({c if c.startswith('regexp') else f'lower({c})'}, '{pattern}', '{mark}', 'g')"
    return f"trim({c})"


_FIELDS = ("code", "name", "service", "situation", "aliases", "cause")
_IN = " + ".join(
    [f"CASE WHEN n_{f} <> '' AND contains(qn, n_{f}) THEN {p} ELSE 0 END"
     for f, p in (("code", 120), ("name", 100), ("service", 60))]
    + [f"CASE WHEN n_{f} <> '' AND (contains(qn, n_{f}) OR contains(n_{f}, qn)) THEN {p} ELSE 0 END"
       for f, p in (("situation", 50), ("aliases", 30), ("cause", 10))])
_WORDS = " + ".join(
    f"{w} * len(list_filter(qt, lambda t: contains(n_{f}, t)))"
    for f, w in (("messages", 15), ("code", 12), ("name", 10), ("service", 8), ("situation", 6), ("aliases", 4), ("cause", 1)))
SEARCH_CASES = f"""{ARTICLE_FIELDS}, {SEARCH_QUERIES},
cq AS (SELECT query_id, qn, list_filter(string_split(qn, ' '), lambda t: length(t) > 1 AND t NOT IN ('error', 'from')) AS qt
  FROM (SELECT query_id, {_sql_norm('query')} AS qn FROM search_queries)),
cc AS (SELECT article_id AS case_id, string_split(b, chr(10)) AS messages,
  list_transform(string_split(b, chr(10)), lambda x: {_sql_norm('x')}) AS n_list, {_sql_norm('top_queries')} AS n_messages,
  regexp_extract(b, '[0-9]{{3}}') AS n_code, {_sql_norm('code')} AS n_name, {_sql_norm("coalesce(service, '')")} AS n_service,
  {_sql_norm('title')} AS n_situation, {_sql_norm('components')} AS n_aliases, {_sql_norm('related_services')} AS n_cause
  FROM article_fields),
cs AS (SELECT *, list_filter(string_split(n_service, ' '), lambda t: length(t) > 1 AND t NOT IN ('error', 'from')) AS s_tok,
  n_code || ' ' || n_name || ' ' || n_situation || ' ' || n_aliases || ' ' || n_messages || ' ' || n_cause AS n_all FROM cc),
cp AS (SELECT *, len(list_filter(qt, lambda t: contains(n_messages, t) AND NOT list_contains(s_tok, t))) > 0
    OR len(list_filter(n_list, lambda n: n <> '' AND contains(qn, n))) > 0 AS told FROM cq CROSS JOIN cs),
cr AS (SELECT query_id, case_id, qn, qt, s_tok, messages, n_list,
    CASE WHEN told THEN 300 ELSE 0 END + {_IN} + {_WORDS} AS points
  FROM cp WHERE told OR (n_code <> '' AND contains(qn, n_code)) OR (n_name <> '' AND contains(qn, n_name))
    OR len(list_filter(qt, lambda t: t <> n_service AND contains(n_all, t))) > 0),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY points DESC, case_id) AS position FROM cr
  QUALIFY position <= 12),
best_scored AS (SELECT *, list_transform(list_zip(messages, n_list), lambda x: CASE WHEN x[2] <> '' AND contains(qn, x[2]) THEN length(x[1]) ELSE 0 END) AS longest,
  list_transform(n_list, lambda n: len(list_filter(qt, lambda t: contains(n, t) AND NOT list_contains(s_tok, t)))) AS common FROM best)"""


@query("j14_case_search", f"""WITH {SEARCH_CASES}
SELECT query_id, case_id, CASE WHEN list_max(longest) > 0 THEN messages[list_position(longest, list_max(longest))]
  WHEN list_max(common) > 0 THEN messages[list_position(common, list_max(common))] ELSE '' END AS message,
  round(-points / 10, 6) AS case_rank, position::INTEGER AS position FROM best_scored""")
def j14_cases(spark, sf):
    return li.search_cases(search_queries(spark, sf), _cases(spark, sf)).select(
        "query_id", "case_id", "message", r6("case_rank").alias("case_rank"), "position")


@query("g08_case_rank", f"""WITH {SEARCH_CASES}
SELECT query_id, round(-points / 10, 6) AS best_rank, case_id FROM best WHERE position = 1""")
def g08_rank(spark, sf):
    """Best case per query and its rank."""
    return li.rank_cases(search_queries(spark, sf), _cases(spark, sf), 1).select(
        "query_id", r6("case_rank").alias("best_rank"), "case_id")


@query("f12_case_signal", f"""WITH {SEARCH_CASES}
SELECT query_id, query_id IN (SELECT query_id FROM cr) AS has_signal FROM search_queries""")
def f12_signal(spark, sf):
    """Queries with at least one case that gives a signal."""
    ranked = li.rank_cases(search_queries(spark, sf), _cases(spark, sf), 1)
    return search_queries(spark, sf).select("query_id").join(ranked, "query_id", "left").select(
        "query_id", F.col("case_id").isNotNull().alias("has_signal"))
