"""Search-console queries on the facts view (V2) and the query view (V4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.common import r6
from ..operators import search as se
from ..operators import traffic as tr
from ..session import cut_lineage
from .bindings import FACTS, SEARCH_QUERIES, facts, search_queries
from .registry import query
from .traffic import SCORED, vote_scores

W = f"WITH {FACTS} "
METRICS = """count(*) AS impressions, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS clicks,
  sum(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) / count(*) AS ctr, avg(value) / 4 AS position"""
PAGES = f""",
pages_m AS (SELECT page, {METRICS} FROM facts WHERE page LIKE '%/posts/%' GROUP BY page),
pq AS (SELECT page, query, {METRICS} FROM facts WHERE page LIKE '%/posts/%' GROUP BY page, query),
tq AS (SELECT page, query AS top_query FROM pq
       QUALIFY row_number() OVER (PARTITION BY page ORDER BY impressions DESC, query) = 1),
th AS (SELECT avg(ctr) AS mean_ctr, least(0.2, 0.7 * avg(ctr)) AS threshold FROM pages_m),
flags AS (SELECT p.*, coalesce(top_query, '') AS top_query,
    impressions > 100 AND ctr < 0.15 AS ultra,
    impressions >= 10 AND ctr < threshold AS low, impressions >= 5 AND position BETWEEN 11 AND 12.5 AS stuck,
    CASE WHEN impressions < 90 THEN 0.0 ELSE impressions * 0.6 + (1 - ctr) * 30 + position * 0.1 END AS score
    FROM pages_m p CROSS JOIN th LEFT JOIN tq USING (page)),
found AS (SELECT *, regexp_extract(page, '/posts/([^/]+)/?$', 1) AS slug,
    concat_ws(',', CASE WHEN ultra THEN 'ultra' END, CASE WHEN NOT ultra AND low THEN 'low ctr' END,
              CASE WHEN NOT ultra AND stuck THEN 'stagnant' END) AS reasons
    FROM flags WHERE ultra OR low OR stuck)"""


def _posts(f):
    return f.filter(F.col("page").contains("/posts/"))


def _pages(spark, sf):
    return se.page_summary(_posts(facts(spark, sf)))


def _found(spark, sf):
    # one row per page, read for the threshold and again for the report: write it once
    return se.bottlenecks(cut_lineage(_pages(spark, sf)), ctr_cap=0.2, ultra_ctr=0.15, pos_max=12.5,
                          min_impressions=90)


def _titles(f):
    """Slug -> title for most pages; some pages have no article."""
    k = F.regexp_extract("page", "/posts/(p[0-9]+)/", 1)
    return (_posts(f).filter(F.col("k") % 7 != 0)
            .select(k.alias("slug"), F.col("page").alias("title")).distinct())


TITLES = """,
titles AS (SELECT DISTINCT regexp_extract(page, '/posts/(p[0-9]+)/', 1) AS slug, page AS title
           FROM facts WHERE page LIKE '%/posts/%' AND k % 7 <> 0)"""


@query("j02_page_top_query", W + PAGES + """
SELECT page, impressions, clicks, round(ctr, 6) AS ctr, round(position, 6) AS position,
  coalesce(top_query, '') AS top_query FROM pages_m LEFT JOIN tq USING (page)""")
def page_top_query(spark, sf):
    f = _posts(facts(spark, sf))
    return se.with_top_query(tr.page_metrics(f), se.query_metrics(f)).select(
        "page", "impressions", "clicks", r6("ctr").alias("ctr"), r6("position").alias("position"), "top_query")


@query("w02_top_query", W + PAGES + "SELECT * FROM tq")
def top_query(spark, sf):
    return se.top_query(se.query_metrics(_posts(facts(spark, sf))))


W03 = """,
hq AS (SELECT page, user_id AS query, count(*) AS impressions,
         sum(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) / count(*) AS ctr, avg(value) / 4 AS position
       FROM facts WHERE page LIKE '%/posts/%' GROUP BY page, user_id),
t10 AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY impressions DESC, query) AS rn FROM hq
        QUALIFY rn <= 10)"""


def _user_queries(spark, sf):
    f = _posts(facts(spark, sf))
    q = se.query_metrics(f, ("page", "user_id"))
    return q.withColumnRenamed("user_id", "query")


@query("w03_top_queries", W + W03 + """
SELECT page, string_agg(query::VARCHAR, '|' ORDER BY rn) AS top3 FROM t10 WHERE rn <= 3 GROUP BY page""")
def top_queries(spark, sf):
    s = se.query_summary(_user_queries(spark, sf))
    return s.select("page", F.array_join("top_queries", "|").alias("top3"))


@query("a06_weighted_metrics", W + W03 + """
SELECT page, round(sum(ctr * impressions) / sum(impressions), 6) AS avg_ctr,
  round(sum(position * impressions) / sum(impressions), 6) AS avg_position FROM t10 GROUP BY page""")
def weighted_metrics(spark, sf):
    s = se.query_summary(_user_queries(spark, sf))
    return s.select("page", r6("avg_ctr").alias("avg_ctr"), r6("avg_position").alias("avg_position"))


@query("a07_ctr_threshold", W + PAGES + """
SELECT round(mean_ctr, 6) AS mean_ctr, round(threshold, 6) AS threshold FROM th""")
def ctr_threshold(spark, sf):
    t = se.ctr_threshold(tr.page_metrics(_posts(facts(spark, sf))), 0.2)
    return t.select(r6("mean_ctr").alias("mean_ctr"), r6("threshold").alias("threshold"))


@query("g04_opportunity", W + PAGES + """
SELECT page, round(CASE WHEN impressions < 95 THEN 0.0
   ELSE impressions * 0.6 + (1 - ctr) * 20 + position * 0.2 END, 6) AS opportunity FROM pages_m""")
def opportunity(spark, sf):
    p = tr.page_metrics(_posts(facts(spark, sf)))
    return p.select("page", r6(se.opportunity(95)).alias("opportunity"))


@query("g05_bottlenecks", W + PAGES + """
SELECT page, slug, impressions, clicks, round(ctr, 6) AS ctr, round(position, 6) AS position, top_query,
  reasons, ultra AS ultra_priority, round(score, 6) AS priority_score, impressions >= 90 AS rewrite_eligible
FROM found""")
def bottlenecks(spark, sf):
    return _found(spark, sf).select(
        "page", "slug", "impressions", "clicks", r6("ctr").alias("ctr"),
        r6("position").alias("position"), "top_query", F.array_join("reasons", ",").alias("reasons"),
        "ultra_priority", r6("priority_score").alias("priority_score"), "rewrite_eligible")


@query("k01_bottleneck_order", W + PAGES + """
SELECT page, ultra AS ultra_priority, round(score, 6) AS priority_score FROM found
ORDER BY ultra DESC, round(score, 6) DESC, page LIMIT 15""")
def bottleneck_order(spark, sf):
    return se.bottleneck_order(_found(spark, sf), 15).select(
        "page", "ultra_priority", r6("priority_score").alias("priority_score"))


@query("k02_priority_class", W + PAGES + """
SELECT page, impressions, CASE WHEN impressions >= 20 AND position BETWEEN 4 AND 20 AND ctr < 0.2 THEN 'A'
   WHEN impressions >= 20 AND position BETWEEN 21 AND 40 THEN 'B' ELSE 'C' END AS priority
FROM pages_m ORDER BY priority, impressions DESC, page LIMIT 50""")
def priority_order(spark, sf):
    p = tr.page_metrics(_posts(facts(spark, sf))).withColumn(
        "priority", se.priority_class(low_ctr=0.2))
    return se.priority_order(p, 50).select("page", "impressions", "priority")


@query("k03_lowest_engagement", W + """
SELECT page, count(*) AS views, round(avg(seconds), 6) AS avg_seconds FROM facts
WHERE page LIKE '%/posts/%' GROUP BY page HAVING count(*) >= 90 ORDER BY avg(seconds), page LIMIT 10""")
def lowest_engagement(spark, sf):
    t = se.lowest_engagement(facts(spark, sf), 90)
    return t.withColumn("avg_seconds", r6("avg_seconds"))


@query("j03_merge_bottlenecks", W + SCORED.replace("priority_score FROM joined", "priority_score FROM joined")
       + PAGES.replace(",\npages_m", ",\npages_m") + TITLES + """,
q AS (SELECT title, priority_score, priority_score >= 1 AS critical FROM scored WHERE priority_score > 0),
b AS (SELECT title, slug, score, ultra, top_query, position FROM found JOIN titles USING (slug)),
j AS (SELECT coalesce(q.title, b.title) AS title, slug, priority_score, critical, score, ultra, top_query,
        position, score IS NOT NULL AND (priority_score IS NULL OR ultra OR score > priority_score) AS take
      FROM q FULL JOIN b ON q.title = b.title)
SELECT title, slug, round(CASE WHEN take THEN score ELSE priority_score END, 6) AS priority_score,
  CASE WHEN take THEN ultra ELSE critical END AS critical,
  CASE WHEN coalesce(top_query, '') <> '' THEN top_query ELSE '' END AS top_query,
  round(position, 6) AS gsc_position,
  CASE WHEN priority_score IS NOT NULL THEN 'feedback' ELSE 'search_console' END AS source FROM j""")
def merge_bottlenecks(spark, sf):
    q = vote_scores(spark, sf).select(
        "title", "priority_score", "critical", F.lit("").alias("top_query"),
        F.lit("feedback").alias("source"))
    m = se.merge_bottlenecks(q, _found(spark, sf), _titles(facts(spark, sf)))
    return m.select("title", "slug", r6("priority_score").alias("priority_score"), "critical",
                    "top_query", r6("gsc_position").alias("gsc_position"), "source")


@query("j16_urls_to_submit", W + SCORED + TITLES + """
SELECT title, 'https://example.org/posts/' || slug || '/' AS url
FROM scored JOIN titles USING (title) WHERE priority_score > 0
 AND 'https://example.org' || title NOT IN (
   SELECT 'https://example.org' || page FROM facts WHERE k % 4 = 1)""")
def urls_to_submit(spark, sf):
    f = facts(spark, sf)
    done = f.filter(F.col("k") % 4 == 1).select(
        F.concat(F.lit("https://example.org"), F.col("page")).alias("url")).distinct()
    return se.urls_to_submit(vote_scores(spark, sf), _titles(f), done,
                             "https://example.org").select("title", "url")


@query("a22_newest_weights", W + """,
r AS (SELECT day, page, count(*) AS impressions FROM facts GROUP BY day, page)
SELECT page, max(impressions) AS weight FROM r
WHERE day IN (SELECT DISTINCT day FROM facts ORDER BY day DESC LIMIT 3) GROUP BY page""")
def newest_weights(spark, sf):
    r = facts(spark, sf).groupBy("day", "page").agg(F.count(F.lit(1)).alias("impressions"))
    return se.weights_of_newest(r, "day", 3)


# ------------------------------------------------------------- search queries (V4)

P = "[+\\-$#*_~|/\\\\:;,.、。．・!！?？()\\[\\]{}<>「」『』【】]"
EDGE = "[ \\t\\r\\n+\\-$#*_~|/\\\\:;,.、。．・!！?？()\\[\\]{}<>「」『』【】]+"
NORM = f""",
n1 AS (SELECT *, regexp_replace(lower(trim(query)), '^["''`“”‘’]+|["''`“”‘’]+$', '', 'g') AS a FROM search_queries),
n2 AS (SELECT *, regexp_replace(a, '^{EDGE}|{EDGE}$', '', 'g') AS b FROM n1),
norm AS (SELECT query_id, query, impressions, ctr, position,
  trim(regexp_replace(regexp_replace(b, '{P}+', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM n2),
hyg AS (SELECT *, key = ''
  OR regexp_matches(key, '(^|[^\\p{{L}}\\p{{N}}_])(the model returned|data retention mode|traceback|stack trace)([^\\p{{L}}\\p{{N}}_]|$)')
  OR (length(key) < 10 AND NOT regexp_matches(key, '[0-9]{{3}}\\s*(エラー|error|エラ|とは)'))
  OR regexp_matches(key, '(^|[^\\p{{L}}\\p{{N}}_])(const|let|var|require|import|function|=>)([^\\p{{L}}\\p{{N}}_]|$)')
  OR (regexp_matches(key, '[;=<>{{}}()]') AND regexp_matches(key, '(^|[^\\p{{L}}\\p{{N}}_])[a-z_][a-z0-9_]*([^\\p{{L}}\\p{{N}}_]|$)'))
  OR regexp_matches(key, '^[^\\p{{L}}]+$') AS bad FROM norm)"""
WQ = f"WITH {SEARCH_QUERIES} "


@query("t24_query_tokens", WQ + """,
s AS (SELECT query_id, regexp_split_to_array(lower(regexp_replace(regexp_replace(query,
   '([a-zA-Z0-9])([^\\x00-\\x7F])', '\\1 \\2', 'g'), '([^\\x00-\\x7F])([a-zA-Z0-9])', '\\1 \\2', 'g')),
   '[ \\t\\r\\n\\-_./,()\\[\\]"'':]+') AS t FROM search_queries),
u AS (SELECT DISTINCT query_id, unnest(t) AS tok FROM s)
SELECT s.query_id, coalesce(string_agg(tok, ' ' ORDER BY tok), '') AS tokens FROM s LEFT JOIN
 (SELECT * FROM u WHERE length(tok) >= 2 AND tok NOT IN ('a','an','the','in','on','at','for','to','of','and','or',
  'is','are','was','be','with','by','from','as','it','i','not','how','what','why','when','where','error','vs',
  'get','cannot','can','could','that','this','these','those','using','use','via','make','do','did','does','my')) u
 USING (query_id) GROUP BY s.query_id""")
def query_tokens(spark, sf):
    q = search_queries(spark, sf)
    return q.select("query_id", F.array_join(F.array_sort(tx.tokens("query")), " ").alias("tokens"))


@query("t25_normalize_query", WQ + NORM + "SELECT query_id, key FROM norm")
def normalize_query(spark, sf):
    return search_queries(spark, sf).select("query_id", tx.normalize_query("query").alias("key"))


@query("f04_query_hygiene", WQ + NORM + "SELECT query_id, query, NOT bad AS kept FROM hyg")
def query_hygiene(spark, sf):
    return search_queries(spark, sf).select(
        "query_id", "query", (~tx.is_bad_query("query")).alias("kept"))


@query("w04_first_wins", WQ + NORM + """
SELECT query_id, query FROM hyg WHERE NOT bad
QUALIFY row_number() OVER (PARTITION BY key ORDER BY query_id) = 1""")
def first_wins(spark, sf):
    return se.gap_queries(search_queries(spark, sf), ["query_id"]).select("query_id", "query")
