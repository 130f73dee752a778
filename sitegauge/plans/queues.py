"""Keyed upsert queries (V1, V2, V3, V6, V7) and payload validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.common import r6
from ..operators import audit as au
from ..operators import queues as qu
from .audit import history, latest, ok_history
from .bindings import ARTICLES, EXPERIMENTS, FACTS, HISTORY, articles, experiments, facts, table
from .corpus import VIS
from .registry import query
from .traffic import SCORED, vote_scores


@query("u01_merge_queue", f"WITH {FACTS} " + SCORED + """,
n AS (SELECT title, priority_score, priority_score >= 1 AS critical FROM scored WHERE priority_score > 0),
q AS (SELECT DISTINCT page AS title FROM facts WHERE k % 3 = 0)
SELECT title, round(priority_score, 6) AS priority_score, critical, CASE WHEN critical THEN 0 ELSE 1 END AS part, 'feedback' AS source
FROM n WHERE title NOT IN (SELECT title FROM q)
UNION ALL SELECT title, 0.1, false, 2, 'queued' FROM q""")
def u01_merge(spark, sf):
    q = facts(spark, sf).filter(F.col("k") % 3 == 0).select(F.col("page").alias("title")).distinct()
    q = q.select("title", F.lit(0.1).alias("priority_score"), F.lit(False).alias("critical"),
                 F.lit("queued").alias("source"))
    return qu.merge_queue(vote_scores(spark, sf), q).withColumn(
        "priority_score", r6("priority_score"))


@query("u02_thin_flags", f"""WITH {ARTICLES},
c AS (SELECT 'a' || article_id AS title, article_id, {VIS} AS chars FROM articles),
q AS (SELECT title, article_id % 4 = 0 AS is_thin, CASE WHEN article_id % 4 = 0 THEN 7 END AS thin_chars FROM c WHERE article_id % 2 = 0),
j AS (SELECT coalesce(c.title, q.title) AS title, q.title IS NOT NULL AS queued, q.is_thin AS was, q.thin_chars, c.chars,
   c.chars < 1200 AS thin FROM (SELECT * FROM c WHERE article_id % 6 <> 0) c FULL JOIN q ON c.title = q.title)
SELECT title, CASE WHEN queued THEN 1.5 ELSE 0.3 END::DOUBLE AS priority_score, coalesce(thin, was, false) AS is_thin,
  CASE WHEN coalesce(thin AND NOT coalesce(was, false), false) THEN chars ELSE thin_chars END AS thin_chars,
  CASE WHEN queued THEN 'queue' ELSE 'thin_scan' END AS source FROM j WHERE queued OR thin""")
def u02_thin(spark, sf):
    a = articles(spark, sf)
    i = F.col("article_id")
    title = F.concat(F.lit("a"), i.cast("string"))
    n = tx.visible_length("body").cast("long")
    corpus = a.filter(i % 6 != 0).select(title.alias("title"), n.alias("chars"), (n < 1200).alias("thin"))
    q = a.filter(i % 2 == 0).select(
        title.alias("title"), F.lit(1.5).alias("priority_score"), (i % 4 == 0).alias("is_thin"),
        F.when(i % 4 == 0, 7).cast("long").alias("thin_chars"))
    return qu.upsert_thin_flags(q, corpus)


@query("u03_upsert_candidates", f"""WITH {HISTORY},
r AS (SELECT path, CASE WHEN risk >= 70 OR factual < 55 THEN 'high' WHEN freshness < 50 OR citation < 15 THEN 'medium' ELSE 'low' END AS priority,
  list_filter([CASE WHEN factual < 75 THEN 'factual' END, CASE WHEN risk > 55 THEN 'risk' END, CASE WHEN citation < 15 THEN 'citation' END], lambda x: x IS NOT NULL) AS reasons,
  ['review', 'rescore'] AS actions FROM latest WHERE NOT (factual >= 75 AND risk <= 55 AND citation >= 15)),
e AS (SELECT DISTINCT path, 'low' AS priority, ['legacy', 'risk'] AS reasons, ['review'] AS actions FROM ok_history WHERE risk > 97),
j AS (SELECT coalesce(e.path, r.path) AS path, coalesce(r.priority, e.priority) AS priority, coalesce(e.reasons, []) AS o, coalesce(r.reasons, []) AS n,
  coalesce(e.actions, []) AS oa, coalesce(r.actions, []) AS na FROM e FULL JOIN r ON e.path = r.path)
SELECT path, priority, array_to_string(list_concat(o, list_filter(n, lambda x: NOT list_contains(o, x))), ',') AS reasons,
  array_to_string(list_concat(oa, list_filter(na, lambda x: NOT list_contains(oa, x))), ',') AS actions FROM j""")
def u03_candidates(spark, sf):
    lt = latest(spark, sf, *au.AXES)
    reasons = F.array_compact(F.array(F.when(F.col("factual") < 75, "factual"),
                                      F.when(F.col("risk") > 55, "risk"),
                                      F.when(F.col("citation") < 15, "citation")))
    passed = au.gate_passes(au.C.LIVE_GATE)
    new = lt.filter(~passed).select(
        "path", qu.candidate_priority(F.lit(False), F.lit(False)).alias("priority"),
        reasons.alias("reasons"), F.array(F.lit("review"), F.lit("rescore")).alias("actions"))
    old = ok_history(spark, sf, "path", "risk").filter(F.col("risk") > 97).select("path").distinct().select(
        "path", F.lit("low").alias("priority"), F.array(F.lit("legacy"), F.lit("risk")).alias("reasons"),
        F.array(F.lit("review")).alias("actions"))
    u = qu.upsert_candidates(old, new)
    return u.select("path", "priority", F.array_join("reasons", ",").alias("reasons"),
                    F.array_join("actions", ",").alias("actions"))


@query("u04_compare_sets", """
WITH a AS (SELECT DISTINCT o_custkey AS path FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT DISTINCT o_custkey AS path FROM orders WHERE o_orderstatus = 'O')
SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'right' WHEN b.path IS NULL THEN 'left' ELSE 'both' END AS side
FROM a FULL JOIN b ON a.path = b.path""")
def u04_sets(spark, sf):
    o = table(spark, sf, "orders")
    side = lambda s: o.filter(F.col("o_orderstatus") == s).select(
        F.col("o_custkey").alias("path")).distinct()
    return qu.compare_sets(side("F"), side("O"))


@query("u05_replace_append", f"""WITH {EXPERIMENTS},
n AS (SELECT slug, CASE WHEN length(slug) % 2 = 0 THEN rewrite_date ELSE DATE '2024-01-20' END AS rewrite_date, 0::BIGINT AS before_impressions
  FROM experiments WHERE before_impressions > 45)
SELECT slug, rewrite_date::VARCHAR AS rewrite_date, before_impressions FROM n
UNION ALL SELECT slug, rewrite_date::VARCHAR, before_impressions FROM experiments e
WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.slug = e.slug AND n.rewrite_date = e.rewrite_date)""")
def u05_replace(spark, sf):
    e = experiments(spark, sf).select("slug", "rewrite_date", "before_impressions")
    new = e.filter(F.col("before_impressions") > 45).select(
        "slug", F.when(F.length("slug") % 2 == 0, F.col("rewrite_date"))
        .otherwise(F.lit("2024-01-20").cast("date")).alias("rewrite_date"),
        F.lit(0).cast("long").alias("before_impressions"))
    return qu.replace_and_append(e, new, ["slug", "rewrite_date"]).withColumn(
        "rewrite_date", F.col("rewrite_date").cast("string"))


@query("u06_attempts", f"""WITH {HISTORY},
l AS (SELECT path, max(CASE WHEN judgement = 'pass' THEN (checked_at, seq) END) AS last FROM history GROUP BY path),
n AS (SELECT h.path, count(*) AS failures FROM history h JOIN l USING (path)
  WHERE judgement <> 'pass' AND (last IS NULL OR (checked_at, seq) > last) GROUP BY h.path)
SELECT path, failures, CASE WHEN failures >= 3 THEN 'needs_manual_review' ELSE 'retry' END AS state FROM n""")
def u06_attempts(spark, sf):
    return qu.attempts_since_success(
        history(spark, sf, "path", "judgement", "checked_at", "seq"), "path", F.col("judgement") == "pass",
                                     ["checked_at", "seq"])


@query("u07_dedupe_sources", f"""WITH {EXPERIMENTS},
u AS (SELECT 1 AS src, CASE WHEN length(slug) % 2 = 0 THEN slug ELSE '' END AS slug, 'https://e.org' || slug AS url, slug AS title, before_impressions AS n FROM experiments
  UNION ALL SELECT 2, slug, 'https://e.org' || slug, slug, after_impressions FROM experiments
  UNION ALL SELECT 3, NULL, NULL, slug, 0 FROM experiments WHERE before_impressions > 50)
SELECT coalesce(nullif(slug, ''), nullif(url, ''), nullif(title, ''), '') AS key, src, n FROM u
QUALIFY row_number() OVER (PARTITION BY coalesce(nullif(slug, ''), nullif(url, ''), nullif(title, ''), '') ORDER BY src, title) = 1""")
def u07_dedupe(spark, sf):
    e = experiments(spark, sf)
    url = F.concat(F.lit("https://e.org"), "slug")
    none = F.lit(None).cast("string")
    a = e.select(F.lit(1).alias("src"), F.when(F.length("slug") % 2 == 0, F.col("slug")).otherwise("")
                 .alias("slug"), url.alias("url"), F.col("slug").alias("title"),
                 F.col("before_impressions").alias("n"))
    b = e.select(F.lit(2).alias("src"), "slug", url.alias("url"), F.col("slug").alias("title"),
                 F.col("after_impressions").alias("n"))
    c = e.filter(F.col("before_impressions") > 50).select(
        F.lit(3).alias("src"), none.alias("slug"), none.alias("url"), F.col("slug").alias("title"),
        F.lit(0).cast("long").alias("n"))
    return qu.dedupe_across_sources(a.unionByName(b).unionByName(c), ["src", "title"]).select(
        "key", "src", "n")


@query("u08_review_history", f"""WITH {ARTICLES},
f AS (SELECT article_id, pub_date::VARCHAR AS d, 'tox' || toxic AS note FROM articles JOIN labels ON doc_id = article_id WHERE quality = 1),
n AS (SELECT article_id FROM articles WHERE article_id % 5 = 0)
SELECT coalesce(f.article_id, n.article_id) AS article_id, coalesce(d, '2025-06-01') AS verified_at,
  CASE WHEN n.article_id IS NOT NULL THEN '2025-06-01' ELSE d END AS last_verified_at,
  concat_ws('|', d || ':' || note, CASE WHEN n.article_id IS NOT NULL THEN '2025-06-01:again' END) AS history
FROM f FULL JOIN n ON f.article_id = n.article_id""")
def u08_reviews(spark, sf):
    lab = table(spark, sf, "labels").filter(F.col("quality") == 1)
    a = articles(spark, sf)
    flat = a.join(lab, a.article_id == lab.doc_id).select(
        "article_id", F.lit(True).alias("verified"), F.col("pub_date").cast("string").alias("verified_at"),
        F.concat(F.lit("tox"), F.col("toxic").cast("string")).alias("note"))
    new = a.filter(F.col("article_id") % 5 == 0).select(
        "article_id", F.lit("2025-06-01").alias("date"), F.lit("again").alias("note"))
    s = qu.append_reviews(qu.migrate_reviews(flat, "article_id"), new, "article_id")
    return s.select("article_id", "verified_at", "last_verified_at", F.array_join(F.transform(
        "history", lambda h: F.concat(h["date"], F.lit(":"), h["note"])), "|").alias("history"))


@query("u09_new_names", """
SELECT DISTINCT p_name AS name FROM part WHERE length(p_name) >= 2 AND p_name NOT LIKE 'red%'""")
def u09_names(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    lines = p.select(F.when(k % 2 == 0, F.concat(k.cast("string"), F.lit(". "), "p_name"))
                     .otherwise(F.concat(F.lit("・ "), "p_name")).alias("line"))
    old = p.filter(F.col("p_name").startswith("red")).select(F.col("p_name").alias("name")).distinct()
    return qu.new_names(lines, old)


@query("t32_validate_payload", """
WITH e AS (SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events),
c AS (SELECT event_id, k, CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 11 = 1 THEN 'bad' WHEN event_id % 11 = 2 THEN 'bool'
  WHEN event_id % 11 = 3 THEN 'missing' WHEN event_id % 11 = 4 THEN 'word' ELSE 'ok' END AS c FROM e)
SELECT event_id, CASE WHEN c = '' THEN 'empty response' WHEN c = 'bad' THEN 'json_parse_error' WHEN c = 'bool' THEN 'invalid type for k'
   WHEN c = 'missing' THEN 'missing required keys: k' WHEN c = 'word' THEN 'non numeric score for k'
   WHEN k > 80 THEN 'score out of range for k' ELSE '' END AS error,
  CASE WHEN c = 'ok' AND k <= 80 THEN k END AS score FROM c""")
def t32_payload(spark, sf):
    e, m = table(spark, sf, "events"), F.col("event_id") % 11
    raw = (F.when(m == 0, "").when(m == 1, F.concat(F.lit("{"), "props"))
           .when(m == 2, F.lit('{"k": true}')).when(m == 3, F.lit('{"x": 1}'))
           .when(m == 4, F.lit('{"k": "abc"}'))
           .when(m == 5, F.concat(F.lit("```json\n"), "props", F.lit("\n```")))
           .otherwise(F.col("props")))
    v = e.select("event_id", qu.validate_payload(raw, ("k",), 0, 80).alias("v"))
    return v.select("event_id", "v.error", F.col("v.scores")["k"].alias("score"))
