"""Selection, rewrite-outcome, change-event and cost queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r6
from ..operators import corpus as co
from ..operators import selection as sel
from ..operators import traffic as tr
from .audit import ok_history
from .bindings import (ARTICLES, AS_OF, EXPERIMENTS, FACTS, HISTORY, articles, experiments, facts,
                       table)
from .corpus import CLASSES, HIGH, LINT, _linted
from .registry import query
from .traffic import SCORED, vote_scores

# ----------------------------------------------------------------- rewrite outcomes

K = "CAST(regexp_extract(slug, '([0-9]+)', 1) AS BIGINT)"
EXP2 = f"""{EXPERIMENTS},
x AS (SELECT slug, CASE WHEN {K} % 9 = 0 THEN DATE '2024-02-01' ELSE rewrite_date END AS rewrite_date,
  CASE WHEN {K} % 8 = 0 THEN NULL ELSE before_impressions END AS bi, before_clicks AS bc, before_position AS bp,
  CASE WHEN {K} % 7 = 0 THEN NULL ELSE after_impressions END AS ai, after_clicks AS ac, after_position AS ap FROM experiments),
v AS (SELECT *, DATE '2024-02-05' - rewrite_date AS elapsed_days, CASE WHEN DATE '2024-02-05' - rewrite_date < 14 THEN 'too early'
    WHEN bi IS NULL OR bp IS NULL THEN 'no before data' WHEN ai IS NULL OR ap IS NULL THEN 'no after data' ELSE 'measured' END AS reason FROM x),
vv AS (SELECT slug, elapsed_days::INTEGER AS elapsed_days, reason, CASE WHEN reason <> 'measured' THEN 'pending'
   WHEN (ai - bi) / bi::DOUBLE >= 0.2 OR bp - ap >= 1 OR ac > bc THEN 'improved'
   WHEN (ai - bi) / bi::DOUBLE <= -0.2 AND bp - ap <= -1 THEN 'worse' ELSE 'unchanged' END AS verdict FROM v)"""


def _outcomes(spark, sf):
    e = experiments(spark, sf)
    k = F.regexp_extract("slug", "([0-9]+)", 1).cast("long")
    e = (e.withColumn("rewrite_date", F.when(k % 9 == 0, F.lit("2024-02-01").cast("date"))
                      .otherwise(F.col("rewrite_date")))
         .withColumn("before_impressions", F.when(k % 8 != 0, F.col("before_impressions")))
         .withColumn("after_impressions", F.when(k % 7 != 0, F.col("after_impressions"))))
    v = sel.rewrite_verdict(F.lit("2024-02-05").cast("date"), ranks=1.0)
    return e.select("slug", *[c.alias(n) for n, c in v.items()])


@query("g14_rewrite_verdict", f"WITH {EXP2} SELECT slug, elapsed_days, reason, verdict FROM vv")
def g14_verdict(spark, sf):
    return _outcomes(spark, sf)


@query("k05_outcome_order", f"""WITH {EXP2} SELECT slug, verdict, elapsed_days FROM vv
ORDER BY CASE verdict WHEN 'worse' THEN 0 WHEN 'improved' THEN 1 WHEN 'unchanged' THEN 2 ELSE 3 END, elapsed_days DESC, slug LIMIT 40""")
def k05_order(spark, sf):
    return sel.outcome_order(_outcomes(spark, sf), 40).select("slug", "verdict", "elapsed_days")


@query("a21_verdict_counts", f"""WITH {EXP2}, n AS (SELECT unnest(['worse', 'improved', 'unchanged', 'pending']) AS verdict)
SELECT n.verdict, count(vv.slug) AS n FROM n LEFT JOIN vv ON vv.verdict = n.verdict GROUP BY n.verdict""")
def a21_counts(spark, sf):
    return sel.verdict_counts(_outcomes(spark, sf))


J10 = f"""{EXPERIMENTS},
m AS (SELECT rtrim(page, '/') AS u, count(*) AS impressions, sum(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) / count(*) AS ctr,
  avg(value) / 4 AS position FROM facts WHERE day >= DATE '2024-01-20' AND k % 6 <> 5 GROUP BY 1),
x AS (SELECT slug, CASE WHEN {K} % 9 = 0 THEN DATE '2024-02-01' ELSE rewrite_date END AS rewrite_date, before_ctr, before_position,
  CASE WHEN {K} % 5 = 0 THEN 0.5 END AS after_ctr FROM experiments),
d AS (SELECT x.*, m.u IS NOT NULL AND rewrite_date <= DATE '2024-02-05' - 14 AND after_ctr IS NULL AS updated, m.ctr, m.position, m.impressions
  FROM x LEFT JOIN m ON m.u = rtrim(x.slug, '/')),
filled AS (SELECT slug, updated, CASE WHEN updated THEN ctr - before_ctr END AS ctr_change,
  CASE WHEN updated THEN position - before_position END AS position_change, CASE WHEN updated THEN ctr ELSE after_ctr END AS after_ctr,
  CASE WHEN updated THEN impressions END AS after_impressions FROM d)"""


def _filled(spark, sf):
    k = F.regexp_extract("slug", "([0-9]+)", 1).cast("long")
    e = experiments(spark, sf).select(
        "slug", F.regexp_replace("slug", "/$", "").alias("url"),
        F.when(k % 9 == 0, F.lit("2024-02-01").cast("date")).otherwise(F.col("rewrite_date"))
        .alias("rewrite_date"), "before_ctr", "before_position", F.when(k % 5 == 0, 0.5).alias("after_ctr"))
    recent = facts(spark, sf).filter((F.col("day") >= F.lit("2024-01-20").cast("date"))
                                     & (F.col("k") % 6 != 5))
    return sel.fill_after_metrics(e, tr.page_metrics(recent), F.lit("2024-02-05").cast("date"))


@query("j10_fill_after", f"""WITH {J10}
SELECT slug, updated, round(ctr_change, 6) AS ctr_change, round(position_change, 6) AS position_change,
  round(after_ctr, 6) AS after_ctr, after_impressions FROM filled""")
def j10_fill(spark, sf):
    f = _filled(spark, sf)
    return f.select("slug", "updated", r6("ctr_change").alias("ctr_change"),
                    r6("position_change").alias("position_change"), r6("after_ctr").alias("after_ctr"),
                    "after_impressions")


@query("k06_ctr_rankings", f"""WITH {J10},
g AS (SELECT 'gain' AS side, slug, round(ctr_change, 6) AS ctr_change FROM filled WHERE ctr_change IS NOT NULL ORDER BY ctr_change DESC, slug LIMIT 20),
l AS (SELECT 'loss' AS side, slug, round(ctr_change, 6) AS ctr_change FROM filled WHERE ctr_change IS NOT NULL ORDER BY ctr_change, slug LIMIT 20)
SELECT * FROM g UNION ALL SELECT * FROM l""")
def k06_rankings(spark, sf):
    gain, loss = sel.ctr_rankings(_filled(spark, sf))
    pick = lambda d, s: d.select(F.lit(s).alias("side"), "slug", r6("ctr_change").alias("ctr_change"))
    return pick(gain, "gain").unionByName(pick(loss, "loss"))


# -------------------------------------------------------------- change events, costs


@query("a19_change_rollup", """
WITH e AS (SELECT o_orderkey, o_orderstatus AS s, CASE WHEN o_custkey % 20 = 0 THEN 'static/' ELSE 'content/posts/c' END || o_custkey || '.md' AS path,
  'content/posts/n' || o_custkey || '.md' AS new_path, o_orderkey % 50 = 0 AS ren, o_orderkey % 70 = 3 AS pub, o_orderkey % 71 = 5 AS unp FROM orders),
m AS (SELECT new_path AS p, 'modified' AS k FROM e WHERE ren
  UNION ALL SELECT path, CASE WHEN pub THEN 'new' WHEN unp THEN 'unpublished' WHEN s = 'O' THEN 'new' WHEN s = 'P' THEN 'unpublished' ELSE 'modified' END
  FROM e WHERE NOT ren AND path LIKE 'content/posts/%'),
f AS (SELECT p, bool_or(k = 'new') AS n, bool_or(k = 'modified') AS m, bool_or(k = 'unpublished') AS u FROM m GROUP BY p)
SELECT count(*) FILTER (n) AS added, count(*) FILTER (m AND NOT n) AS modified, count(*) FILTER (u AND NOT n) AS unpublished,
  (SELECT count(DISTINCT path) FROM e WHERE ren AND path LIKE 'content/posts/%') AS renamed_from,
  (SELECT count(DISTINCT new_path) FROM e WHERE ren) AS renamed_to FROM f""")
def a19_changes(spark, sf):
    o = table(spark, sf, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    path = F.concat(F.when(F.col("o_custkey") % 20 == 0, "static/").otherwise("content/posts/c"), c,
                    F.lit(".md"))
    s = F.col("o_orderstatus")
    status = (F.when(k % 50 == 0, "R100").when(s == "O", "A").when(s == "P", "D").otherwise("M"))
    pub, unp = k % 70 == 3, k % 71 == 5
    events = o.select(status.alias("status"), path.alias("path"), path.alias("old_path"),
                      F.concat(F.lit("content/posts/n"), c, F.lit(".md")).alias("new_path"),
                      F.when(pub, True).when(unp, False).alias("old_draft"),
                      F.when(pub, False).when(unp, True).alias("new_draft"))
    return sel.change_rollup(events)


PRICES = (("A", 5.0, 25.0, 6.25, 0.5, 0.01), ("N", 2.0, 10.0, 2.5, 0.2, 0.01),
          ("R", 1.0, 5.0, 1.25, 0.1, 0.01))


@query("a23_token_costs", """
WITH p(model, a, b, c, d, w) AS (VALUES ('A', 5.0::DOUBLE, 25.0::DOUBLE, 6.25::DOUBLE, 0.5::DOUBLE, 0.01::DOUBLE),
  ('N', 2.0, 10.0, 2.5, 0.2, 0.01), ('R', 1.0, 5.0, 1.25, 0.1, 0.01)),
t AS (SELECT l_returnflag AS model, sum((l_quantity * 1000)::BIGINT)::BIGINT AS input, sum((l_quantity * 300)::BIGINT)::BIGINT AS output,
  sum(l_partkey)::BIGINT AS cache_write, sum(l_suppkey)::BIGINT AS cache_read, sum(l_linenumber)::BIGINT AS web_requests FROM lineitem GROUP BY 1)
SELECT model, input, output, cache_write, cache_read, web_requests, round(input / 1e6 * a, 6) AS input_cost, round(output / 1e6 * b, 6) AS output_cost,
  round(cache_write / 1e6 * c + cache_read / 1e6 * d, 6) AS cache_cost, round(web_requests * w, 6) AS web_cost,
  round(input / 1e6 * a + output / 1e6 * b + (cache_write / 1e6 * c + cache_read / 1e6 * d) + web_requests * w, 6) AS total_cost
FROM t JOIN p USING (model)""")
def a23_costs(spark, sf):
    li = table(spark, sf, "lineitem")
    usage = li.select(
        F.col("l_returnflag").alias("model"), (F.col("l_quantity") * 1000).cast("long").alias("input"),
        (F.col("l_quantity") * 300).cast("long").alias("output"), F.col("l_partkey").alias("cache_write"),
        F.col("l_suppkey").alias("cache_read"), F.col("l_linenumber").cast("long").alias("web_requests"))
    prices = spark.createDataFrame(
        PRICES, "model string, input_price double, output_price double, cache_write_price double, "
                "cache_read_price double, web_price double")
    return sel.token_costs(usage, prices)


# ---------------------------------------------------------------------- selections


@query("k07_recheck", f"""WITH {HISTORY}, {ARTICLES}, {FACTS},
w AS (SELECT k, day, count(*) AS n FROM facts GROUP BY k, day),
t AS (SELECT k, max(n) AS traffic FROM w WHERE day IN (SELECT DISTINCT day FROM facts ORDER BY day DESC LIMIT 3) GROUP BY k),
pr AS (SELECT path, min(factual - risk) AS prior FROM ok_history GROUP BY path),
d AS (SELECT 'p' || article_id AS path, DATE '{AS_OF}' - pub_date AS age, DATE '{AS_OF}' - (pub_date + (article_id % 30)::INTEGER) AS stale,
  regexp_matches(lower(body), '{HIGH}') AS high, traffic, article_id % 4 AS citations, prior
  FROM articles LEFT JOIN t ON t.k = article_id % 100 LEFT JOIN pr ON pr.path = 'p' || article_id)
SELECT path, (age + stale + CASE WHEN high THEN 180 ELSE 0 END + least(200, coalesce(traffic, 0)) + CASE WHEN citations < 2 THEN 80 ELSE 0 END
  + CASE WHEN prior < 35 THEN 40 ELSE 0 END)::BIGINT AS priority FROM d ORDER BY priority DESC, path DESC LIMIT 20""")
def k07_recheck(spark, sf):
    from ..operators.search import weights_of_newest
    a = articles(spark, sf)
    as_of = F.lit(AS_OF).cast("date")
    path = F.concat(F.lit("p"), F.col("article_id").cast("string"))
    daily = facts(spark, sf).groupBy("day", F.col("k").alias("page")).agg(
        F.count(F.lit(1)).alias("impressions"))
    traffic = weights_of_newest(daily, "day").select(
        F.col("page").alias("k"), F.col("weight").alias("traffic"))
    prior = ok_history(spark, sf, "path", "factual", "risk").groupBy("path").agg(
        F.min(F.col("factual") - F.col("risk")).alias("prior"))
    d = a.select(
        path.alias("path"), (F.col("article_id") % 100).alias("k"),
        F.datediff(as_of, F.col("pub_date")).alias("age"),
        F.datediff(as_of, F.date_add("pub_date", (F.col("article_id") % 30).cast("int"))).alias("stale"),
        co.high_change(F.col("body")).alias("high_change"),
        (F.col("article_id") % 4).alias("citations"))
    d = d.join(traffic, "k", "left").join(prior, "path", "left")
    return sel.recheck_selection(d).select("path", "priority")


@query("k08_refresh_order", f"WITH {FACTS} " + SCORED + f""", {ARTICLES},
m AS (SELECT article_id, CASE WHEN article_id % 3 = 0 THEN pub_date + 60 ELSE pub_date END AS d FROM articles),
x AS (SELECT 'p' || m.article_id AS path, d::DATE::VARCHAR AS check_date, round(coalesce(s.priority_score, 0), 6) AS score
  FROM m LEFT JOIN scored s ON s.title = '/posts/p' || m.article_id % 100 || '/' AND s.priority_score > 0
  WHERE DATE '{AS_OF}' - d::DATE >= 90)
SELECT * FROM x ORDER BY score DESC, check_date, path LIMIT 20""")
def k08_refresh(spark, sf):
    i, d = F.col("article_id"), F.col("pub_date")
    man = F.when(i % 3 == 0, F.date_add(d, 60).cast("string"))
    docs = articles(spark, sf).filter(co.refresh_due(man, d.cast("string"), F.lit(AS_OF).cast("date"))).select(
        F.concat(F.lit("p"), i.cast("string")).alias("path"),
        F.coalesce(man, d.cast("string")).alias("check_date"),
        F.concat(F.lit("/posts/p"), (i % 100).cast("string"), F.lit("/")).alias("title"))
    q = vote_scores(spark, sf).withColumn("priority_score", r6("priority_score"))
    return sel.refresh_order(docs, q).select("path", "check_date", "score")


@query("k09_recent", f"""WITH {ARTICLES}
SELECT article_id, pub_date::VARCHAR AS pub_date FROM articles ORDER BY pub_date DESC, article_id DESC LIMIT 10""")
def k09_recent(spark, sf):
    return sel.recent(articles(spark, sf), "pub_date", "article_id").select(
        "article_id", F.col("pub_date").cast("string").alias("pub_date"))


@query("k11_daily_slots", f"""WITH {ARTICLES},
s AS (SELECT greatest(0, 20 - count(*)) AS slots FROM articles WHERE pub_date = DATE '2024-02-10'),
pend AS (SELECT article_id AS key, article_id % 15 = 1 OR article_id % 25 = 6 AS bad FROM articles WHERE article_id % 50 IN (1, 6)),
good AS (SELECT key, row_number() OVER (ORDER BY key) AS rn FROM pend WHERE NOT bad),
pub AS (SELECT key FROM good, s WHERE rn <= slots),
st AS (SELECT slots, (SELECT count(*) FROM pub) AS used, (SELECT max(key) FROM pub) AS cut FROM s),
q AS (SELECT article_id AS key, row_number() OVER (ORDER BY article_id) AS rn FROM articles WHERE article_id % 5 = 2 QUALIFY rn <= 30)
SELECT key, 'pending' AS source, CASE WHEN slots > 0 AND coalesce(used < slots OR key <= cut, false) THEN CASE WHEN bad THEN 'dropped' ELSE 'published' END ELSE 'pending' END AS outcome
FROM pend, st
UNION ALL SELECT key, 'queue', CASE WHEN rn <= slots - used THEN 'published' ELSE 'pending' END FROM q, st WHERE slots - used > 0""")
def k11_slots(spark, sf):
    a, i = articles(spark, sf), F.col("article_id")
    today = a.filter(F.col("pub_date") == F.lit("2024-02-10").cast("date"))
    pending = a.filter((i % 50).isin(1, 6)).select(
        i.alias("key"), i.alias("ord"), ((i % 15 == 1) | (i % 25 == 6)).alias("bad"))
    queue = a.filter(i % 5 == 2).select(i.alias("key"), i.alias("ord"))
    return sel.allocate_slots(today, pending, queue, quota=20)


@query("k12_lacking_fields", """
SELECT p_partkey, p_name FROM part WHERE p_size % 3 = 0 OR p_size % 7 = 0 ORDER BY p_partkey LIMIT 50""")
def k12_lacking(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") % 3 != 0, "https://e.org").alias("source_urls"),
        F.when(F.col("p_size") % 7 == 0, " ").otherwise("x").alias("alternatives"))
    return sel.lacking_fields(p, ("source_urls", "alternatives"), "p_partkey", 50).select(
        "p_partkey", "p_name")


@query("k13_rewrite_worklist", f"WITH {LINT}" + CLASSES + """
SELECT article_id, list_contains(fails, 'A6') AS late FROM cl
WHERE is_error AND len(fails) > 0 AND NOT list_contains(fails, 'B2') AND article_id % 8 <> 0""")
def k13_worklist(spark, sf):
    gone = articles(spark, sf).filter(F.col("article_id") % 8 == 0).select("article_id")
    return sel.rewrite_worklist(_linted(spark, sf), "article_id", gone, co.fail_rules(), "A6").select(
        "article_id", "late")
