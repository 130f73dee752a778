"""Score-history audit queries on the history view (V3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.common import r6
from ..operators import audit as au
from .bindings import (ARTICLES, CITED_URLS, HISTORY, articles, cited_urls, history_raw, table)
from .registry import query

W = f"WITH {HISTORY} "
AS_OF = "1998-06-01"
AUDIT_OK = "factual >= 75 AND freshness >= 50 AND citation >= 10 AND risk <= 55"
GROUP = ("path", "article_hash", "judgement", *au.AXES)  # columns of rescore groups
AXES_SQL = "['factual', 'freshness', 'citation', 'risk']"


def history(spark, sf, *cols):
    """History with the given columns; keeping the last row per id hides unused ones from pruning."""
    raw = history_raw(spark, sf)
    return au.keep_last(raw.select(*dict.fromkeys(("eval_id", "order_key", *cols))), rows=raw.count())


def ok_history(spark, sf, *cols):
    return history(spark, sf, "status", *cols).filter(F.col("status") == "ok").select(
        *dict.fromkeys(("eval_id", *cols)))


def latest(spark, sf, *cols):
    return au.latest(ok_history(spark, sf, "path", "checked_at", "seq", *cols))


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query("s02_history", W + """
SELECT eval_id, path, strftime(checked_at, '%Y-%m-%d') AS checked, factual, risk, status FROM history
WHERE checked_at >= DATE '1996-01-01' AND checked_at < DATE '1999-01-01'""")
def s02_history(spark, sf):
    rows = history(spark, sf, "path", "checked_at", "factual", "risk", "status")
    h = rows.filter((F.col("checked_at") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                    & (F.col("checked_at") < F.lit("1999-01-01").cast("timestamp_ntz")))
    return h.select("eval_id", "path", F.date_format("checked_at", "yyyy-MM-dd").alias("checked"),
                    "factual", "risk", "status")


@query("w01_latest", W + """
SELECT path, eval_id, strftime(checked_at, '%Y-%m-%d') AS checked, factual FROM latest""")
def w01_latest(spark, sf):
    return latest(spark, sf, "factual").select(
        "path", "eval_id", F.date_format("checked_at", "yyyy-MM-dd").alias("checked"), "factual")


@query("w09_rescore_groups", W + """
SELECT path, count(*) AS rows, count(DISTINCT article_hash) = 1 AND count(*) >= 2 AS pure,
  count(DISTINCT article_hash) > 1 AS hash_changed FROM ok_history GROUP BY path""")
def w09_groups(spark, sf):
    return au.hash_groups(ok_history(spark, sf, "path", "article_hash"))


G = """,
rg AS (SELECT path, max(factual) - min(factual) AS factual, max(freshness) - min(freshness) AS freshness,
    max(citation) - min(citation) AS citation, max(risk) - min(risk) AS risk,
    stddev_pop(factual) AS s1, stddev_pop(freshness) AS s2, stddev_pop(citation) AS s3, stddev_pop(risk) AS s4
  FROM ok_history WHERE path IN (SELECT path FROM pure) GROUP BY path),
long AS (SELECT path, unnest(['factual', 'freshness', 'citation', 'risk']) AS axis,
    unnest([factual, freshness, citation, risk])::DOUBLE AS range,
    round(unnest([s1, s2, s3, s4]), 4) AS std FROM rg),
var AS (SELECT axis, count(*) AS n_groups, quantile_cont(range, 0.5) AS range_median,
    quantile_cont(range, 0.9) AS range_p90, max(range) AS range_max, quantile_cont(std, 0.5) AS std_median
  FROM long GROUP BY axis)"""


@query("a26_rescore_variance", W + G + """
SELECT axis, n_groups, round(range_median, 6) AS range_median, round(range_p90, 6) AS range_p90,
  range_max, round(std_median, 6) AS std_median,
  CASE WHEN range_median < 5 THEN 'stable' WHEN range_median <= 15 THEN 'consider voting'
       ELSE 'revise gate' END AS verdict FROM var""")
def a26_variance(spark, sf):
    v = au.rescore_variance(au.rescore_groups(ok_history(spark, sf, *GROUP)))
    return v.select("axis", "n_groups", r6("range_median").alias("range_median"),
                    r6("range_p90").alias("range_p90"), "range_max",
                    r6("std_median").alias("std_median"), "verdict")


@query("a26_worst_groups", W + G + """
SELECT path, factual::DOUBLE AS factual_range FROM rg ORDER BY factual DESC, path LIMIT 5""")
def a26_worst(spark, sf):
    return au.worst_groups(au.rescore_groups(ok_history(spark, sf, *GROUP)))


@query("a27_flip_rate", W + f""",
v AS (SELECT *, {AUDIT_OK} AS ok, factual >= 75 AS a, freshness >= 50 AS b, citation >= 10 AS c, risk <= 55 AS d
      FROM ok_history),
g AS (SELECT path, count(DISTINCT ok) > 1 AS flips, count(DISTINCT a) > 1 AS a, count(DISTINCT b) > 1 AS b,
        count(DISTINCT c) > 1 AS c, count(DISTINCT d) > 1 AS d
      FROM v WHERE path IN (SELECT path FROM pure) GROUP BY path),
s AS (SELECT count(*) AS n_groups, count(*) FILTER (flips) AS flip_count,
        count(*) FILTER (flips AND a) AS cause_factual, count(*) FILTER (flips AND b) AS cause_freshness,
        count(*) FILTER (flips AND c) AS cause_citation, count(*) FILTER (flips AND d) AS cause_risk FROM g)
SELECT *, (SELECT count(*) FROM v WHERE ok <> (judgement = 'pass')) AS judgement_disagreements,
  round(flip_count / n_groups, 6) AS flip_rate,
  CASE WHEN flip_count / n_groups < 0.1 THEN 'stable' WHEN flip_count / n_groups <= 0.25 THEN 'consider voting'
       ELSE 'revise gate' END AS verdict FROM s""")
def a27_flips(spark, sf):
    return au.flip_rate(au.rescore_groups(ok_history(spark, sf, *GROUP))).withColumn(
        "flip_rate", r6("flip_rate"))


@query("a28_threshold_sensitivity", W + """,
l AS (SELECT unnest(['factual', 'freshness', 'citation', 'risk']) AS axis,
        unnest([factual, freshness, citation, risk])::DOUBLE AS value FROM latest),
t AS (SELECT * FROM (VALUES ('factual', 75.0, true), ('freshness', 50.0, true), ('citation', 10.0, true),
        ('risk', 55.0, false)) x(axis, base, lower)),
d AS (SELECT unnest([-10, -5, 0, 5, 10]) AS delta),
r AS (SELECT axis, delta, (base + delta)::DOUBLE AS threshold, count(*) AS n,
   quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90,
   min(value) AS min, max(value) AS max,
   avg(CASE WHEN (lower AND value >= base + delta) OR (NOT lower AND value <= base + delta) THEN 1.0 ELSE 0.0 END) AS pass_rate
   FROM l JOIN t USING (axis) CROSS JOIN d GROUP BY ALL)
SELECT axis, delta, threshold, n, round(median, 6) AS median, round(p10, 6) AS p10, round(p90, 6) AS p90,
  min, max, round(pass_rate, 6) AS pass_rate, delta = 0 AND pass_rate > 0.95 AS non_functional FROM r""")
def a28_sensitivity(spark, sf):
    t = au.threshold_sensitivity(latest(spark, sf, *au.AXES))
    return t.select("axis", "delta", "threshold", "n", r6("median").alias("median"),
                    r6("p10").alias("p10"), r6("p90").alias("p90"), "min", "max",
                    r6("pass_rate").alias("pass_rate"), "non_functional")


@query("a29_grey_zone", W + G + """,
m AS (SELECT max(CASE WHEN axis = 'factual' THEN range_median END) AS a, max(CASE WHEN axis = 'freshness' THEN range_median END) AS b,
  max(CASE WHEN axis = 'citation' THEN range_median END) AS c, max(CASE WHEN axis = 'risk' THEN range_median END) AS d FROM var),
z AS (SELECT factual >= 75 - a AND factual < 75 + a AS za, freshness >= 50 - b AND freshness < 50 + b AS zb,
  citation >= 10 - c AND citation < 10 + c AS zc, risk > 55 - d AND risk <= 55 + d AS zd FROM latest CROSS JOIN m)
SELECT unnest(['factual', 'freshness', 'citation', 'risk', 'overall']) AS axis,
  unnest([round(avg(za::INT), 6), round(avg(zb::INT), 6), round(avg(zc::INT), 6), round(avg(zd::INT), 6),
          round(avg((za OR zb OR zc OR zd)::INT), 6)]) AS rate FROM z""")
def a29_grey_zone(spark, sf):
    ok = ok_history(spark, sf, "checked_at", "seq", *GROUP)
    v = au.rescore_variance(au.rescore_groups(ok))
    return au.grey_zone(au.latest(ok), v).withColumn("rate", r6("rate"))


@query("a30_spearman", W + """,
r AS (SELECT rank() OVER (ORDER BY factual) + (count(*) OVER (PARTITION BY factual) - 1) / 2.0 AS factual,
  rank() OVER (ORDER BY freshness) + (count(*) OVER (PARTITION BY freshness) - 1) / 2.0 AS freshness,
  rank() OVER (ORDER BY citation) + (count(*) OVER (PARTITION BY citation) - 1) / 2.0 AS citation,
  rank() OVER (ORDER BY risk) + (count(*) OVER (PARTITION BY risk) - 1) / 2.0 AS risk FROM latest),
c AS (SELECT unnest(['factual','factual','factual','factual','freshness','freshness','freshness','freshness',
    'citation','citation','citation','citation','risk','risk','risk','risk']) AS axis1,
  unnest(['factual','freshness','citation','risk','factual','freshness','citation','risk',
    'factual','freshness','citation','risk','factual','freshness','citation','risk']) AS axis2,
  unnest([1.0, corr(factual, freshness), corr(factual, citation), corr(factual, risk),
    corr(factual, freshness), 1.0, corr(freshness, citation), corr(freshness, risk),
    corr(factual, citation), corr(freshness, citation), 1.0, corr(citation, risk),
    corr(factual, risk), corr(freshness, risk), corr(citation, risk), 1.0]) AS rho, count(*) AS n_rows FROM r)
SELECT axis1, axis2, n_rows, round(rho, 6) AS rho, axis1 < axis2 AND abs(rho) > 0.8 AS redundant FROM c""")
def a30_spearman(spark, sf):
    return au.spearman(latest(spark, sf, *au.AXES)).withColumn("rho", r6("rho"))


@query("a31_weekly_medians", W + """
SELECT strftime(checked_at, '%Y-W%W') AS week, quantile_cont(factual, 0.5) AS factual,
  quantile_cont(freshness, 0.5) AS freshness, quantile_cont(citation, 0.5) AS citation,
  quantile_cont(risk, 0.5) AS risk, count(*) AS n FROM ok_history GROUP BY 1""")
def a31_weekly(spark, sf):
    return au.weekly_medians(ok_history(spark, sf, "checked_at", *au.AXES))


@query("w08_change_points", W + """,
f AS (SELECT 'model' AS type, model AS value, min(checked_at) AS first_seen FROM history GROUP BY 2
      UNION ALL SELECT 'prompt_version', prompt_version, min(checked_at) FROM history GROUP BY 2)
SELECT type, value, strftime(first_seen, '%Y-%m-%d') AS first_seen FROM f
QUALIFY row_number() OVER (PARTITION BY type ORDER BY first_seen, value) > 1""")
def w08_change_points(spark, sf):
    return au.change_points(history(spark, sf, "model", "prompt_version", "checked_at")).withColumn(
        "first_seen", F.date_format("first_seen", "yyyy-MM-dd"))


def _posts(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("path"),
                    "o_orderkey", "o_orderstatus", "o_orderpriority")


ENRICH = """,
en AS (SELECT l.*, coalesce(d.o_orderkey IS NOT NULL, false) AS is_deleted,
    CASE WHEN CAST(substr(l.path, 2) AS BIGINT) % 3 = 0 THEN 'rss' ELSE 'daily' END AS article_type,
    CASE WHEN a.o_orderkey IS NULL THEN 'deleted' ELSE a.o_orderpriority END AS tool
  FROM latest l
  LEFT JOIN orders d ON l.path = 'p' || d.o_orderkey AND d.o_orderstatus = 'P' AND d.o_orderkey % 2 = 0
  LEFT JOIN orders a ON l.path = 'p' || a.o_orderkey AND a.o_orderkey % 10 <> 0)"""


def _enriched(spark, sf, *cols):
    posts = _posts(spark, sf)
    deleted = posts.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0))
    arts = posts.filter(F.col("o_orderkey") % 10 != 0).select(
        "path", F.array("o_orderpriority").alias("tags"))
    h = latest(spark, sf, *cols)
    k = F.substring("path", 2, 20).cast("long")
    name = F.when(k % 3 == 0, F.concat(F.lit("auto_"), "path")).otherwise(F.col("path"))
    return au.enrich_history(h, deleted, arts, name)


@query("j15_enrich_history", W + ENRICH + "SELECT path, is_deleted, article_type, tool FROM en")
def j15_enrich(spark, sf):
    return _enriched(spark, sf).select("path", "is_deleted", "article_type", "tool")


@query("a32_segment_quantiles", W + ENRICH + """,
l AS (SELECT CASE WHEN is_deleted THEN 'deleted' ELSE article_type END AS segment,
  unnest(['factual', 'freshness', 'citation', 'risk']) AS axis,
  unnest([factual, freshness, citation, risk])::DOUBLE AS value FROM en)
SELECT segment, axis, count(*) AS n, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS p75, min(value) AS min, max(value) AS max FROM l GROUP BY ALL""")
def a32_segments(spark, sf):
    return au.segment_quantiles(_enriched(spark, sf, *au.AXES))


@query("a32_tool_medians", W + ENRICH + """
SELECT tool, count(*) AS n, quantile_cont(factual, 0.5) AS factual, quantile_cont(freshness, 0.5) AS freshness,
  quantile_cont(citation, 0.5) AS citation, quantile_cont(risk, 0.5) AS risk
FROM en GROUP BY tool HAVING count(*) >= 3""")
def a32_tools(spark, sf):
    return au.tool_medians(_enriched(spark, sf, *au.AXES))


@query("a12_status_rates", W + """
SELECT status, count(*) AS n, round(count(*) / (SELECT count(*) FROM history), 6) AS rate
FROM history GROUP BY status""")
def a12_status(spark, sf):
    return au.status_rates(history(spark, sf, "status")).withColumn("rate", r6("rate"))


@query("a13_error_patterns", f"""WITH {ARTICLES},
w AS (SELECT substr(regexp_split_to_array(trim(body), '[ \\t\\r\\n:|]')[1], 1, 60) AS pattern FROM articles)
SELECT pattern, count(*) AS n FROM w WHERE pattern <> '' GROUP BY pattern ORDER BY n DESC, pattern LIMIT 10""")
def a13_patterns(spark, sf):
    return au.error_patterns(articles(spark, sf), "body")


SOURCES = """,
src AS (SELECT doc, url, CASE WHEN page_id % 4 = 0 THEN 'ok' WHEN page_id % 4 = 1 THEN 'skipped'
    WHEN page_id % 4 = 2 THEN '404' ELSE 'unknown' END AS st, page_id FROM cited_urls)"""


def _records(spark, sf):
    """Nested records: each document carries its source rows and claims."""
    k = F.col("page_id") % 4
    s = F.struct("url", F.when(k == 0, "ok").when(k == 1, "skipped").when(k == 2, "404")
                 .alias("url_check_status"))
    claim = F.when(F.col("page_id") % 3 == 0, F.col("host"))
    return cited_urls(spark, sf).groupBy("doc").agg(
        F.collect_list(s).alias("sources"), F.collect_list(claim).alias("unsupported_claims"),
        F.when(F.col("doc") % 5 == 0, "failed").otherwise("ok").alias("status"))


@query("a14_source_status", f"WITH {CITED_URLS}" + SOURCES + """
SELECT st AS status, count(*) AS n, count(*) FILTER (contains(url, 'utm_')) AS redirects FROM src GROUP BY st""")
def a14_sources(spark, sf):
    return au.source_rollup(_records(spark, sf), "utm_")[0]


@query("a14_source_totals", f"WITH {CITED_URLS}" + SOURCES + """,
cl AS (SELECT doc, count(*) FILTER (page_id % 3 = 0) AS c FROM src WHERE doc % 5 <> 0 GROUP BY doc)
SELECT (SELECT count(*) FROM src) AS sources,
  (SELECT round(avg(CASE WHEN contains(url, 'utm_') THEN 1.0 ELSE 0.0 END), 6) FROM src) AS redirect_rate,
  quantile_cont(c, 0.5) AS claims_median, max(c) AS claims_max FROM cl""")
def a14_totals(spark, sf):
    return au.source_rollup(_records(spark, sf), "utm_")[1].withColumn(
        "redirect_rate", r6("redirect_rate"))


@query("a33_majority_vote", W + """,
m AS (SELECT path, count(*) AS votes, floor(quantile_cont(factual, 0.5))::INT AS factual,
  floor(quantile_cont(freshness, 0.5))::INT AS freshness, floor(quantile_cont(citation, 0.5))::INT AS citation,
  floor(quantile_cont(risk, 0.5))::INT AS risk FROM ok_history GROUP BY path HAVING count(*) >= 2),
t AS (SELECT h.path, h.eval_id AS template FROM ok_history h JOIN m USING (path)
  QUALIFY row_number() OVER (PARTITION BY h.path ORDER BY abs(h.factual - m.factual), h.seq) = 1)
SELECT m.*, factual >= 75 AND citation >= 15 AND risk <= 55 AS passed,
  CASE WHEN risk >= 85 THEN 'high' ELSE '' END AS critical_level,
  CASE WHEN risk >= 85 THEN 'critical' WHEN factual >= 75 AND citation >= 15 AND risk <= 55 THEN 'pass'
       ELSE 'reject' END AS status, template FROM m JOIN t USING (path)""")
def a33_votes(spark, sf):
    return au.majority_vote(ok_history(spark, sf, "path", "seq", *au.AXES))


@query("w07_degraded", W + """,
r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY checked_at DESC, seq) AS rn FROM ok_history),
p AS (SELECT c.path, c.eval_id, c.factual, c.risk,
   CASE WHEN p2.eval_id IS NOT NULL AND p1.factual = c.factual AND p1.risk = c.risk AND p1.judgement = c.judgement
        THEN p2.eval_id ELSE p1.eval_id END AS previous
   FROM r c LEFT JOIN r p1 ON p1.path = c.path AND p1.rn = 2 LEFT JOIN r p2 ON p2.path = c.path AND p2.rn = 3
   WHERE c.rn = 1)
SELECT p.path, p.eval_id, previous, coalesce(h.factual - p.factual >= 10 OR p.risk - h.risk >= 15, false) AS degraded
FROM p LEFT JOIN ok_history h ON h.eval_id = previous""")
def w07_degraded(spark, sf):
    return au.degraded(ok_history(spark, sf, "path", "checked_at", "seq", "factual", "risk", "judgement"))


@query("w10_retention", W + f""",
y AS (SELECT * FROM history WHERE checked_at >= TIMESTAMP '{AS_OF}' - INTERVAL 300 DAY AND checked_at <= TIMESTAMP '{AS_OF}')
SELECT model, eval_id FROM y
QUALIFY row_number() OVER (PARTITION BY model ORDER BY checked_at DESC, eval_id) <= 500""")
def w10_retention(spark, sf):
    young = F.col("checked_at") >= as_of() - F.make_dt_interval(days=F.lit(300))
    rows = history(spark, sf, "checked_at", "model").filter(F.col("checked_at") <= as_of())
    return au.retain(rows, ["model"], [F.desc("checked_at"), F.col("eval_id")], young).select(
        "model", "eval_id")


@query("f07_cooldown", W + f""",
g AS (SELECT path, max(checked_at) AS c, max(CASE WHEN status <> 'ok' THEN checked_at END) AS u
  FROM history WHERE checked_at <= TIMESTAMP '{AS_OF}' GROUP BY path),
s AS (SELECT CASE WHEN c > TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR THEN 'recently_checked'
  WHEN u > TIMESTAMP '{AS_OF}' - INTERVAL 2400 HOUR THEN 'recently_unavailable' ELSE 'due' END AS state FROM g)
SELECT state, count(*) AS paths FROM s GROUP BY state""")
def f07_cooldown(spark, sf):
    rows = history(spark, sf, "path", "checked_at", "status").filter(F.col("checked_at") <= as_of())
    return au.cooldown(rows, as_of(), unavailable_hours=2400).groupBy("state").agg(
        F.count(F.lit(1)).alias("paths"))


@query("j12_resume", W + """,
ok AS (SELECT DISTINCT path FROM ok_history WHERE factual >= 20),
posts AS (SELECT 'p' || o_orderkey AS path, o_orderkey FROM orders)
SELECT path, 'done' AS state FROM posts WHERE o_orderkey % 2 = 0 AND path IN (SELECT path FROM ok)
UNION ALL SELECT path, 'requeue' FROM posts WHERE o_orderkey % 2 = 0 AND path NOT IN (SELECT path FROM ok)
UNION ALL SELECT path, 'missing' FROM posts WHERE path NOT IN (SELECT path FROM ok)""")
def j12_resume(spark, sf):
    posts = _posts(spark, sf)
    ok = ok_history(spark, sf, "path", "factual").filter(F.col("factual") >= 20)
    rows = history_raw(spark, sf).count() + posts.count()
    return au.resume_states(posts.filter(F.col("o_orderkey") % 2 == 0), ok, posts, rows)


@query("j13_newest_report", W + """,
b AS (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY path
   ORDER BY CASE WHEN prompt_version = 'N' THEN 0 ELSE 1 END, checked_at DESC, seq) = 1)
SELECT 'p' || o_orderkey AS path, eval_id, prompt_version = 'N' AS is_new FROM orders LEFT JOIN b ON b.path = 'p' || o_orderkey""")
def j13_newest(spark, sf):
    return au.newest_report(_posts(spark, sf).select("path"),
                            history(spark, sf, "path", "checked_at", "seq", "prompt_version"),
                            F.col("prompt_version") == "N").select("path", "eval_id", "is_new")


@query("g07_gates", W + f"""
SELECT path, CASE WHEN risk >= 85 THEN 'high' WHEN model = 'F' AND factual < 55 THEN 'medium' ELSE '' END AS critical_level,
  CASE WHEN risk >= 85 OR (model = 'F' AND factual < 55) THEN 'critical'
       WHEN factual >= 75 AND citation >= 15 AND risk <= 55 THEN 'pass' ELSE 'needs_revision' END AS status,
  {AUDIT_OK} AS audit_pass FROM latest""")
def g07_gates(spark, sf):
    s = au.live_status(critical_topic=F.col("model") == "F", mode="existing")
    return latest(spark, sf, "model", *au.AXES).select("path", s["critical_level"].alias("critical_level"),
                                    s["status"].alias("status"),
                                    au.gate_passes(C.AUDIT_GATE).alias("audit_pass"))


@query("g16_stratified_sample", f"""WITH {ARTICLES},
p AS (SELECT article_id, tool, length(body) AS n FROM articles),
s AS (SELECT article_id FROM p ORDER BY n, article_id LIMIT 2),
l AS (SELECT article_id FROM p ORDER BY n DESC, article_id DESC LIMIT 2),
c AS (SELECT *, CASE WHEN article_id IN (SELECT * FROM s) THEN 0 WHEN article_id IN (SELECT * FROM l) THEN 1 ELSE 2 END AS cls,
   md5('42:' || article_id) AS h FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY cls, CASE WHEN cls < 2 THEN n END,
   CASE WHEN cls = 2 THEN h END, article_id) AS rn FROM c)
SELECT article_id, tool, n FROM r WHERE rn <= 2
ORDER BY cls, CASE WHEN cls < 2 THEN n END, CASE WHEN cls = 2 THEN h END, article_id LIMIT 30""")
def g16_sample(spark, sf):
    a = articles(spark, sf).select("article_id", "tool", F.length("body").cast("long").alias("n"))
    return au.stratified_sample(a, "article_id", "tool", "n")


@query("g17_pass_audit", W + f""",
g AS (SELECT path, max(checked_at) AS c, max(CASE WHEN judgement = 'pass' THEN checked_at END) AS p
  FROM history WHERE checked_at <= TIMESTAMP '{AS_OF}' GROUP BY path)
SELECT path FROM g WHERE p >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY AND c <= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR
ORDER BY md5('42:' || path) LIMIT 1""")
def g17_pass_audit(spark, sf):
    rows = history(spark, sf, "path", "checked_at", "judgement").filter(F.col("checked_at") <= as_of())
    return au.pass_audit_sample(rows, as_of()).select("path")


@query("g18_stop_rule", W + """,
o AS (SELECT year(checked_at) AS run, eval_id, status <> 'ok' AS bad,
   row_number() OVER (PARTITION BY year(checked_at) ORDER BY checked_at, eval_id) AS rn,
   sum(CASE WHEN status <> 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY year(checked_at) ORDER BY checked_at, eval_id
       ROWS UNBOUNDED PRECEDING) AS cu,
   count(*) OVER (PARTITION BY year(checked_at)) AS total FROM history),
n AS (SELECT *, greatest(1, ceil(total * 0.06))::BIGINT AS need FROM o),
s AS (SELECT run, eval_id AS stop_at, rn FROM n WHERE bad AND cu = need),
t AS (SELECT DISTINCT run, total, need FROM n)
SELECT t.run, t.total, t.need, s.stop_at IS NOT NULL AS stopped, s.stop_at, coalesce(s.rn, t.total) AS processed
FROM t LEFT JOIN s USING (run)""")
def g18_stop(spark, sf):
    h = history(spark, sf, "checked_at", "status").withColumn("run", F.year("checked_at").cast("long"))
    return au.stop_rule(h, "run", ["checked_at", "eval_id"], 0.06)
