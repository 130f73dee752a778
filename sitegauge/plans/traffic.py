"""Web-analytics queries on the facts view (V2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import between_days, lag_ranges, r6
from ..operators import traffic as tr
from .bindings import FACTS, RUN_DATE, facts, table
from .registry import query

S, E, PS, PE = lag_ranges(RUN_DATE)
CUR = f"day BETWEEN DATE '{S}' AND DATE '{E}'"
PREV = f"day BETWEEN DATE '{PS}' AND DATE '{PE}'"
W = f"WITH {FACTS} "
NOISE = ("NATION_1", "NATION_3", "NATION_5")


@query("s05_report", W + f"""
SELECT country, channel, count(*) AS views, count(DISTINCT user_id) AS users,
       round(sum(value), 4) AS total_value
FROM facts WHERE {CUR} AND channel = 'Direct' AND country LIKE '%1%'
GROUP BY country, channel ORDER BY views DESC, country LIMIT 8""")
def report(spark, sf):
    return tr.report(
        facts(spark, sf), ["country", "channel"],
        {"views": F.count(F.lit(1)), "users": F.countDistinct("user_id"),
         "total_value": F.round(F.sum(tr.metric_value("value")), 4)},
        start=S, end=E, filters=[("channel", "EXACT", "Direct"), ("country", "CONTAINS", "1")],
        order_by=[F.desc("views"), "country"], limit=8)


@query("f01_host_filter", W + """
SELECT page, sum(CASE WHEN contains(host, 'site0') THEN 1 ELSE 0 END)::BIGINT AS main_views,
       count(*) AS all_views FROM facts GROUP BY page""")
def host_filter(spark, sf):
    f = facts(spark, sf)
    main = tr.report(tr.host_filter(f, "site0"), ["page"], {"main_views": F.count(F.lit(1))})
    everything = tr.report(f, ["page"], {"all_views": F.count(F.lit(1))})
    return everything.join(main, "page", "left").fillna(0, ["main_views"])


@query("f02_page_filter", W + """
SELECT page, count(*) AS views FROM facts WHERE page LIKE '%/posts/%'
GROUP BY page HAVING count(*) >= 95""")
def page_filter(spark, sf):
    views = tr.report(facts(spark, sf).filter(F.col("page").contains("/posts/")), ["page"],
                      {"views": F.count(F.lit(1))})
    return tr.page_filter(views, min_views=95)


@query("f03_drop_noise", W + """,
rows AS (SELECT country, channel, day, count(DISTINCT user_id) AS users, avg(seconds) AS seconds
         FROM facts GROUP BY country, channel, day),
tagged AS (SELECT *, country IN ('NATION_1', 'NATION_3', 'NATION_5') AND seconds < 5 AS noise FROM rows)
SELECT 'dropped' AS part, country, count(*) AS rows, sum(users)::BIGINT AS users
FROM tagged WHERE noise GROUP BY country
UNION ALL
SELECT 'kept', country, count(*), sum(users)::BIGINT FROM tagged WHERE NOT noise GROUP BY country""")
def drop_noise(spark, sf):
    rows = tr.report(facts(spark, sf), ["country", "channel", "day"],
                     {"users": F.countDistinct("user_id"), "seconds": F.avg("seconds")})
    kept, dropped = tr.drop_noise(rows, NOISE, 5.0)
    kept = kept.groupBy("country").agg(F.count(F.lit(1)).alias("rows"),
                                       F.sum("users").cast("long").alias("users"))
    return (dropped.select(F.lit("dropped").alias("part"), "*")
            .unionByName(kept.select(F.lit("kept").alias("part"), "*")))


@query("f09_lagged_ranges", W + f"""
SELECT CASE WHEN {CUR} THEN 'current' ELSE 'previous' END AS period,
       min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day, count(*) AS views
FROM facts WHERE day BETWEEN DATE '{PS}' AND DATE '{E}' GROUP BY 1""")
def lagged(spark, sf):
    t = tr.tag_period(facts(spark, sf), RUN_DATE)
    return t.groupBy("period").agg(
        F.min("day").cast("string").alias("first_day"),
        F.max("day").cast("string").alias("last_day"), F.count(F.lit(1)).alias("views"))


@query("f10_reference_only", W + """,
w AS (SELECT date_trunc('week', day)::DATE AS week, count(*) AS views FROM facts GROUP BY 1)
SELECT week::VARCHAR AS week, views,
       (week - 7)::DATE < DATE '2024-01-10' AS reference_only,
       CASE WHEN (week - 7)::DATE < DATE '2024-01-10' THEN NULL
            ELSE views - lag(views) OVER (ORDER BY week) END AS delta FROM w""")
def reference_only(spark, sf):
    w = facts(spark, sf).groupBy(F.trunc("day", "week").alias("week")).agg(
        F.count(F.lit(1)).alias("views"))
    prev = w.select(F.date_add("week", 7).alias("week"), F.col("views").alias("pv"))
    ref = tr.reference_only(F.date_sub("week", 7), ["2024-01-01", "2024-01-10", None])
    return (w.join(prev, "week", "left")
            .select(F.col("week").cast("string").alias("week"), "views",
                    ref.alias("reference_only"),
                    F.when(~ref, F.col("views") - F.col("pv")).alias("delta")))


VOTES = """,
votes AS (SELECT page AS title, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)::BIGINT AS yes,
   sum(CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END)::BIGINT AS no
   FROM facts WHERE event_type IN ('signup', 'error', 'purchase') GROUP BY page),
eng AS (SELECT page AS title, seconds AS engagement_sec FROM facts WHERE event_type = 'view'
        QUALIFY row_number() OVER (PARTITION BY page ORDER BY event_id DESC) = 1)"""


def _votes(f):
    v = f.filter(F.col("event_type").isin("signup", "error", "purchase"))
    status = (F.when(F.col("event_type") == "signup", "yes")
              .when(F.col("event_type") == "error", "no").otherwise("unknown"))
    return tr.vote_pivot(v, "page", status, F.lit(1))


def vote_scores(spark, sf, min_no=30):
    """Scored pages, shared with the queue queries."""
    f = facts(spark, sf)
    eng = f.filter(F.col("event_type") == "view").select(
        F.col("page").alias("title"), "seconds", F.col("event_id").alias("ord"))
    return tr.vote_priority(tr.votes_with_engagement(_votes(f), eng), min_no=min_no, min_ratio=0.7)


SCORED = VOTES + """,
joined AS (SELECT v.*, coalesce(e.engagement_sec, 0.0) AS engagement_sec,
           no::DOUBLE / (yes + no) AS no_ratio FROM votes v LEFT JOIN eng e USING (title)),
scored AS (SELECT *, CASE WHEN no < 30 AND no_ratio < 0.7 THEN 0.0
   ELSE no_ratio * (1 + greatest(0.0, 1 - engagement_sec / 30)) END AS priority_score FROM joined)"""


@query("a01_vote_pivot", W + VOTES + " SELECT * FROM votes")
def vote_pivot(spark, sf):
    return _votes(facts(spark, sf))


@query("j01_votes_engagement", W + VOTES + """
SELECT v.*, round(coalesce(e.engagement_sec, 0.0), 6) AS engagement_sec
FROM votes v LEFT JOIN eng e USING (title)""")
def votes_engagement(spark, sf):
    f = facts(spark, sf)
    eng = f.filter(F.col("event_type") == "view").select(
        F.col("page").alias("title"), "seconds", F.col("event_id").alias("ord"))
    return (tr.votes_with_engagement(_votes(f), eng)
            .withColumn("engagement_sec", r6("engagement_sec")))


@query("g01_feedback_priority", W + SCORED + """
SELECT title, yes, no, round(no_ratio, 6) AS no_ratio, round(engagement_sec, 6) AS engagement_sec,
       round(priority_score, 6) AS priority_score, priority_score >= 1 AS critical
FROM scored WHERE priority_score > 0""")
def feedback_priority(spark, sf):
    s = vote_scores(spark, sf)
    return s.select("title", "yes", "no", r6("no_ratio").alias("no_ratio"),
                    r6("engagement_sec").alias("engagement_sec"),
                    r6("priority_score").alias("priority_score"), "critical")


SUMMARY = """
SELECT count(DISTINCT user_id) AS active_users, count(DISTINCT (user_id, day)) AS sessions,
  count(DISTINCT CASE WHEN channel = 'Organic Search' THEN (user_id, day) END) AS organic_sessions,
  count(DISTINCT CASE WHEN channel = 'Direct' THEN (user_id, day) END) AS direct_sessions,
  round(count(DISTINCT CASE WHEN channel = 'Organic Search' THEN (user_id, day) END)::DOUBLE
    / count(DISTINCT (channel, user_id, day)), 6) AS organic_ratio,
  round(count(DISTINCT CASE WHEN country = 'NATION_2' THEN user_id END)::DOUBLE
    / count(DISTINCT (country, user_id)), 6) AS home_ratio,
  round(count(*)::DOUBLE / count(DISTINCT (user_id, day)), 6) AS pv_per_session,
  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS js_errors"""


@query("a02_traffic_summary", W + SUMMARY + f" FROM facts WHERE {CUR}")
def traffic_summary(spark, sf):
    f = facts(spark, sf).filter(between_days("day", S, E))
    t = tr.traffic_summary(f, home_country="NATION_2")
    return t.select(*[r6(c).alias(c) if c.endswith(("ratio", "session")) else c for c in t.columns])


@query("a03_host_shares", W + """,
h AS (SELECT host, count(*) AS pv, count(DISTINCT user_id) AS uu,
             count(DISTINCT (user_id, day)) AS sessions FROM facts GROUP BY host)
SELECT host, pv, uu, sessions, round(pv / sum(pv) OVER (), 6) AS pv_share,
  round(uu / sum(uu) OVER (), 6) AS uu_share,
  round(sum(CASE WHEN contains(host, 'site0') THEN pv ELSE 0 END) OVER () / sum(pv) OVER (), 6) AS primary_share
FROM h""")
def host_shares(spark, sf):
    t = tr.host_shares(facts(spark, sf), "site0")
    return t.select(*[r6(c).alias(c) if c.endswith("share") else c for c in t.columns])


@query("a04_country_table", W + """
SELECT country, count(DISTINCT (user_id, day)) AS sessions, count(DISTINCT user_id) AS users,
  round(avg(seconds), 6) AS avg_seconds,
  round(avg(CASE WHEN value < 10 THEN 1.0 ELSE 0.0 END), 6) AS bounce_rate,
  avg(seconds) < 5 OR avg(CASE WHEN value < 10 THEN 1.0 ELSE 0.0 END) > 0.19 AS flag
FROM facts GROUP BY country ORDER BY users DESC, country LIMIT 10""")
def country_table(spark, sf):
    t = tr.country_table(facts(spark, sf), min_seconds=5.0, max_bounce=0.19)
    return t.select("country", "sessions", "users", r6("avg_seconds").alias("avg_seconds"),
                    r6("bounce_rate").alias("bounce_rate"), "flag")


@query("a05_daily_totals", W + """
SELECT day::VARCHAR AS day, count(DISTINCT user_id) AS users, count(*) AS views
FROM facts GROUP BY day""")
def daily_totals(spark, sf):
    return tr.daily_totals(facts(spark, sf)).withColumn("day", F.col("day").cast("string"))


@query("a35_channel_engagement", W + """
SELECT channel, count(DISTINCT user_id) AS users, count(DISTINCT (user_id, day)) AS sessions,
  round(avg(seconds), 6) AS avg_seconds, channel = 'Direct' AND avg(seconds) < 10 AS suspected_bot
FROM facts GROUP BY channel""")
def channel_engagement(spark, sf):
    t = tr.channel_engagement(facts(spark, sf))
    return t.withColumn("avg_seconds", r6("avg_seconds"))


# ------------------------------------------------------------ period comparison

PERIOD = f""",
tagged AS (SELECT *, CASE WHEN {CUR} THEN 'current' ELSE 'previous' END AS period
           FROM facts WHERE day BETWEEN DATE '{PS}' AND DATE '{E}'),
per AS (SELECT host, period, count(*)::DOUBLE AS impressions,
   sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::DOUBLE AS clicks,
   sum(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) / count(*) AS ctr,
   avg(value) / 4 AS position,
   count(DISTINCT CASE WHEN channel = 'Organic Search' THEN (user_id, day) END)::DOUBLE AS organic_sessions,
   count(DISTINCT (user_id, day))::DOUBLE AS sessions,
   count(DISTINCT CASE WHEN country = 'NATION_2' THEN user_id END)::DOUBLE / count(DISTINCT (country, user_id)) AS home_ratio
   FROM tagged GROUP BY host, period),
long AS (SELECT host, period, unnest(['impressions', 'clicks', 'ctr', 'position', 'organic_sessions', 'sessions', 'home_ratio']) AS metric,
   unnest(['number', 'number', 'rate', 'position', 'number', 'number', 'ratio']) AS kind,
   unnest([impressions, clicks, ctr, position, organic_sessions, sessions, home_ratio]) AS value FROM per),
chg AS (SELECT host, metric, kind, max(CASE WHEN period = 'current' THEN value END) AS c,
   max(CASE WHEN period = 'previous' THEN value END) AS p FROM long GROUP BY 1, 2, 3),
changes AS (SELECT host, metric, kind, coalesce(c, 0) AS current, coalesce(p, 0) AS previous,
   c IS NOT NULL AS current_exists, p IS NOT NULL AS previous_exists,
   coalesce(c, 0) - coalesce(p, 0) AS delta,
   CASE WHEN kind <> 'number' OR coalesce(p, 0) = 0 THEN NULL
        ELSE (coalesce(c, 0) - p) / p END AS pct_change FROM chg),
wide AS (SELECT host,
   max(CASE WHEN metric = 'impressions' THEN pct_change END) AS imp_pct,
   max(CASE WHEN metric = 'clicks' THEN pct_change END) AS clk_pct,
   max(CASE WHEN metric = 'organic_sessions' THEN pct_change END) AS org_pct,
   max(CASE WHEN metric = 'sessions' THEN pct_change END) AS ses_pct,
   max(CASE WHEN metric = 'position' THEN delta END) AS pos_delta,
   max(CASE WHEN metric = 'ctr' THEN delta END) AS ctr_delta,
   max(CASE WHEN metric = 'home_ratio' THEN current END) AS home_ratio
   FROM changes GROUP BY host)"""


def _changes(spark, sf):
    t = tr.tag_period(facts(spark, sf), RUN_DATE)
    gsc = tr.page_metrics(t.withColumn("key", F.struct("host", "period")), "key")
    ga = tr.traffic_summary(t.withColumn("key", F.struct("host", "period")), "key",
                            home_country="NATION_2")
    wide = gsc.join(ga, "key").select("key.host", "key.period", "impressions", "clicks", "ctr",
                                      "position", "organic_sessions", "sessions", "home_ratio")
    long = tr.unpivot_metrics(wide, ["host", "period"], [
        "impressions", "clicks", "ctr", "position", "organic_sessions", "sessions", "home_ratio"])
    return tr.compare_periods(long, ["host"])


@query("w05_period_change", W + PERIOD + """
SELECT host, metric, kind, round(current, 6) AS current, round(previous, 6) AS previous,
  current_exists, previous_exists, round(delta, 6) AS delta, round(pct_change, 6) AS pct_change
FROM changes""")
def period_change(spark, sf):
    c = _changes(spark, sf)
    return c.select("host", "metric", "kind", r6("current").alias("current"),
                    r6("previous").alias("previous"), "current_exists", "previous_exists",
                    r6("delta").alias("delta"), r6("pct_change").alias("pct_change"))


@query("g12_weekly_alerts", W + PERIOD + """
SELECT host, concat_ws(',', CASE WHEN imp_pct <= -0.01 THEN 'impressions' END,
   CASE WHEN clk_pct <= -0.01 THEN 'clicks' END,
   CASE WHEN pos_delta >= 0.1 THEN 'position' END,
   CASE WHEN org_pct <= -0.01 THEN 'organic' END) AS alerts,
  CASE WHEN imp_pct <= -0.02 AND pos_delta >= 1 THEN 'impressions and position worse'
       WHEN imp_pct <= -0.02 AND ctr_delta > 0 THEN 'fewer impressions, better ctr'
       WHEN imp_pct >= 0.02 AND pos_delta <= -1 THEN 'impressions and position better'
       WHEN org_pct <= -0.25 THEN 'organic sessions down' ELSE 'no large change' END AS judgement
FROM wide""")
def weekly_alerts(spark, sf):
    w = tr.wide_changes(_changes(spark, sf), ["host"])
    return w.select("host", F.array_join(tr.weekly_alerts(-0.01, 0.1), ",").alias("alerts"),
                    tr.weekly_judgement(step=0.02).alias("judgement"))


@query("g13_monthly_alerts", W + PERIOD + """,
v AS (SELECT host, count(*) AS n FROM facts GROUP BY host),
sh AS (SELECT host, 1 - n / sum(n) OVER () AS foreign_share FROM v),
j AS (SELECT w.*, foreign_share FROM wide w JOIN sh USING (host)),
f AS (SELECT *, coalesce(imp_pct >= 0.2, false) AS iu, coalesce(imp_pct <= -0.2, false) AS id,
   coalesce(clk_pct >= 0.2, false) AS cu, coalesce(clk_pct <= -0.2, false) AS cd,
   coalesce(org_pct >= 0.2, false) AS ou, coalesce(org_pct <= -0.2, false) AS od,
   coalesce(pos_delta <= -3, false) AS pb, coalesce(pos_delta >= 3, false) AS pw FROM j)
SELECT host, concat_ws(',', CASE WHEN imp_pct <= -0.5 THEN 'impressions' END,
   CASE WHEN clk_pct <= -0.5 THEN 'clicks' END, CASE WHEN pos_delta >= 10 THEN 'position' END,
   CASE WHEN org_pct <= -0.5 THEN 'organic' END, CASE WHEN ses_pct <= -0.5 THEN 'sessions' END,
   CASE WHEN foreign_share >= 0.9 THEN 'foreign host share' END,
   CASE WHEN home_ratio < 0.3 THEN 'home country ratio' END) AS alerts,
  CASE WHEN id AND ctr_delta > 0 THEN 'less traffic, better ctr'
       WHEN (iu OR cu OR ou) AND pw THEN 'more traffic, worse position'
       WHEN cu AND od THEN 'more clicks, less organic'
       WHEN (iu OR cu OR pb OR ou) AND NOT (id OR cd OR pw OR od) THEN 'improving'
       WHEN (id OR cd OR pw OR od) AND NOT (iu OR cu OR pb OR ou) THEN 'worsening'
       WHEN (id OR cd OR pw OR od) THEN 'mixed' ELSE 'no large change' END AS judgement
FROM f""")
def monthly_alerts(spark, sf):
    w = tr.wide_changes(_changes(spark, sf), ["host"])
    shares = tr.host_shares(facts(spark, sf), "site0").select(
        "host", (1 - F.col("pv_share")).alias("foreign_share"))
    ref = F.lit(False)
    return w.join(shares, "host").select(
        "host", F.array_join(tr.monthly_alerts(ref, F.col("foreign_share"), F.col("home_ratio")),
                             ",").alias("alerts"),
        tr.monthly_judgement(ref).alias("judgement"))


@query("g15_status_signal", W + """
SELECT host, CASE WHEN avg(seconds) >= 5 THEN 'good' WHEN avg(seconds) <= 4.9 THEN 'bad' ELSE 'watch' END AS engagement,
  CASE WHEN avg(CASE WHEN value < 10 THEN 1.0 ELSE 0.0 END) <= 0.18 THEN 'good'
       WHEN avg(CASE WHEN value < 10 THEN 1.0 ELSE 0.0 END) >= 0.19 THEN 'bad' ELSE 'watch' END AS bounce
FROM facts GROUP BY host""")
def status_signal(spark, sf):
    t = facts(spark, sf).groupBy("host").agg(F.avg("seconds").alias("s"), tr.bounce().alias("b"))
    return t.select("host", tr.status_signal(F.col("s"), 5.0, 4.9).alias("engagement"),
                    tr.status_signal(F.col("b"), 0.18, 0.19, True).alias("bounce"))


DAILY = """,
daily AS (SELECT page, day, count(*) AS impressions, avg(value) / 4 AS position
          FROM facts GROUP BY page, day)"""


@query("w06_trend", W + DAILY + """,
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY day DESC) AS rn FROM daily),
a AS (SELECT page, count(*) AS periods, max(CASE WHEN rn = 1 THEN impressions END) AS li,
  max(CASE WHEN rn = 4 THEN impressions END) AS fi, max(CASE WHEN rn = 1 THEN position END) AS lp,
  max(CASE WHEN rn = 4 THEN position END) AS fp FROM r WHERE rn <= 8 GROUP BY page)
SELECT page, periods, CASE WHEN periods < 4 THEN 'insufficient'
  WHEN (li - fi) / fi::DOUBLE >= 0.1 AND lp - fp <= -1 THEN 'up'
  WHEN (li - fi) / fi::DOUBLE <= -0.1 AND lp - fp >= 1 THEN 'down' ELSE 'flat' END AS trend FROM a""")
def trend(spark, sf):
    daily = facts(spark, sf).groupBy("page", "day").agg(
        F.count(F.lit(1)).alias("impressions"), (F.avg("value") / 4).alias("position"))
    return tr.trend(daily, ["page"], "day")


@query("w11_period_history", W + """,
w AS (SELECT date_trunc('week', day)::DATE AS week, count(*) AS views FROM facts GROUP BY 1),
cur AS (SELECT week, views + 1000000 AS views, 'current' AS origin FROM w ORDER BY week DESC LIMIT 1),
pst AS (SELECT week, views, 'past' AS origin FROM w WHERE week NOT IN (SELECT week FROM cur))
SELECT week::VARCHAR AS week, views, origin FROM (SELECT * FROM cur UNION ALL SELECT * FROM pst)
ORDER BY week DESC LIMIT 4""")
def period_history(spark, sf):
    w = facts(spark, sf).groupBy(F.trunc("day", "week").alias("week")).agg(
        F.count(F.lit(1)).alias("views"))
    current = (w.orderBy(F.desc("week")).limit(1)
               .select("week", (F.col("views") + 1000000).alias("views"),
                       F.lit("current").alias("origin")))
    past = w.withColumn("origin", F.lit("past"))
    return (tr.keep_history(current, past, "week", 4)
            .withColumn("week", F.col("week").cast("string")))


@query("w12_backfill", W + """,
runs AS (SELECT DISTINCT (day + 10)::DATE AS run_date FROM facts)
SELECT run_date::VARCHAR AS run_date, count(*) AS impressions,
  sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS clicks,
  round(sum(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) / count(*), 6) AS ctr,
  round(avg(value) / 4, 6) AS position
FROM runs JOIN facts ON day BETWEEN run_date - 9 AND run_date - 3 GROUP BY run_date""")
def backfill(spark, sf):
    f = facts(spark, sf)
    runs = f.select(F.date_add("day", 10).alias("run_date")).distinct()
    b = tr.backfill_weekly(f, runs)
    return b.select(F.col("run_date").cast("string").alias("run_date"), "impressions", "clicks",
                    r6("ctr").alias("ctr"), r6("position").alias("position"))
