"""Feed, ledger, streaming and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r6
from ..operators import corpus as co
from ..operators import linking as li
from ..operators import traffic as tr
from ..session import new_folder
from ..sources import sinks
from ..streaming import feeds as fd
from .bindings import ARTICLES, FACTS, SQL_WORDS, articles, facts, first_line, table, words
from .registry import query

NOW = "2024-01-30 12:00:00"

KINDS = {"error": "GitHub", "purchase": "Stripe", "click": "Docker", "signup": "AWS", "view": "Azure"}
SUFFIX = {"error": " Status", "purchase": " Status", "click": " Blog", "signup": " News",
          "view": " Changelog"}


def shape_entries(e):
    """Feed entries from events: one feed per event type and user group."""
    k = F.get_json_object("props", "$.k").cast("long")
    pick = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[F.col("event_type")]
    feed = F.concat(pick(KINDS), (F.col("user_id") % 7).cast("string"), pick(SUFFIX))
    return e.select(
        fd.entry_id(F.col("event_type"), k.cast("string")).alias("id"), "event_id", "ts", k.alias("k"),
        feed.alias("feed_name"),
        F.when(F.col("event_type").isin("error", "purchase"), "status").otherwise("blog").alias("category"),
        F.when(k % 10 == 3, F.concat(F.lit("The Major Outage On Region North"), k.cast("string")))
        .otherwise(F.concat(F.lit("Release Notes volume "), k.cast("string"))).alias("title"),
        F.lit("").alias("summary"), F.concat(F.lit("https://e.org/"), k.cast("string")).alias("link"))


def entries(spark, sf):
    return shape_entries(table(spark, sf, "events"))


ENTRIES = """entries AS (
  SELECT md5(event_type || ':' || k) AS id, event_id, ts, k,
   CASE event_type WHEN 'error' THEN 'GitHub' WHEN 'purchase' THEN 'Stripe' WHEN 'click' THEN 'Docker' WHEN 'signup' THEN 'AWS' ELSE 'Azure' END
     || user_id % 7 AS service, event_type IN ('error', 'purchase') AS status,
   CASE WHEN k % 10 = 3 THEN 'The Major Outage On Region North' || k ELSE 'Release Notes volume ' || k END AS title
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events) e),
inc AS (SELECT service, ts AS detected_at, title, k, CASE WHEN k % 10 = 3 THEN 'Major,Outage,Region' ELSE 'Release,Notes' END AS keywords, id
  FROM entries WHERE status OR k % 10 = 3)"""


@query("r01_unseen_entries", f"""WITH {ENTRIES},
seen AS (SELECT DISTINCT id FROM entries WHERE ts < TIMESTAMP '2024-01-02')
SELECT id, event_id FROM entries WHERE ts >= TIMESTAMP '2024-01-02' AND id NOT IN (SELECT id FROM seen)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts, event_id) = 1""")
def r01_unseen(spark, sf):
    e, cut = entries(spark, sf), F.lit("2024-01-02").cast("timestamp_ntz")
    seen = e.filter(F.col("ts") < cut).select("id").distinct()
    return fd.unseen(e.filter(F.col("ts") >= cut), seen, ["ts", "event_id"]).select("id", "event_id")


def _stream(spark, sf):
    """The events table as a stream (event time as a zoned timestamp, UTC)."""
    path = f"{sf}/events.parque[t]"  # a pattern also fits a single file
    s = fd.read_stream(spark, path, table(spark, sf, "events").schema)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


@query("r01_stream_dedupe", f"WITH {ENTRIES} SELECT DISTINCT id FROM entries")
def r01_stream(spark, sf):
    """Seen-entry removal as a stream with time-bounded state."""
    out = new_folder(spark, "r01")
    fd.run_append(fd.dedupe_stream(shape_entries(_stream(spark, sf)), "60 days").select("id"), out)
    return spark.read.schema("id string").parquet(f"{out}/log")


@query("r02_detect_incidents", f"""WITH {ENTRIES}
SELECT service, keywords, strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at, title FROM inc
WHERE detected_at >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR
QUALIFY row_number() OVER (PARTITION BY service ORDER BY detected_at, id) = 1""")
def r02_incidents(spark, sf):
    since = F.lit(NOW).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(24))
    i = fd.detect_incidents(entries(spark, sf), since)
    return i.select("service", F.array_join("keywords", ",").alias("keywords"),
                    F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at"), "title")


ACTIVE = f"""active AS (SELECT service, title, detected_at, keywords FROM inc WHERE detected_at <= TIMESTAMP '{NOW}'
  QUALIFY row_number() OVER (PARTITION BY service ORDER BY detected_at DESC, title DESC) = 1
    AND detected_at > TIMESTAMP '{NOW}' - INTERVAL 12 HOUR)"""


def _flags(e):
    return e.filter(fd.is_incident()).select(
        fd.feed_service(F.col("feed_name")).alias("service"), F.col("ts").alias("detected_at"),
        "title", fd.title_keywords().alias("keywords"))


def _active(spark, sf):
    now = F.lit(NOW).cast("timestamp_ntz")
    e = entries(spark, sf).filter(F.col("ts") <= now)
    return fd.active_incidents(_flags(e), now, 12)


@query("r03_active_incidents", f"""WITH {ENTRIES}, {ACTIVE}
SELECT service, title, strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at FROM active""")
def r03_active(spark, sf):
    return _active(spark, sf).select(
        "service", "title", F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at"))


@query("r03_stream_ledger", f"""WITH {ENTRIES},
m AS (SELECT max(detected_at) - INTERVAL 1 HOUR AS seen FROM inc),
n AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY service ORDER BY detected_at DESC, title DESC) = 1)
SELECT service, title FROM n, m WHERE detected_at + INTERVAL 12 HOUR > seen""")
def r03_stream(spark, sf):
    """Incidents still open at the stream's event time, from the log of raised and ended ones."""
    out = new_folder(spark, "r03")
    fd.run_incidents(_flags(shape_entries(_stream(spark, sf))), out, 12)
    changes = spark.read.schema(fd.CHANGES).parquet(f"{out}/log")
    return fd.open_incidents(changes).select("service", "title")


@query("r04_flag_changes", f"""WITH {ENTRIES}, {ACTIVE}, {ARTICLES},
a AS (SELECT article_id, lower(CASE WHEN article_id % 2 = 0 THEN 'GitHub' ELSE 'Docker' END || article_id % 9) AS service,
  article_id % 5 = 0 AS flagged, {SQL_WORDS.format(c='lower(body)')} AS comp FROM articles),
h AS (SELECT *, service IN (SELECT lower(service) FROM active) OR list_has_any(comp, (SELECT list(lower(w)) FROM (SELECT unnest(string_split(keywords, ',')) AS w FROM active))) AS hit FROM a)
SELECT article_id, CASE WHEN hit THEN 'apply' ELSE 'clear' END AS change FROM h WHERE hit <> flagged""")
def r04_flags(spark, sf):
    a = _flagged_articles(spark, sf)
    m = li.match_incidents(a, _active(spark, sf), "article_id")
    return fd.flag_changes(a, m, "article_id").select("article_id", "change")


def _flagged_articles(spark, sf):
    i = F.col("article_id")
    return articles(spark, sf).select(
        "article_id", F.concat(F.when(i % 2 == 0, "GitHub").otherwise("Docker"), (i % 9).cast("string"))
        .alias("service"), (i % 5 == 0).alias("flagged"), words(F.col("body")).alias("components"))


@query("r04_stream_flags", f"""WITH {ENTRIES}, {ARTICLES},
n AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY service ORDER BY detected_at DESC, title DESC) = 1),
active AS (SELECT * FROM n WHERE detected_at > (SELECT max(detected_at) FROM inc) - INTERVAL 12 HOUR),
a AS (SELECT article_id, lower(CASE WHEN article_id % 2 = 0 THEN 'GitHub' ELSE 'Docker' END || article_id % 9) AS service,
  {SQL_WORDS.format(c='lower(body)')} AS comp FROM articles)
SELECT article_id, service IN (SELECT lower(service) FROM active)
  OR list_has_any(comp, (SELECT list(lower(w)) FROM (SELECT unnest(string_split(keywords, ',')) AS w FROM active))) AS flagged FROM a""")
def r04_stream(spark, sf):
    """Flags of all articles after the stream has applied and cleared them."""
    out = new_folder(spark, "r04")
    a = _flagged_articles(spark, sf)
    fd.run_flags(_flags(shape_entries(_stream(spark, sf))), a, "article_id", out, li.match_incidents, 12)
    changes = fd.read_epochs(spark, f"{out}/changes", "article_id long, change string")
    return fd.flag_state(a, changes, "article_id").select("article_id", "flagged")


@query("r05_score_log", f"""WITH {ENTRIES}
SELECT CASE WHEN k % 10 = 3 THEN 8 ELSE 0 END + CASE WHEN regexp_matches(title, '[^0-9][45][0-9][0-9]$') THEN 30 ELSE 0 END AS score,
  '2' AS prompt_version, count(*) AS rows FROM entries GROUP BY 1""")
def r05_log(spark, sf):
    """Append-only score log written by a stream with its checkpoint."""
    out = new_folder(spark, "r05")
    e = shape_entries(_stream(spark, sf))
    fd.run_append(e.select("id", co.keyword_score(F.col("title")).alias("score"),
                           F.lit("2").alias("prompt_version")), out)
    log = spark.read.schema("id string, score int, prompt_version string").parquet(f"{out}/log")
    return log.groupBy("score", "prompt_version").agg(F.count(F.lit(1)).alias("rows"))


@query("r06_notify_once", """
WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages)
SELECT url, min(page_id) AS page_id FROM p
WHERE url NOT IN (SELECT url FROM p WHERE page_id % 3 = 0) GROUP BY url""")
def r06_notify(spark, sf):
    p = table(spark, sf, "pages").select(
        "page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"))
    return fd.to_notify(p, p.filter(F.col("page_id") % 3 == 0), ["page_id"])


@query("r06_stream_notify", """
SELECT regexp_replace(url, '[?#].*$', '') AS url, min(page_id) AS page_id FROM pages GROUP BY 1""")
def r06_stream(spark, sf):
    """The log of URLs that a stream of published pages has notified."""
    out = new_folder(spark, "r06")
    pages = fd.read_stream(spark, f"{sf}/pages.parque[t]", table(spark, sf, "pages").schema)
    fd.run_notify(pages.select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url")), out, ["page_id"])
    return fd.read_epochs(spark, f"{out}/notified", "page_id long, url string").select("url", "page_id")


@query("r07_settled_windows", """
WITH m AS (SELECT max(ts) AS t FROM events),
w AS (SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS s, count(*) AS views,
  sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS clicks FROM events GROUP BY 1)
SELECT strftime(s, '%Y-%m-%d') AS start_day, views, clicks FROM w, m WHERE s + INTERVAL 7 DAY <= t - INTERVAL 3 DAY""")
def r07_windows(spark, sf):
    """Weekly windows that a stream emits after the settle delay."""
    out = new_folder(spark, "r07")
    fd.run_append(fd.settled_windows(_stream(spark, sf)), out)
    w = spark.read.schema("start timestamp, end timestamp, views long, clicks long").parquet(f"{out}/log")
    return w.select(F.date_format("start", "yyyy-MM-dd").alias("start_day"), "views", "clicks")


@query("r08_sync_due", f"""WITH {ARTICLES}
SELECT article_id, article_id % 11 = 0 OR article_id % 4 = 0 OR article_id % 7 = 0 OR pub_date > DATE '2024-09-01' AS due FROM articles""")
def r08_sync(spark, sf):
    i = F.col("article_id")
    a = articles(spark, sf)
    src = a.select("article_id", F.col("pub_date").cast("timestamp_ntz").alias("updated"),
                   (i % 11 != 0).alias("exists"))
    led = a.filter(i % 4 != 0).select(
        "article_id", F.when(i % 7 == 0, "unknown").otherwise("2024-09-01T00:00:00").alias("synced"))
    return fd.sync_due(src, led, "article_id").select("article_id", "due")


# -------------------------------------------------------------------------- sinks


@query("s07_report_sink", f"""WITH {FACTS}
SELECT day::VARCHAR AS day, count(DISTINCT user_id) AS users, count(*) AS views, '2024-01-31' AS run_date FROM facts GROUP BY day""")
def s07_report(spark, sf):
    """Daily report written as JSON by run date and read back."""
    out = new_folder(spark, "s07")
    d = tr.daily_totals(facts(spark, sf)).withColumn("day", F.col("day").cast("string"))
    sinks.write_report(d, out, "2024-01-31")
    return sinks.read_report(spark, out, "day string, users long, views long, run_date string")


@query("s07_run_log", f"""WITH {FACTS}
SELECT channel, k, count(*) AS views, CASE WHEN k % 2 = 0 THEN 'even' ELSE 'odd' END AS run FROM facts GROUP BY channel, k""")
def s07_log(spark, sf):
    """A log of two runs, one of which is retried after its commit."""
    out = new_folder(spark, "s07log")
    views = facts(spark, sf).groupBy("channel", "k").agg(F.count(F.lit(1)).alias("views"))
    for run, rest in (("even", 0), ("odd", 1), ("even", 0)):
        sinks.append_log(views.filter(F.col("k") % 2 == rest), out, run)
    return sinks.read_log(spark, out, "channel string, k long, views long")


@query("s07_markdown", f"""WITH {FACTS},
c AS (SELECT channel, count(*) AS views, round(avg(seconds), 2) AS s FROM facts GROUP BY channel)
SELECT 0 AS ord, '| channel | views |' AS line UNION ALL SELECT 1, '| :--- | :--- |'
UNION ALL SELECT 2, '| ' || channel || ' | ' || views || ' |' FROM c""")
def s07_markdown(spark, sf):
    t = tr.report(facts(spark, sf), ["channel"], {"views": F.count(F.lit(1))})
    return sinks.markdown_rows(t)


@query("s08_page_index", f"""WITH {ARTICLES}
SELECT string_split(body, chr(10))[1] AS title, substr(body, 1, 200) AS content,
  '/posts/' || article_id || '/' AS permalink, '' AS "errorCode", tool AS tag FROM articles WHERE article_id % 12 <> 0""")
def s08_pages(spark, sf):
    a = articles(spark, sf)
    out = new_folder(spark, "s08")
    index = sinks.page_index(a.select(
        first_line(F.col("body")).alias("title"), F.col("body").alias("content"),
        F.concat(F.lit("/posts/"), F.col("article_id").cast("string"), F.lit("/")).alias("permalink"),
        F.lit(None).cast("string").alias("errorCode"), F.array("tool").alias("tags"),
        (F.col("article_id") % 12 == 0).alias("hidden")))
    sinks.write_index(index, out)
    return sinks.read_index(spark, out, index.schema)
