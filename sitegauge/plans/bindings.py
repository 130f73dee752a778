"""Views over the driver's tables, as DataFrames and as SQL common table expressions.

``V*`` functions build the Spark view; the constants of the same name in
lower case hold the SQL used by the oracles. Both state the same mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.common import spread

AS_OF = "2025-06-01"
RUN_DATE = "2024-01-31"
SCORE_AXES = ("factual", "freshness", "citation", "risk")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; times in them are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(col):
    """Whitespace words of a text."""
    return F.split(F.trim(col), "[ \\t\\r\\n]+")


SQL_WORDS = "regexp_split_to_array(trim({c}), '[ \\t\\r\\n]+')"

# ---------------------------------------------------------------- V1 articles


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents"))
    return d.select(
        F.col("doc_id").alias("article_id"),
        F.col("text").alias("body"),
        F.col("source").alias("tool"),
        F.col("lang").alias("segment"),
        F.date_add(F.lit("2024-01-01").cast("date"),
                   (F.col("doc_id") % 400).cast("int")).alias("pub_date"),
    )


ARTICLES = """articles AS (
  SELECT doc_id AS article_id, text AS body, source AS tool, lang AS segment,
         CAST(DATE '2024-01-01' + CAST(doc_id % 400 AS INTEGER) AS DATE) AS pub_date
  FROM documents)"""


def first_line(col):
    """The first line of a text, whole."""
    return F.substring_index(col, "\n", 1)


def article_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knowledge fields from whole documents: first line, long words, last word, all lines."""
    a = articles(spark, sf_dir)
    body = F.coalesce("body", F.lit(""))
    w = F.filter(F.split(body, "[ \\t\\r\\n.,]+"), lambda x: x != "")
    lines = F.split(body, "\n")
    return a.select(
        "article_id", "segment", "body",
        F.concat(F.lit("a"), F.lpad(F.col("article_id").cast("string"), 9, "0")).alias("slug"),
        first_line(body).alias("title"),
        F.col("tool").alias("service"),
        F.lower(F.coalesce(F.get(w, F.size(w) - 1), F.lit(""))).alias("code"),
        F.filter(w, lambda x: F.length(x) >= 12).alias("components"),
        F.array(F.col("segment")).alias("tags"),
        F.array(F.substring_index(body, "\n", -1)).alias("related_services"),
        lines.alias("top_queries"),
    )


ARTICLE_FIELDS = f"""{ARTICLES},
aw AS (SELECT *, coalesce(body, '') AS b,
         list_filter(regexp_split_to_array(coalesce(body, ''), '[ \\t\\r\\n.,]+'), lambda x: x <> '') AS w
  FROM articles),
article_fields AS (
  SELECT article_id, segment, b, 'a' || lpad(CAST(article_id AS VARCHAR), 9, '0') AS slug,
         string_split(b, chr(10))[1] AS title, tool AS service, lower(coalesce(w[-1], '')) AS code,
         array_to_string(list_filter(w, lambda x: length(x) >= 12), ' ') AS components, segment AS tags,
         string_split(b, chr(10))[-1] AS related_services, replace(b, chr(10), ' ') AS top_queries
  FROM aw)"""

# ------------------------------------------------------------------- V2 facts

CHANNELS = ("Organic Search", "Direct", "Organic Social", "Referral", "Email")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analytics facts: one row per event with page, host, channel and country."""
    e = table(spark, sf_dir, "events")
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("nk"), F.col("n_name").alias("country"))
    k = F.get_json_object("props", "$.k").cast("long")
    channel = F.get(F.array(*[F.lit(c) for c in CHANNELS]), (F.col("event_id") % 5).cast("int"))
    f = e.select(
        "event_id", "ts", F.to_date("ts").alias("day"), "user_id", "event_type",
        F.col("event_type").alias("query"), k.alias("k"),
        F.concat(F.when(k % 10 == 0, F.lit("/tags/t")).otherwise(F.lit("/posts/p")),
                 k.cast("string"), F.lit("/")).alias("page"),
        F.concat(F.lit("site"), (F.col("user_id") % 3).cast("string"),
                 F.lit(".example")).alias("host"),
        channel.alias("channel"), "value", (F.col("value") / 10).alias("seconds"),
    )
    home = (F.col("user_id") + F.col("event_id") % 2) % 25  # users move between two countries
    return f.join(n, home == F.col("nk"), "left").drop("nk")


FACTS = """facts AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id, event_type, event_type AS query, k,
         CASE WHEN k % 10 = 0 THEN '/tags/t' ELSE '/posts/p' END || CAST(k AS VARCHAR) || '/' AS page,
         'site' || CAST(user_id % 3 AS VARCHAR) || '.example' AS host,
         CASE event_id % 5 WHEN 0 THEN 'Organic Search' WHEN 1 THEN 'Direct'
              WHEN 2 THEN 'Organic Social' WHEN 3 THEN 'Referral' ELSE 'Email' END AS channel,
         value, value / 10 AS seconds, n_name AS country
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events) e
  LEFT JOIN nation ON (user_id + event_id % 2) % 25 = n_nationkey)"""

# ----------------------------------------------------------------- V3 history


def history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score-history events before de-duplication by evaluation id."""
    li = table(spark, sf_dir, "lineitem")
    ok = F.col("l_linenumber") != 7
    return li.select(
        F.concat(F.lit("p"), F.col("l_orderkey").cast("string")).alias("path"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("eval_id"),
        F.when(F.col("l_orderkey") % 5 == 0, F.col("l_linestatus"))
        .otherwise(F.lit("h")).alias("article_hash"),
        F.when(ok, (F.col("l_quantity") * 2).cast("int")).alias("factual"),
        F.when(ok, F.round(F.col("l_discount") * 1000).cast("int")).alias("freshness"),
        F.when(ok, F.round(F.col("l_tax") * 1000).cast("int")).alias("citation"),
        F.when(ok, (F.col("l_suppkey") % 101).cast("int")).alias("risk"),
        F.col("l_shipdate").alias("checked_at"),
        F.when(F.col("l_returnflag") == "A", "pass").otherwise("needs_revision").alias("judgement"),
        F.when(ok, "ok").otherwise("fact_check_unavailable").alias("status"),
        F.col("l_linestatus").alias("model"),
        F.col("l_returnflag").alias("prompt_version"),
        F.col("l_linenumber").alias("seq"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("order_key"),
    )


HISTORY_RAW = """history_raw AS (
  SELECT 'p' || CAST(l_orderkey AS VARCHAR) AS path,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS eval_id,
         CASE WHEN l_orderkey % 5 = 0 THEN l_linestatus ELSE 'h' END AS article_hash,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity * 2 AS INTEGER) END AS factual,
         CASE WHEN l_linenumber <> 7 THEN CAST(round(l_discount * 1000) AS INTEGER) END AS freshness,
         CASE WHEN l_linenumber <> 7 THEN CAST(round(l_tax * 1000) AS INTEGER) END AS citation,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_suppkey % 101 AS INTEGER) END AS risk,
         l_shipdate AS checked_at,
         CASE WHEN l_returnflag = 'A' THEN 'pass' ELSE 'needs_revision' END AS judgement,
         CASE WHEN l_linenumber <> 7 THEN 'ok' ELSE 'fact_check_unavailable' END AS status,
         l_linestatus AS model, l_returnflag AS prompt_version, l_linenumber AS seq,
         l_partkey, l_suppkey, l_extendedprice
  FROM lineitem)"""

HISTORY = f"""{HISTORY_RAW},
history AS (
  SELECT * FROM history_raw
  QUALIFY row_number() OVER (PARTITION BY eval_id
          ORDER BY checked_at DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
ok_history AS (SELECT * FROM history WHERE status = 'ok'),
latest AS (
  SELECT * FROM ok_history
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY checked_at DESC, seq) = 1),
pure AS (
  SELECT path FROM ok_history GROUP BY path
  HAVING count(DISTINCT article_hash) = 1 AND count(*) >= 2)"""

# ----------------------------------------------------------------- V4 queries


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches with their metrics; the query is a whole text, its white space made single."""
    b = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("query_id"), "text")
    c = (table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
         .select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"),
                          F.col("turn").cast("string")).alias("query_id"), "text"))
    n = F.length("text")
    return b.unionByName(c).select(
        "query_id", F.array_join(words(F.col("text")), " ").alias("query"),
        (n % 200).cast("long").alias("impressions"),
        ((n % 10) / 100.0).alias("ctr"), (n % 40).cast("double").alias("position"))


SEARCH_QUERIES = f"""search_queries AS (
  SELECT query_id, array_to_string({SQL_WORDS.format(c='text')}, ' ') AS query,
         CAST(length(text) % 200 AS BIGINT) AS impressions,
         (length(text) % 10) / 100.0 AS ctr, CAST(length(text) % 40 AS DOUBLE) AS position
  FROM (SELECT 'b' || CAST(item_id AS VARCHAR) AS query_id, text FROM benchmark
        UNION ALL
        SELECT 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text
        FROM conversations WHERE role = 'user'))"""

# ------------------------------------------------------------------- V5 hosts


def cited_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cited URL per page row; documents are groups of ten pages."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.floor(F.col("page_id") / 10).cast("long").alias("doc"), "page_id", "url",
        F.lower(F.regexp_extract("url", "^https?://([^/?#]+)", 1)).alias("host"))


CITED_URLS = """cited_urls AS (
  SELECT CAST(page_id // 10 AS BIGINT) AS doc, page_id, url,
         lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host
  FROM pages)"""

# ---------------------------------------------------------------- V6 entities


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("service"),
                    F.col("p_type").alias("error_type"),
                    F.split("p_name", " ").alias("components"),
                    F.col("p_size").cast("string").alias("code"))


ENTITIES = """entities AS (
  SELECT p_partkey AS item, p_brand AS service, p_type AS error_type,
         string_split(p_name, ' ') AS components, CAST(p_size AS VARCHAR) AS code
  FROM part)"""

# ------------------------------------------------------------- V7 experiments


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before/after page metrics around one rewrite date."""
    f = facts(spark, sf_dir)
    split = F.lit("2024-01-15").cast("date")
    before, after = F.col("day") < split, F.col("day") >= split

    def half(cond, name):
        n = F.sum(F.when(cond, 1))
        c = F.sum(F.when(cond & (F.col("event_type") == "click"), 1).when(cond, 0))
        return [n.cast("long").alias(f"{name}_impressions"), c.cast("long").alias(f"{name}_clicks"),
                (c / n).alias(f"{name}_ctr"),
                (F.avg(F.when(cond, F.col("value"))) / 4).alias(f"{name}_position")]

    return (f.groupBy(F.col("page").alias("slug")).agg(*half(before, "before"), *half(after, "after"))
            .withColumn("rewrite_date", split))


EXPERIMENTS = f"""{FACTS},
experiments AS (
  SELECT page AS slug, DATE '2024-01-15' AS rewrite_date,
    CAST(sum(CASE WHEN day < DATE '2024-01-15' THEN 1 END) AS BIGINT) AS before_impressions,
    CAST(sum(CASE WHEN day < DATE '2024-01-15' THEN CASE WHEN event_type = 'click' THEN 1 ELSE 0 END END) AS BIGINT) AS before_clicks,
    sum(CASE WHEN day < DATE '2024-01-15' THEN CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END END)
      / sum(CASE WHEN day < DATE '2024-01-15' THEN 1 END) AS before_ctr,
    avg(CASE WHEN day < DATE '2024-01-15' THEN value END) / 4 AS before_position,
    CAST(sum(CASE WHEN day >= DATE '2024-01-15' THEN 1 END) AS BIGINT) AS after_impressions,
    CAST(sum(CASE WHEN day >= DATE '2024-01-15' THEN CASE WHEN event_type = 'click' THEN 1 ELSE 0 END END) AS BIGINT) AS after_clicks,
    sum(CASE WHEN day >= DATE '2024-01-15' THEN CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END END)
      / sum(CASE WHEN day >= DATE '2024-01-15' THEN 1 END) AS after_ctr,
    avg(CASE WHEN day >= DATE '2024-01-15' THEN value END) / 4 AS after_position
  FROM facts GROUP BY page)"""
