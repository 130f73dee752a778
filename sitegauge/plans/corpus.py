"""Corpus queries on the article view (V1), pages and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.common import contains_any, explode_once, r6
from ..operators import corpus as co
from ..sources.readers import read_pages
from .bindings import ARTICLES, AS_OF, SQL_WORDS, articles, first_line, table, words
from .registry import query

W = f"WITH {ARTICLES} "
B = "(^|[^\\p{L}\\p{N}_])"      # word edges in the oracle's regex dialect
E = "([^\\p{L}\\p{N}_]|$)"
FOOTER = "License"
PHRASES = (("license_line", "Released under the [A-Z]+ License"),
           ("rights", "(?:licensed|Licensed) under the [A-Za-z ]+"))
KEYS = ("token",)
AS = f"DATE '{AS_OF}'"


def lit_as_of():
    return F.lit(AS_OF).cast("date")


def lint_corpus(spark, sf):
    """Articles with front matter: some lack a code or title or are drafts."""
    a = articles(spark, sf)
    i = F.col("article_id")
    text = F.col("body")
    fm = F.create_map(
        F.lit("title"), F.when(i % 13 == 0, "").otherwise(first_line(text)),
        F.lit("tags"), F.concat(F.lit('["'), F.col("tool"), F.lit('"]')),
        F.lit("errorCode"), F.when(i % 3 == 0, "500").otherwise(""),
        F.lit("description"), F.when(i % 19 == 0, F.concat(text, F.lit("。。"))).otherwise(text),
        F.lit("date"), F.col("pub_date").cast("string"),
        F.lit("draft"), F.when(i % 10 == 0, "TRUE").otherwise("false"))
    return a.select("*", F.concat(F.lit("doc_"), i.cast("string")).alias("stem"), fm.alias("fm"))


LINT = f"""{ARTICLES},
lc AS (SELECT *, 'doc_' || article_id AS stem, article_id % 3 = 0 AS has_code,
  article_id % 3 = 0 OR regexp_matches('doc_' || article_id, '_[0-9]{{3}}([^0-9]|$)') AS is_error FROM articles),
issues AS (
  SELECT article_id, is_error, 'A7' AS rule, 'FAIL' AS severity FROM lc WHERE is_error AND NOT contains(body, 'License')
  UNION ALL SELECT article_id, is_error, 'A8', 'WARN' FROM lc WHERE is_error
  UNION ALL SELECT article_id, is_error, 'A6', 'FAIL' FROM lc WHERE is_error AND NOT has_code
  UNION ALL SELECT article_id, is_error, 'A6', 'FAIL' FROM lc WHERE article_id % 13 = 0 OR string_split(body, chr(10))[1] = ''
  UNION ALL SELECT article_id, is_error, 'A6', 'FAIL' FROM lc WHERE article_id % 19 = 0
  UNION ALL SELECT article_id, is_error, 'B2', 'FAIL' FROM lc WHERE regexp_matches(body, 'Released under the [A-Z]+ License')
  UNION ALL SELECT article_id, is_error, 'B2', 'FAIL' FROM lc WHERE regexp_matches(body, '(?:licensed|Licensed) under the [A-Za-z ]+')
  UNION ALL SELECT article_id, is_error, 'C1', 'FAIL' FROM lc
    WHERE regexp_matches(body, '(?i)token\\s*(?:[=:]+|=>)\\s*["'']?[A-Za-z0-9/+]{{35,45}}([^A-Za-z0-9/+]|$)'))"""


def _linted(spark, sf):
    return co.lint(lint_corpus(spark, sf), footer=FOOTER, patterns=PHRASES,
                   secret_scope="all", secret_keys=KEYS)


@query("t12_lint", f"WITH {LINT} SELECT article_id, rule, severity, count(*) AS n FROM issues GROUP BY ALL")
def t12_lint(spark, sf):
    i = explode_once(_linted(spark, sf), ["article_id"], F.col("issues"), "i")
    return i.groupBy("article_id", "i.rule", "i.severity").agg(F.count(F.lit(1)).alias("n"))


CLASSES = """,
f AS (SELECT article_id, list(DISTINCT rule) AS fails FROM issues WHERE severity = 'FAIL' GROUP BY article_id),
cl AS (SELECT l.*, coalesce(fails, []) AS fails, CASE WHEN NOT is_error THEN 'skipped'
  WHEN list_contains(fails, 'B2') THEN 'ineligible' WHEN len(fails) > 0 THEN 'needs_rewrite' ELSE 'clean' END AS class
  FROM lc l LEFT JOIN f USING (article_id))"""


@query("a08_lint_classes", f"WITH {LINT}" + CLASSES + """
SELECT class, count(*) AS documents FROM cl GROUP BY class""")
def a08_classes(spark, sf):
    return co.lint_classes(_linted(spark, sf))


@query("a08_lint_rules", f"""WITH {LINT}
SELECT rule, severity, count(*) AS issues FROM issues WHERE is_error GROUP BY ALL""")
def a08_rules(spark, sf):
    return co.lint_rule_counts(_linted(spark, sf))


@query("g19_disposition", f"WITH {LINT}" + CLASSES + """
SELECT article_id, CASE WHEN list_contains(fails, 'A6') THEN 'requeue'
  WHEN len(list_intersect(fails, ['A7', 'B2', 'C1', 'E2'])) > 0
    THEN CASE WHEN article_id % 4 >= 2 THEN 'requeue' ELSE 'retry' END
  ELSE 'pass' END AS disposition FROM cl""")
def g19_disposition(spark, sf):
    return _linted(spark, sf).select("article_id", co.disposition(
        co.fail_rules(), F.col("article_id") % 4).alias("disposition"))


@query("f06_published", W + """SELECT article_id, tool FROM articles WHERE article_id % 10 <> 0""")
def f06_published(spark, sf):
    return lint_corpus(spark, sf).filter(co.is_published()).select("article_id", "tool")


@query("f08_error_documents", f"WITH {LINT} SELECT article_id FROM lc WHERE is_error")
def f08_error(spark, sf):
    return lint_corpus(spark, sf).filter(co.is_error_document()).select("article_id")


TECH = ("docker|firebase|aws|github|kubernetes|k8s|terraform|hashicorp|gcp|google cloud|cloudflare|vercel|"
        "nextjs|openai|anthropic|llm|ci/cd|github actions|nginx|redis|postgresql|postgres")
SIGNALS = ("error|failed|failure|exception|bug|crash|broken|issue|fix|patch|vulnerability|cve|incident|outage|"
           "timeout|deadlock|memory leak|regression|hotfix|panic|oom|rate limit|429|500|503|エラー|失敗|不具合|バグ|障害|脆弱性")


@query("f05_two_signals", W + f"""
SELECT article_id FROM articles WHERE regexp_matches(lower(body), 'ea|{TECH}') AND regexp_matches(lower(body), 'heon|{SIGNALS}')""")
def f05_two_signals(spark, sf):
    from ..functions import constants as C
    return articles(spark, sf).filter(co.has_two_signals(
        F.col("body"), ("ea", *C.TECH_KEYWORDS), ("heon", *C.ERROR_SIGNALS))).select("article_id")


@query("f11_refresh_due", W + f""",
m AS (SELECT article_id, CASE WHEN article_id % 23 = 0 THEN NULL ELSE pub_date END AS pub_date,
  CASE WHEN article_id % 7 = 0 THEN NULL WHEN article_id % 3 = 0 THEN (pub_date + 60)::DATE END AS man FROM articles)
SELECT article_id, article_id % 11 = 0 OR coalesce(man, pub_date) IS NULL
  OR {AS} - coalesce(man, pub_date) >= 200 AS due FROM m""")
def f11_refresh(spark, sf):
    i, d = F.col("article_id"), F.col("pub_date")
    man = (F.when(i % 7 == 0, "not-a-date").when(i % 3 == 0, F.date_add(d, 60).cast("string")))
    pub = F.when(i % 23 == 0, "").otherwise(d.cast("string"))
    flag = F.when(i % 11 == 0, "true")
    return articles(spark, sf).select("article_id", co.refresh_due(
        man, pub, lit_as_of(), 200, flag).alias("due"))


VIS = """length(regexp_replace(regexp_replace(regexp_replace(body, '```[\\s\\S]*?```', '', 'g'),
  '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g'), '[#\\-*`>\\[\\]()! \\n]', '', 'g'))"""


@query("t01_thin_documents", W + f"SELECT article_id, {VIS} AS visible, {VIS} < 1200 AS thin FROM articles")
def t01_thin(spark, sf):
    n = tx.visible_length("body").cast("long")
    return articles(spark, sf).select("article_id", n.alias("visible"), (n < 1200).alias("thin"))


@query("t05_footer", f"WITH {LINT} SELECT article_id FROM issues WHERE rule = 'A7'")
def t05_footer(spark, sf):
    c = lint_corpus(spark, sf)
    return c.filter(F.size(co.rule_a7(co.is_error_document(), FOOTER)) > 0).select("article_id")


@query("t07_disqualifiers", W + """
SELECT article_id, 'license_line' AS label, substr(regexp_extract(body, 'Released under the [A-Z]+ License'), 1, 60) AS excerpt
FROM articles WHERE regexp_matches(body, 'Released under the [A-Z]+ License')
UNION ALL SELECT article_id, 'rights', substr(regexp_extract(body, '(?:licensed|Licensed) under the [A-Za-z ]+'), 1, 60)
FROM articles WHERE regexp_matches(body, '(?:licensed|Licensed) under the [A-Za-z ]+')""")
def t07_disqualifiers(spark, sf):
    i = explode_once(articles(spark, sf), ["article_id"], co.rule_b2(PHRASES), "i")
    d = F.split("i.detail", ": ", 2)
    return i.select("article_id", F.get(d, F.lit(0)).alias("label"), F.get(d, F.lit(1)).alias("excerpt"))


@query("t09_context_secrets", W + """,
s AS (SELECT article_id, regexp_extract(body, '(?i)token\\s*(?:[=:]+|=>)\\s*["'']?([A-Za-z0-9/+]{35,45})([^A-Za-z0-9/+]|$)', 1) AS value FROM articles)
SELECT article_id, value FROM s WHERE value <> ''""")
def t09_secrets(spark, sf):
    a = articles(spark, sf).select("article_id", co.context_secret("body", "all", KEYS).alias("value"))
    return a.filter(F.col("value").isNotNull())


@query("t13_metadata", W + """,
m AS (SELECT article_id, CASE WHEN article_id % 13 = 0 THEN 'empty: title' END AS a,
  CASE WHEN article_id % 6 = 0 THEN 'missing: description' END AS b,
  CASE WHEN article_id % 9 = 0 THEN 'not a list: tags' END AS c,
  CASE WHEN article_id % 8 = 0 THEN 'bad date: date' END AS d,
  CASE WHEN article_id % 14 = 1 AND article_id % 13 <> 0 THEN 'control character: title' END AS e FROM articles)
SELECT article_id, concat_ws('; ', a, b, c, d, e) AS errors FROM m""")
def t13_metadata(spark, sf):
    c, i = lint_corpus(spark, sf), F.col("article_id")
    fm = F.create_map(
        F.lit("title"), F.when(i % 13 == 0, "").when(i % 14 == 1, "bad\u0007title").otherwise("ok"),
        F.lit("description"), F.when(i % 6 != 0, "text"),
        F.lit("tags"), F.when(i % 9 == 0, "plain").otherwise(F.col("fm")["tags"]),
        F.lit("date"), F.when(i % 8 == 0, "2024/01/01").otherwise(F.col("fm")["date"]))
    return c.withColumn("fm", fm).select(
        "article_id", F.array_join(co.metadata_errors(), "; ").alias("errors"))


@query("t15_strip_boilerplate", W + """
SELECT article_id, length(rtrim(regexp_replace(body, '\\n*(?:Released|Licensed|This work is licensed) [\\s\\S]*$', ''), ' ' || chr(9) || chr(13) || chr(10))) AS kept
FROM articles""")
def t15_strip(spark, sf):
    t = co.strip_footer("body", "\\n*(?:Released|Licensed|This work is licensed) ")
    return articles(spark, sf).select(
        "article_id", F.length(co.strip_intro(co.strip_control(t))).cast("long").alias("kept"))


@query("t17_description", W + """,
p AS (SELECT article_id, replace(trim(body, ' ' || chr(9) || chr(13) || chr(10)), chr(10), ' ') AS raw FROM articles),
m AS (SELECT article_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw,
  '\\[([^\\]]+)\\]\\([^)]*\\)', '\\1', 'g'), '`([^`]+)`', '\\1', 'g'), '\\*\\*([^*]+)\\*\\*', '\\1', 'g'),
  '\\*([^*]+)\\*', '\\1', 'g'), '\\s+', ' ', 'g')) AS t FROM p)
SELECT article_id, substr(t, 1, 120) AS description FROM m""")
def t17_description(spark, sf):
    return articles(spark, sf).select("article_id", co.description("body").alias("description"))


CLAIMS = f"""claims AS (SELECT article_id, greatest(1, len(list_filter(
  list_transform(regexp_split_to_array(regexp_replace(body, '```[\\s\\S]*?```', '', 'g'), '[。\\n.!?]+'),
    lambda s: trim(s, ' ' || chr(9) || chr(13) || chr(10))),
  lambda s: length(s) >= 24 AND (regexp_matches(s, '(?i){B}(must|should|can|will|error|status|api|token|security){E}')
    OR regexp_matches(s, 'です|ます|必要|原因|解決|設定|認証|権限|エラー|できます|v[0-9]+(\\.[0-9]+)?')
    OR regexp_matches(s, '{B}([0-9]{{3}}|20[0-9]{{2}}){E}')))))::BIGINT AS claims FROM articles)"""


@query("t18_claim_count", W + f", {CLAIMS} SELECT * FROM claims")
def t18_claims(spark, sf):
    return articles(spark, sf).select("article_id", co.claim_count().cast("long").alias("claims"))


HIGH = ("api|cloud|aws|azure|gcp|firebase|openai|gemini|security|oauth|iam|kubernetes|docker|terraform|stripe|"
        "pricing|price|law|legal|incident|料金|価格|法律|法令|障害|セキュリティ|クラウド|認証")
CRIT = ("law|legal|finance|medical|investment|diagnosis|vulnerability|credential|secret|private key|access token|"
        "法律|金融|医療|投資|診断|脆弱性")
DANGER = "(?i)rm\\s+-rf\\s+/|chmod\\s+777|curl\\s+[^|]+[|]\\s*(?:sh|bash)|--no-check-certificate|verify\\s*=\\s*false"


@query("t21_flags", W + f"""
SELECT article_id, regexp_matches(lower(body), '{HIGH}') AS high_change,
  regexp_matches(lower(body), '{CRIT}') AS critical_topic, regexp_matches(body, '{DANGER}') AS dangerous FROM articles""")
def t21_flags(spark, sf):
    from ..functions import constants as C
    return articles(spark, sf).select(
        "article_id", co.high_change(F.col("body")).alias("high_change"),
        contains_any(F.lower("body"), C.CRITICAL_TERMS).alias("critical_topic"),
        co.dangerous().alias("dangerous"))


@query("t22_body_hash", W + "SELECT article_id, substr(sha256(body), 1, 12) AS hash FROM articles")
def t22_hash(spark, sf):
    return articles(spark, sf).select("article_id", co.body_hash().alias("hash"))


FRESH = f"""fresh AS (SELECT article_id, body, CASE WHEN article_id % 17 = 0 THEN NULL ELSE {AS} - pub_date END AS age,
  regexp_matches(lower(body), '{HIGH}') AS high,
  regexp_matches(body, '(?i)20(1[0-9]|2[0-4])|古い|廃止|deprecated|legacy') AS outdated FROM articles),
fr AS (SELECT *, CASE WHEN age IS NULL THEN CASE WHEN high THEN 45 ELSE 60 END ELSE greatest(0,
  CASE WHEN age <= 30 THEN 95 WHEN age <= 90 THEN 85 WHEN age <= 180 THEN 72 WHEN age <= 365 THEN 60 ELSE 45 END
  - CASE WHEN high AND age > 180 THEN 15 ELSE 0 END - CASE WHEN outdated THEN 8 ELSE 0 END) END AS freshness FROM fresh)"""


def _fresh(high):
    updated = F.when(F.col("article_id") % 17 != 0, F.col("pub_date"))
    return co.freshness(updated, lit_as_of(), high)


@query("g02_freshness", W + f", {FRESH} SELECT article_id, freshness FROM fr")
def g02_freshness(spark, sf):
    return articles(spark, sf).select("article_id", _fresh(co.high_change(F.col("body"))).alias("freshness"))


@query("g06_heuristic_scores", W + f""", {FRESH}, {CLAIMS},
s AS (SELECT f.article_id, freshness, high, regexp_matches(body, '{DANGER}') AS danger,
  regexp_matches(body, '(?i)必ず|絶対|100%|完全に|always|never') AS absolute,
  CASE WHEN round_even(100.0 * (article_id % 4) / claims, 0) > 100 THEN 100
       ELSE round_even(100.0 * (article_id % 4) / claims, 0)::INTEGER END AS citation
  FROM fr f JOIN claims USING (article_id))
SELECT article_id, citation::INTEGER AS citation, freshness,
  greatest(0, least(100, 86 - CASE WHEN citation < 15 THEN 16 ELSE 0 END - CASE WHEN freshness < 50 THEN 8 ELSE 0 END
    - CASE WHEN danger THEN 20 ELSE 0 END - CASE WHEN absolute THEN 5 ELSE 0 END)) AS factual,
  greatest(0, least(100, 18 + CASE WHEN citation < 15 THEN 15 ELSE 0 END + CASE WHEN freshness < 50 THEN 10 ELSE 0 END
    + CASE WHEN high THEN 8 ELSE 0 END + CASE WHEN danger THEN 35 ELSE 0 END + CASE WHEN absolute THEN 5 ELSE 0 END)) AS risk
FROM s""")
def g06_scores(spark, sf):
    # each test of the body runs once per article; the scores use its outcome several times
    a = (articles(spark, sf).withColumn("high", co.high_change(F.col("body")))
         .withColumn("fresh", _fresh(F.col("high"))).withColumn("claims", co.claim_count())
         .withColumn("danger", co.dangerous()).withColumn("absolute", co.absolute_wording()))
    s = co.heuristic_scores(F.col("article_id") % 4, F.col("claims"), F.col("fresh"),
                            F.col("high"), F.col("danger"), F.col("absolute"))
    return a.select("article_id", *[c.alias(n) for n, c in s.items()])


@query("g11_keyword_score", W + f"""
SELECT article_id, least(100, CASE WHEN regexp_matches(lower(body), '{B}[45][0-9][0-9]{E}') THEN 30 ELSE 0 END
 + least(40, 8 * len(list_filter(string_split('{SIGNALS}', '|'), lambda w: contains(lower(body), w))))
 + least(30, 10 * len(list_filter(string_split('{TECH}', '|'), lambda w: contains(lower(body), w)))))::INTEGER AS score
FROM articles""")
def g11_keyword_score(spark, sf):
    return articles(spark, sf).select("article_id", co.keyword_score(F.col("body")).alias("score"))


@query("t26_mask_error_text", W + f""",
m AS (SELECT article_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(lower(body), '[“”]', '"', 'g'), '[‘’]', '''', 'g'), 'https?://\\S+', ' <url> ', 'g'),
  '([0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}})', ' <ip> ', 'g'),
  '[a-f0-9]{{12,}}', ' <id> ', 'g'), '[a-z]:\\\\[^\\s]+', ' <path> ', 'g'),
  '/[^\\s]+(?:/[^\\s]+)+', ' <path> ', 'g')) AS t FROM articles)
SELECT article_id, trim(regexp_replace(regexp_replace(t, '[<>{{}}()\\[\\],:;]+', ' ', 'g'), '\\s+', ' ', 'g')) AS masked FROM m""")
def t26_mask(spark, sf):
    return articles(spark, sf).select("article_id", tx.mask_error_text("body").alias("masked"))


@query("t28_slugs", W + f""",
w AS (SELECT article_id, tool, segment, body, {SQL_WORDS.format(c='body')} AS w FROM articles),
s AS (SELECT *, string_split(body, chr(10))[1] AS name FROM w),
d AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower('kb-' || name), '[^a-z0-9]', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS d,
   regexp_replace(regexp_replace(regexp_replace(lower(w[-1]), '[^a-z0-9-]', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS t1 FROM s),
c AS (SELECT *, CASE WHEN length(d) > 50 THEN regexp_replace(substr(d, 1, 50), '-+$', '') ELSE d END AS c,
   CASE WHEN length(t1) > 20 THEN regexp_replace(substr(t1, 1, 20), '-+$', '') ELSE t1 END AS t2 FROM d)
SELECT article_id, regexp_replace(lower(tool || '_' || name), '[^a-z0-9_]', '_', 'g') || '.md' AS filename,
  c || repeat('-x', greatest(0, ceil((12 - length(c)) / 2)::INTEGER)) AS post_slug,
  CASE WHEN regexp_matches(w[-1], '^[0-9]+$') OR length(t1) < 2 OR t2 = tool OR t2 = segment
       THEN tool || ',' || segment || ',error' ELSE tool || ',' || segment || ',' || t2 || ',error' END AS topics
FROM c""")
def t28_slugs(spark, sf):
    name = first_line(F.col("body"))
    tags = F.array(F.col("tool"), F.col("segment"), F.element_at(words(F.col("body")), -1))
    return articles(spark, sf).select(
        "article_id",
        F.concat(tx.slug(F.concat("tool", F.lit("_"), name)), F.lit(".md")).alias("filename"),
        tx.post_slug(name, "kb-").alias("post_slug"),
        F.array_join(tx.topics(tags, F.lit("doc")), ",").alias("topics"))


@query("t31_error_category", W + """
SELECT article_id, CASE WHEN regexp_matches(lower(body), 'resource_exhausted|quota exceeded|rate limit|billing|429') THEN 'quota'
  WHEN regexp_matches(lower(body), 'not_found|heon') THEN 'model'
  WHEN regexp_matches(lower(body), 'timeout|tions') THEN 'timeout'
  WHEN regexp_matches(lower(body), 'invalid_argument|eau') THEN 'api' ELSE '' END AS category FROM articles""")
def t31_category(spark, sf):
    cats = (("quota", ("RESOURCE_EXHAUSTED", "quota exceeded", "rate limit", "billing", "429")),
            ("model", ("NOT_FOUND", "heon")), ("timeout", ("Timeout", "tions")),
            ("api", ("INVALID_ARGUMENT", "eau")))
    return articles(spark, sf).select("article_id", co.error_category(
        F.col("body"), cats).alias("category"))


@query("t33_urgency", W + f""",
c AS (SELECT article_id, regexp_extract(body, '{B}([1-5][0-9]{{2}}){E}', 2) AS code FROM articles)
SELECT article_id, code, CASE WHEN code LIKE '5%' OR code IN ('429', '408') THEN 'high' ELSE 'medium' END AS urgency
FROM c WHERE code <> ''""")
def t33_urgency(spark, sf):
    c = articles(spark, sf).select("article_id", co.status_code(F.col("body")).alias("code"))
    return c.filter(F.col("code") != "").withColumn("urgency", co.urgency(F.col("code")))


@query("t35_secret_log", W + """,
l AS (SELECT article_id, unnest(string_split(body, chr(10))) AS content, generate_subscripts(string_split(body, chr(10)), 1) AS line
      FROM articles),
v AS (SELECT article_id, line, unnest(regexp_extract_all(content, 'token = "([0-9a-f]{40})"', 1)) AS old_value FROM l)
SELECT article_id, old_value, '<your-token>' AS new_value, count(*) AS occurrences,
  string_agg(DISTINCT line::VARCHAR, ',' ORDER BY line::VARCHAR) AS lines FROM v GROUP BY article_id, old_value""")
def t35_log(spark, sf):
    log = co.secret_log(articles(spark, sf), "article_id", 'token = "([0-9a-f]{40})"', "<your-token>")
    return log.withColumn("lines", F.array_join(
        F.array_sort(F.transform("lines", lambda x: x.cast("string"))), ","))


@query("a15_mine_terms", W + """,
t AS (SELECT unnest(string_split_regex(regexp_replace(body, '```[\\s\\S]*?```', '', 'g'), '[^\\p{L}\\p{N}_]+')) AS term FROM articles),
c AS (SELECT term, count(*) AS n FROM t WHERE regexp_matches(term, '^[A-Z]{2,6}$') AND term NOT IN
  ('URL','ID','OK','NG','UI','OS','PC','IT','IP','HTTP','NULL','EOF','AND','NOT','FOR','THE','GET','SET','PUT','POST','AWS','GCP','API')
  GROUP BY term ORDER BY n DESC, term LIMIT 60)
SELECT * FROM c WHERE n >= 2""")
def a15_terms(spark, sf):
    return co.mine_terms(articles(spark, sf))


@query("a16_term_counts", W + """,
t AS (SELECT unnest(['the', 'onth', 'tion', 'License', 'eau']) AS term),
c AS (SELECT term, ((length(body) - length(replace(body, term, ''))) // length(term))::BIGINT AS n FROM articles CROSS JOIN t)
SELECT term, sum(n)::BIGINT AS occurrences, count(*) FILTER (n > 0) AS documents FROM c GROUP BY term""")
def a16_counts(spark, sf):
    return co.term_counts(articles(spark, sf), ("the", "onth", "tion", "License", "eau"))


@query("a18_tag_counts", W + """,
t AS (SELECT unnest([tool, segment]) AS tag FROM articles)
SELECT tag, count(*) AS documents FROM t WHERE tag NOT IN ('src3', 'en') GROUP BY tag
ORDER BY documents DESC, tag LIMIT 12""")
def a18_tags(spark, sf):
    return co.tag_counts(articles(spark, sf).withColumn("tags", F.array("tool", "segment")),
                         ("src3", "en"))


@query("a18_published", W + """
SELECT count(*) AS published, count(DISTINCT tool) AS tools FROM articles WHERE article_id % 10 <> 0""")
def a18_published(spark, sf):
    c = lint_corpus(spark, sf).withColumn("published", co.is_published())
    return co.published_stats(c.withColumn("tags", F.array("tool")))


@query("a18_code_counts", W + f""",
c AS (SELECT regexp_extract(body, '{B}([1-5][0-9]{{2}}){E}', 2) AS code FROM articles)
SELECT code, count(*) AS documents FROM c WHERE code IN ('400', '401', '403', '404', '408', '409', '422', '429', '500', '502', '503', '504', '111', '152', '227')
GROUP BY code""")
def a18_codes(spark, sf):
    codes = ("400", "401", "403", "404", "408", "409", "422", "429", "500", "502", "503", "504",
             "111", "152", "227")
    return co.code_counts(articles(spark, sf).withColumn("code", co.status_code(F.col("body"))), codes)


def _verified(spark, sf):
    lab = table(spark, sf, "labels").filter(F.col("quality") == 1).select(
        F.col("doc_id").alias("article_id"), F.lit(True).alias("v"))
    return (articles(spark, sf).join(lab, "article_id", "left")
            .select("article_id", F.coalesce("v", F.lit(False)).alias("verified"),
                    F.col("pub_date").alias("changed")))


@query("a20_verification_progress", W + """,
v AS (SELECT a.*, coalesce(quality = 1, false) AS verified FROM articles a LEFT JOIN labels ON doc_id = article_id)
SELECT count(*) AS published, count(*) FILTER (verified) AS verified,
  count(*) FILTER (pub_date BETWEEN DATE '2024-06-01' AND DATE '2024-06-30') AS modified,
  count(*) FILTER (NOT verified) AS unverified, round(count(*) FILTER (verified) / count(*), 6) AS verification_rate,
  round(count(*) FILTER (pub_date BETWEEN DATE '2024-06-01' AND DATE '2024-06-30') / 30, 6) AS daily_modified FROM v""")
def a20_progress(spark, sf):
    p = co.verification_progress(_verified(spark, sf), "2024-06-01", "2024-06-30")
    return (p.withColumn("verification_rate", r6("verification_rate"))
            .withColumn("daily_modified", r6("daily_modified")))


@query("a20_trailing_weeks", W + """
SELECT week, (SELECT count(*) FROM articles WHERE pub_date BETWEEN DATE '2024-06-30' - (7 * week + 6)::INTEGER
   AND DATE '2024-06-30' - (7 * week)::INTEGER) AS modified FROM range(4) r(week)""")
def a20_weeks(spark, sf):
    return co.trailing_weeks(_verified(spark, sf), "2024-06-30")


@query("a25_title_index", W + f""",
t AS (SELECT article_id, string_split(body, chr(10))[1] AS title FROM articles)
SELECT article_id, title, 'A' AS section FROM t WHERE regexp_matches(title, '^[A-Za-z0-9]')""")
def a25_index(spark, sf):
    t = articles(spark, sf).select(
        "article_id", F.get(F.split("body", "\n"), F.lit(0)).alias("title"))
    return co.title_index(t).select("article_id", "title", "section")


@query("t20_excerpt")
def t20_excerpt(spark, sf):
    e = co.excerpt(first_line(F.col("body")), {"service": F.col("tool")})
    return articles(spark, sf).select("article_id", e.alias("e")).select(
        "article_id", "e.text", "e.truncated")


# ------------------------------------------------------------------------- pages


@query("t27_html_outline", """
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  trim(regexp_replace(regexp_extract(html, '<h1>([\\s\\S]*?)</h1>', 1), '<[^>]+>', '', 'g')) AS h1,
  len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages""")
def t27_outline(spark, sf):
    p = table(spark, sf, "pages")
    return p.select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        tx.strip_tags(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)).alias("h1"),
        F.size(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0))).cast("long").alias("paragraphs"))


@query("s06_page_text", """WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g') AS h FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h,
  '(?is)<script[\\s>].*?</script>', ' ', 'g'), '(?is)<style[\\s>].*?</style>', ' ', 'g'), '(?is)<nav[\\s>].*?</nav>', ' ', 'g'),
  '(?is)<footer[\\s>].*?</footer>', ' ', 'g'), '(?is)<header[\\s>].*?</header>', ' ', 'g'), '(?is)<title[\\s>].*?</title>', ' ', 'g') AS h FROM a)
SELECT page_id, url, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title,
  trim(regexp_replace(regexp_replace(h, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM b JOIN pages USING (page_id)""")
def s06_page_text(spark, sf):
    """Titles and whole visible texts."""
    return read_pages(table(spark, sf, "pages"))


@query("a34_outlines", """
WITH t AS (SELECT page_id, trim(substr(regexp_extract(html, '<title>([^<]*)</title>', 1), 1, 120)) AS title,
  list_slice(list_filter(list_transform(regexp_extract_all(html, '<p>([^<]+)', 1), lambda x: trim(substr(trim(x), 1, 100))), lambda x: x <> ''), 1, 10) AS heads FROM pages)
SELECT page_id, title, len(heads) AS n, array_to_string(heads, '|') AS heads FROM t""")
def a34_outlines(spark, sf):
    from ..sources.readers import outline
    o = outline(table(spark, sf, "pages"), second="p", third="h3")
    return o.select("page_id", "title", F.size("h2").cast("long").alias("n"),
                    F.array_join("h2", "|").alias("heads"))
