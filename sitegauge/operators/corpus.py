"""Corpus quality: lint rules, secrets, freshness, heuristic scores and term mining.

All rules are column expressions over (path/stem, fm map, body), so one scan
of the corpus evaluates every rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import constants as C
from ..functions import text as tx
from ..functions.common import any_of, as_col, contains_any, count_if, explode_once, guarded, once, ratio

def _empty() -> Column:
    return F.array().cast("array<string>")


def fm(key: str) -> Column:
    """Front-matter field, empty when absent."""
    return F.trim(F.coalesce(F.col("fm")[key], F.lit("")))


# ------------------------------------------------------- predicates and categories


def is_published() -> Column:
    return F.lower(fm("draft")) != "true"


def is_error_document() -> Column:
    """An error code is set, or the stem carries a three-digit code."""
    return (fm("errorCode") != "") | F.col("stem").rlike("_[0-9]{3}([^0-9]|$)")


def has_two_signals(text: Column, tech=C.TECH_KEYWORDS, signals=C.ERROR_SIGNALS) -> Column:
    t = F.lower(text)
    return contains_any(t, tech) & contains_any(t, signals)


def refresh_due(manifest: Column, published: Column, as_of: Column, days: int = 90,
                flag: Column | None = None) -> Column:
    """Due when the last rewrite (else publication) is old, unreadable or missing."""
    last = F.coalesce(manifest.try_cast("date"), published.try_cast("date"))
    due = last.isNull() | (F.datediff(as_of, last) >= days)
    return due if flag is None else (F.lower(F.coalesce(flag, F.lit(""))) == "true") | due


# --------------------------------------------------------------------- lint rules


def _issue(rule: str, severity: str, detail: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                    detail.alias("detail"))


def _one(cond: Column, rule: str, severity: str, detail) -> Column:
    d = detail if isinstance(detail, Column) else F.lit(detail)
    return F.array_compact(F.array(F.when(cond, _issue(rule, severity, d))))


def unnamed_code(body) -> Column:
    return guarded(as_col(body).contains("```"), F.size(F.filter(
        tx.fenced_languages(body), lambda g: g == "")), F.lit(0))


def rule_a4(body="body") -> Column:
    n = unnamed_code(body)
    return _one(n > 0, "A4", "WARN", F.concat(n.cast("string"), F.lit(" code blocks without language")))


def rule_a5(body="body") -> Column:
    b = as_col(body)
    return F.concat(
        _one(b.rlike("\\bYOUR_[A-Z_]+\\b"), "A5", "WARN", "upper-case placeholder"),
        _one(b.rlike("\\{\\{[^}]+\\}\\}"), "A5", "WARN", "double-brace placeholder"))


def rule_a6(error_doc: Column) -> Column:
    def missing(key):
        return (fm(key) == "") | fm(key).isin("[]", '""', "''")

    return F.concat(
        _one(error_doc & missing("errorCode"), "A6", "FAIL", "missing field: errorCode"),
        _one(missing("tags"), "A6", "FAIL", "missing field: tags"),
        _one(missing("title"), "A6", "FAIL", "missing field: title"),
        _one(fm("description").contains("。。"), "A6", "FAIL", "doubled full stop in description"))


def rule_a7(error_doc: Column, mark: str = C.FOOTER_MARK, body="body") -> Column:
    return _one(error_doc & ~as_col(body).contains(mark), "A7", "FAIL", "footer missing")


def has_lead_summary(heading: str = C.LEAD_HEADING, body="body") -> Column:
    """A conclusion field, or the lead heading outside code blocks."""
    outside = F.regexp_replace(as_col(body), "(?s)```.*?```", "x")
    return (fm("conclusion") != "") | outside.rlike(heading)


def rule_a8(error_doc: Column, heading: str = C.LEAD_HEADING, body="body") -> Column:
    return _one(error_doc & ~has_lead_summary(heading, body), "A8", "WARN", "lead summary missing")


def rule_b2(patterns=C.DISQUALIFIERS, body="body") -> Column:
    """One issue per disqualifying phrase, with a short excerpt."""
    b = as_col(body)
    return F.array_compact(F.array(*[
        F.when(b.rlike(p), _issue("B2", "FAIL", F.concat(
            F.lit(label + ": "), F.substring(F.regexp_extract(b, p, 0), 1, 60))))
        for label, p in patterns]))


def _code_or_all(body, scope: str) -> Column:
    if scope == "all":
        return as_col(body)
    return guarded(as_col(body).contains("```"), F.array_join(tx.fenced_code(body), "\n"), F.lit(""))


def _real_token(tok: Column, min_len: int, words) -> Column:
    parts = F.filter(F.split(tok, "[-_]"), lambda s: s != "")
    harmless = lambda s: (F.lower(s).rlike("^x{3,}$") | F.lower(s).isin(*words)
                          | (F.length(s) <= 3))
    return (F.length(tok) >= min_len) & ~F.forall(parts, harmless)


def rule_secret_tokens(scope: str = "code", body="body", rules=C.SECRET_PREFIXES,
                       words=C.PLACEHOLDER_WORDS) -> Column:
    """Token-like values after known prefixes; at most one hit per rule."""
    code = _code_or_all(body, scope)

    def hit(prefix, n):
        found = F.regexp_extract_all(code, F.lit(prefix + "(?=([A-Za-z0-9_\\-]*))"), F.lit(1))
        literal = prefix.split("(", 1)[0]
        return guarded(code.contains(literal),
                       F.exists(found, lambda t: _real_token(t, n, words)), F.lit(False))

    return F.array_compact(F.array(*[
        F.when(hit(p, n), _issue("C1", "FAIL", F.lit(f"token-like value: {name}")))
        for name, p, n in rules]))


def context_secret(body="body", scope: str = "code", keys=C.CONTEXT_KEYS) -> Column:
    """First key-like value (35-45 characters) assigned to a secret's name, or null."""
    code = _code_or_all(body, scope)
    pattern = ("(?i)(?:" + "|".join(keys) + ")\\s*(?:[=:]+|=>)\\s*[\"']?"
               "([A-Za-z0-9/+]{35,45})(?![A-Za-z0-9/+])")
    found = F.regexp_extract_all(code, F.lit(pattern), F.lit(1))

    def real(v):
        chars = F.array_distinct(F.filter(F.split(F.lower(v), ""),
                                          lambda c: ~c.isin("/", "+", "")))
        start = "^" + any_of(C.CONTEXT_PLACEHOLDERS)
        return ~F.lower(v).rlike(start) & (F.size(chars) > 2)

    return F.get(F.filter(found, real), F.lit(0))


def rule_context_secret(scope: str = "code", keys=C.CONTEXT_KEYS, body="body") -> Column:
    v = context_secret(body, scope, keys)
    return _one(v.isNotNull(), "C1", "FAIL",
                F.concat(F.lit("token-like value: "), F.substring(v, 1, 12), F.lit("...")))


def url_tiers(body="body", distinct: bool = False) -> Column:
    """Array of provenance tiers, one per URL occurrence."""
    urls = tx.all_urls(body)
    urls = F.array_distinct(urls) if distinct else urls
    some = as_col(body).contains("http") | as_col(body).contains("](")
    return guarded(some, F.transform(urls, lambda u: tx.domain_tier(tx.url_host(u))), _empty())


def rule_d2(body="body") -> Column:
    tiers = url_tiers(body)
    bad = F.size(F.filter(tiers, lambda t: t == "grounding_redirect"))
    return _one((F.size(tiers) > 0) & (bad / F.size(tiers) > 0.5), "D2", "WARN",
                "redirect URLs above half")


def code_masked(body="body") -> Column:
    """Body with fenced code replaced by x, same length and lines."""
    b = as_col(body)
    fence = "(?s)```.*?```"
    outside = F.split(b, fence, -1)
    codes = F.transform(F.regexp_extract_all(b, F.lit(fence), F.lit(0)),
                        lambda c: F.regexp_replace(c, "[^\\n]", "x"))
    return F.array_join(F.zip_with(outside, codes, lambda o, c: F.concat(
        o, F.coalesce(c, F.lit("")))), "")


def section(heading: str = C.NOTE_HEADING, body="body") -> Column:
    """Text below the first matching heading up to the next heading of its level; else null."""
    b, pat = as_col(body), "(?m)" + heading

    def cut(masked, at, found):
        level = F.length(F.regexp_extract(found, "^\\s*(#+)", 1))
        start = at + F.length(found)
        rest = F.concat(F.lit("x"), F.substr(masked, start))
        nxt = F.regexp_instr(rest, F.concat(F.lit("(?m)^#{1,"), level.cast("string"), F.lit("}\\s")))
        return once(nxt, lambda n: F.substr(b, start, F.greatest(
            F.when(n > 0, n - 2).otherwise(F.length(b)), F.lit(0))))

    def found_in(masked):
        first = F.struct(F.regexp_instr(masked, F.lit(pat)).alias("at"),
                         F.regexp_extract(masked, pat, 0).alias("found"))
        return once(first, lambda f: F.when(f["at"] > 0, cut(masked, f["at"], f["found"])))

    return F.when(b.rlike(pat), once(code_masked(body), found_in))


def rule_e1(body="body") -> Column:
    def urls(s):
        return F.when(s.isNotNull(), F.size(tx.all_urls(s))).otherwise(1)

    return _one(once(section(body=body), urls) == 0, "E1", "WARN", "note without URL")


def rule_e2(body="body") -> Column:
    found = once(section(body=body), lambda s: guarded(s.isNotNull(), tx.all_urls(s), _empty()))
    urls = F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, "[).,、。]+$", "")))
    bad = F.filter(urls, lambda u: tx.domain_tier(tx.url_host(u)) == "grounding_redirect")
    return F.transform(bad, lambda u: F.struct(
        F.lit("E2").alias("rule"), F.lit("FAIL").alias("severity"),
        F.concat(F.lit("redirect URL: "), F.substring(u, 1, 80)).alias("detail")))


def lint(corpus: DataFrame, *, footer: str = C.FOOTER_MARK, patterns=C.DISQUALIFIERS,
         secret_scope: str = "code", secret_keys=C.CONTEXT_KEYS) -> DataFrame:
    """Every rule in one pass: is_error and issues array<struct<rule, severity, detail>>."""
    err = is_error_document()
    return corpus.withColumn("is_error", err).withColumn("issues", F.concat(
        rule_a7(err, footer), rule_a8(err), rule_a4(), rule_a5(), rule_a6(err),
        rule_b2(patterns), rule_secret_tokens(secret_scope),
        rule_context_secret(secret_scope, secret_keys), rule_d2(), rule_e1(), rule_e2()))


def fail_rules(issues="issues") -> Column:
    return F.array_distinct(F.transform(
        F.filter(as_col(issues), lambda i: i["severity"] == "FAIL"), lambda i: i["rule"]))


def lint_class(is_error="is_error", issues="issues") -> Column:
    fails = fail_rules(issues)
    return (F.when(~as_col(is_error), "skipped").when(F.array_contains(fails, "B2"), "ineligible")
            .when(F.size(fails) > 0, "needs_rewrite").otherwise("clean"))


def lint_classes(linted: DataFrame) -> DataFrame:
    return linted.groupBy(lint_class().alias("class")).agg(F.count(F.lit(1)).alias("documents"))


def lint_rule_counts(linted: DataFrame) -> DataFrame:
    """Issues per rule and severity over error documents (issues, not documents)."""
    return (explode_once(linted.filter("is_error"), [], F.col("issues"), "i")
            .groupBy("i.rule", "i.severity").agg(F.count(F.lit(1)).alias("issues")))


def disposition(fails: Column, retries: Column, max_retries: int = 2) -> Column:
    """Publication decision from failed rules and the retries already made."""
    has = lambda r: F.array_contains(fails, r)
    blocking = has("A7") | has("B2") | has("C1") | has("E2")
    return (F.when(has("A6"), "requeue")
            .when(blocking & (retries >= max_retries), "requeue").when(blocking, "retry")
            .when((F.size(fails) == 1) & has("A3"),
                  F.when(retries >= 1, "pass_with_warning").otherwise("retry"))
            .otherwise("pass"))


# ----------------------------------------------------------------- metadata checks


def metadata_errors(list_field: str = "tags") -> Column:
    """Missing fields, wrong tag type, bad dates, control characters, broken encoding."""
    date_ok = ("^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}"
               "(Z|[+-][0-9]{2}:[0-9]{2}))?$")
    control = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]"
    raw = lambda k: F.col("fm")[k]
    checks = []
    for k in ("title", "date", "description", "tags"):
        checks += [F.when(raw(k).isNull(), f"missing: {k}"),
                   F.when(F.trim(raw(k)).isin("", "[]", '[""]'), f"empty: {k}")]
    checks.append(F.when(~F.trim(raw(list_field)).startswith("["), f"not a list: {list_field}"))
    for k in ("date", "lastmod"):
        checks.append(F.when(~raw(k).rlike(date_ok), f"bad date: {k}"))
    for k in ("title", "description", "error_cause", "error_remedy"):
        checks.append(F.when(raw(k).rlike(control), f"control character: {k}"))
    checks.append(F.when(F.regexp_count(raw("description"), F.lit("[\\uff61-\\uff9f]")) >= 2,
                         "broken encoding: description"))
    return F.array_compact(F.array(*checks))


# ------------------------------------------------------------------ cleaning rules


def between_fences(body, outside_fn) -> Column:
    """Apply a function to the text outside fenced code and put the code back."""
    b = as_col(body)
    fence = "(?s)```.*?```"
    outside = F.transform(F.split(b, fence, -1), outside_fn)
    codes = F.regexp_extract_all(b, F.lit(fence), F.lit(0))
    return F.array_join(F.zip_with(outside, codes, lambda o, c: F.concat(
        o, F.coalesce(c, F.lit("")))), "")


# fixed values: spellings of the two labels
_BEFORE = ("(?m)^(?:#{1,4}[ \\t]+|\\*\\*)?(?:Before|before|修正前|エラーが起きる[^ \\t\\n（(]*)"
           "(?:[ \\t]*[（(][^）)\\n]*[）)])?[ \\t]*[：:]?[ \\t]*\\*{0,2}[ \\t]*$")
_AFTER = ("(?m)^(?:#{1,4}[ \\t]+|\\*\\*)?(?:After|after|修正後[^ \\t\\n（(]*)"
          "(?:[ \\t]*[（(][^）)\\n]*[）)])?[ \\t]*[：:]?[ \\t]*\\*{0,2}[ \\t]*$")


def normalize_labels(body="body") -> Column:
    return between_fences(body, lambda o: F.regexp_replace(
        F.regexp_replace(o, _BEFORE, C.BEFORE_LABEL), _AFTER, C.AFTER_LABEL))


def strip_footer(body="body", start: str = "\\n*---\\n*\\*" + C.FOOTER_MARK) -> Column:
    """Cut the text at a trailing footer; the pattern runs to the end, so once is enough."""
    return F.rtrim(F.regexp_replace(as_col(body), f"(?s){start}.*$", ""), F.lit(" \t\r\n"))


def strip_intro(body="body") -> Column:
    """Remove boilerplate opening sentences; runs of them go in one match."""
    t = F.regexp_replace(
        as_col(body),
        "(?m)(^|[。！？]\\s*)(?:[^。\\n]{1,80}?\\s+\\d{3}\\s*エラーの原因と解決策を解説します。)+", "$1")
    return F.regexp_replace(t, "[ \\t]+\\n", "\n")


def strip_control(body="body") -> Column:
    return F.regexp_replace(as_col(body), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]", "")


def invalid_note_reason(body="body", min_chars: int = 50) -> Column:
    """Why the note section must go: no URL, redirect URL or too short; null if fine."""
    def reason(s):
        short = F.length(F.regexp_replace(s, "[ \\n]", "")) < min_chars
        return once(tx.all_urls(s), lambda urls: F.when(F.size(urls) == 0, "no url").when(F.exists(
            urls, lambda u: tx.domain_tier(tx.url_host(u)) == "grounding_redirect"), "redirect url")
            .when(short, "too short"))

    return once(section(body=body), lambda s: F.when(s.isNotNull(), reason(s)))


def strip_invalid_note(body="body") -> Column:
    pat = "(?is)\\n#{1,4}\\s*Editor['’]?s?\\s*Note.*?(?=\\n#{1,4}\\s|\\z)"
    b = as_col(body)
    return F.when(invalid_note_reason(body).isNotNull(),
                  F.rtrim(F.regexp_replace(b, pat, ""), F.lit(" \t\r\n"))).otherwise(b)


def overview(body="body", heading: str = "##\\s*エラーの概要") -> Column:
    """Plain text of the overview section, else of the first paragraph."""
    b = as_col(body)
    sec = F.regexp_extract(b, f"(?s){heading}\\s*\\n+(.+?)(?:\\n\\n|\\n##)", 1)
    paras = F.filter(F.split(b, "\\n\\n"),
                     lambda p: (F.trim(p, F.lit(" \t\r\n")) != "") & ~p.startswith("#"))
    first = F.trim(F.coalesce(F.get(paras, F.lit(0)), F.lit("")), F.lit(" \t\r\n"))
    raw = F.when(F.trim(sec) != "", F.trim(sec, F.lit(" \t\r\n"))).otherwise(first)
    return F.regexp_replace(F.get(F.split(raw, "\\n\\n"), F.lit(0)), "\\n", " ")


def description(body="body") -> Column:
    """Up to two sentences, at most 120 characters, cut at a full stop where possible."""
    t = tx.strip_markdown(overview(body))
    two = F.trim(F.array_join(F.slice(F.split(t, "(?<=[。！？])"), 1, 2), ""))
    cut = F.regexp_extract(two, "^.{60,120}[。！？]", 0)
    return F.when(F.length(two) <= 120, two).when(cut != "", cut).otherwise(F.substring(two, 1, 120))


def rewrite_links(body="body", base: str = "") -> Column:
    """Glossary links become text; post links get the site address."""
    b = F.regexp_replace(as_col(body), "\\[([^\\]]+)\\]\\(/glossary/[^)]+\\)", "$1")
    return F.regexp_replace(b, "\\[([^\\]]+)\\]\\((/posts/[^)]+)\\)", f"[$1]({base}$2)")


def drop_links(body="body") -> Column:
    b = F.regexp_replace(as_col(body), "\\[([^\\]]+)\\]\\(/glossary/[^)]+\\)", "$1")
    return F.regexp_replace(b, "\\[([^\\]]+)\\]\\(/posts/[^)]+\\)", "$1")


def undo_term_links(body="body") -> Column:
    return F.regexp_replace(as_col(body), "\\[([^\\]\\n]+)\\]\\(/glossary/[^)\\n]+/\\)", "$1")


def code_preview(body="body", lines: int = 3) -> Column:
    """First lines of the first fenced block."""
    parts = F.split(as_col(body), "```", -1)
    rows = F.split(F.get(parts, F.lit(1)), "\\n", -1)
    return F.when((F.size(parts) > 2) & (F.size(rows) > 1),
                  F.array_join(F.slice(rows, 2, lines), "\n")).otherwise("")


def malformed_term(body="body", min_chars: int = 200) -> Column:
    """Short term page, or a heading mixing an ASCII word with kana."""
    b = F.regexp_replace(as_col(body), "(?s)^---.*?---\\s*", "")
    mixed = "(?m)^##\\s+.*[a-zA-Z]{3,}.*[ぁ-んァ-ン]|^##\\s+.*[ぁ-んァ-ン].*[a-zA-Z]{3,}"
    return (F.length(F.trim(b, F.lit(" \t\r\n"))) < min_chars) | b.rlike(mixed)


def stem_parts(stem, names: dict[str, str] | None = None) -> Column:
    """Stem to struct(tool, code): tool_x, x_404 or a plain name."""
    s = as_col(stem)
    guide = F.regexp_extract(s, "^tool_(.+)$", 1)
    tool, code = (F.regexp_extract(s, "^(.+?)_([0-9]\\w*)$", g) for g in (1, 2))
    slug = F.when(guide != "", guide).otherwise(tool)
    shown = F.initcap(F.regexp_replace(slug, "_", " "))
    if names:
        known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        shown = F.coalesce(F.try_element_at(known, slug), shown)
    return F.struct(F.when(slug != "", shown).otherwise(F.initcap(s)).alias("tool"),
                    F.when(guide != "", "").otherwise(code).alias("code"))


# ------------------------------------------------------------------ scores and flags


def high_change(text: Column, terms=C.HIGH_CHANGE_TERMS) -> Column:
    return contains_any(F.lower(text), terms)


def dangerous(body="body") -> Column:
    return as_col(body).rlike("(?i)" + "|".join(C.DANGEROUS_PATTERNS))


def claim_count(body="body") -> Column:
    """Claim-like sentences: long enough, with claim words, endings or numbers; at least one."""
    sentences = F.split(tx.without_code(body), "[。\\n.!?]+")
    like = ("(?i:\\b(?:" + "|".join(C.CLAIM_WORDS) + ")\\b)|" + "|".join(C.CLAIM_ENDINGS)
            + "|\\b\\d{3}\\b|\\b20\\d{2}\\b|v\\d+(?:\\.\\d+)?")
    hits = F.filter(F.transform(sentences, lambda s: F.trim(s, F.lit(" \t\r\n"))),
                    lambda s: (F.length(s) >= 24) & s.rlike(like))
    return F.greatest(F.lit(1), F.size(hits))


def freshness(updated: Column, as_of: Column, high: Column, body="body") -> Column:
    age = F.greatest(F.lit(0), F.datediff(as_of, updated))
    base = (F.when(age <= 30, 95).when(age <= 90, 85).when(age <= 180, 72)
            .when(age <= 365, 60).otherwise(45))
    score = (base - F.when(high & (age > 180), 15).otherwise(0)
             - F.when(as_col(body).rlike("(?i)" + C.OUTDATED_WORDING), 8).otherwise(0))
    return (F.when(updated.isNull(), F.when(high, 45).otherwise(60))
            .otherwise(F.greatest(F.lit(0), F.least(F.lit(100), score))))


def heuristic_scores(citations: Column, claims: Column, fresh: Column, high: Column,
                     danger: Column, absolute: Column, min_citation: int = 15,
                     min_freshness: int = 50) -> dict[str, Column]:
    """Factual and risk scores by fixed penalties, clamped to 0..100."""
    coverage = F.least(F.lit(100), F.bround(citations / claims * 100)).cast("int")
    low, old = coverage < min_citation, fresh < min_freshness
    pen = lambda c, n: F.when(c, n).otherwise(0)
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(100), c))
    return {
        "factual": clamp(86 - pen(low, 16) - pen(old, 8) - pen(danger, 20) - pen(absolute, 5)),
        "freshness": clamp(fresh), "citation": coverage,
        "risk": clamp(18 + pen(low, 15) + pen(old, 10) + pen(high, 8) + pen(danger, 35)
                      + pen(absolute, 5))}


def absolute_wording(body="body") -> Column:
    return as_col(body).rlike("(?i)" + C.ABSOLUTE_WORDING)


def keyword_score(text: Column) -> Column:
    t = F.lower(text)
    hits = lambda ws: sum((t.contains(w).cast("int") for w in ws[1:]),
                          t.contains(ws[0]).cast("int"))
    return F.least(F.lit(100), F.when(t.rlike("\\b[45]\\d\\d\\b"), 30).otherwise(0)
                   + F.least(F.lit(40), hits(C.ERROR_SIGNALS) * 8)
                   + F.least(F.lit(30), hits(C.TECH_KEYWORDS) * 10))


def error_category(text: Column, categories=C.ERROR_CATEGORIES) -> Column:
    t, out = F.lower(text), None
    for name, words in categories:
        cond = contains_any(t, [w.lower() for w in words])
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise("")


def urgency(code: Column) -> Column:
    return F.when(code.startswith("5") | code.isin("429", "408"), "high").otherwise("medium")


def status_code(text: Column) -> Column:
    return F.regexp_extract(text, "\\b([1-5]\\d{2})\\b", 1)


def body_hash(body="body") -> Column:
    return F.substring(F.sha2(as_col(body), 256), 1, 12)


def excerpt(title: Column, fields: dict[str, Column], body="body", limit: int = 12000) -> Column:
    """Struct(text, truncated): headings, key paragraphs, shortened code and key sentences."""
    block = "(?s)```([^\\n`]*)\\n(.*?)```"
    b = as_col(body)
    outside = F.split(b, block, -1)
    codes = F.regexp_extract_all(b, F.lit(block), F.lit(0))

    def shorten(c):
        lang = F.lower(F.trim(F.regexp_extract(c, block, 1)))
        code = F.regexp_replace(F.regexp_extract(c, block, 2), "\\n$", "")
        rows = F.when(code == "", _empty()).otherwise(F.split(code, "\\n", -1))
        keep = F.when(lang.isin(*C.LONG_CODE_LANGUAGES), 10).otherwise(6)
        kept = F.concat(F.slice(rows, F.lit(1), keep), F.when(
            F.size(rows) > keep, F.array(F.lit("... truncated ..."))).otherwise(_empty()))
        return F.concat(F.lit("```"), lang, F.lit("\n"), F.array_join(kept, "\n"), F.lit("\n```"))

    short = F.array_join(F.zip_with(outside, F.transform(codes, shorten),
                                    lambda o, c: F.concat(o, F.coalesce(c, F.lit("")))), "")
    paras = F.split(short, "\\n{2,}")

    def pick(p):
        s = F.trim(p, F.lit(" \t\r\n"))
        whole = s.startswith("#") | s.rlike("(?i)" + C.HEADING_WORDS) | s.startswith("```")
        sent = F.transform(F.split(s, "(?<=[。.!?])\\s+|\\n"), lambda x: F.trim(x))
        key = F.slice(F.filter(sent, lambda x: (x != "") & x.rlike("(?i)" + C.IMPORTANT_SENTENCE)), 1, 4)
        return F.when(s == "", _empty()).when(whole, F.array(s)).otherwise(key)

    chosen = F.flatten(F.transform(paras, pick))
    chosen = F.when(F.size(chosen) > 0, chosen).otherwise(F.slice(paras, 1, 8))
    lines = [F.concat(F.lit("title: "), title)] + [
        F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{k}: "), v))
        for k, v in fields.items()]
    full = F.concat(F.lit("## Frontmatter\n"), F.concat_ws("\n", *lines),
                    F.lit("\n\n## Fact-check input excerpt\n"), F.array_join(chosen, "\n\n"))
    marker = "\n\n... fact check input truncated ...\n"
    over = F.length(full) > limit
    cut = F.concat(F.rtrim(F.substring(full, 1, max(0, limit - len(marker))), F.lit(" \t\r\n")),
                   F.lit(marker))
    return F.struct(F.when(over, cut).otherwise(full).alias("text"), over.alias("truncated"))


# --------------------------------------------------------------------- term mining


def mine_terms(corpus: DataFrame, known=(), stop=C.TERM_STOP_WORDS, top: int = 60,
               min_count: int = 2) -> DataFrame:
    """Frequent acronyms and katakana words; the top list is cut before the minimum count."""
    t = tx.without_code("body")
    found = F.concat(F.regexp_extract_all(t, F.lit("[ァ-ヶー]{3,}"), F.lit(0)),
                     F.regexp_extract_all(t, F.lit("\\b[A-Z]{2,6}\\b"), F.lit(0)))
    return (explode_once(corpus, [], found, "term")
            .filter(~F.col("term").isin(*stop, *known))
            .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "term").limit(top).filter(F.col("n") >= min_count))


def term_counts(corpus: DataFrame, terms) -> DataFrame:
    """Non-overlapping occurrences of each listed term, and documents holding it."""
    b = F.col("body")
    n = lambda t: F.floor((F.length(b) - F.length(F.replace(b, F.lit(t), F.lit(""))))
                          / len(t)).cast("long")
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), n(t).alias("n")) for t in terms])
    return (corpus.select(F.explode(pairs).alias("p")).select("p.*")
            .groupBy("term").agg(F.sum("n").cast("long").alias("occurrences"),
                                 count_if(F.col("n") > 0).alias("documents")))


def missing_terms(pages: DataFrame, existing: DataFrame,
                  heading: str = "関連する言葉") -> DataFrame:
    """Bold terms of the related section whose page does not exist, most frequent first."""
    sec = F.regexp_extract(F.regexp_replace("body", "(?s)^---.*?---\\s*", ""),
                           f"(?sm)^##\\s*{heading}\\s*\\n(.*?)(?=\\n##\\s|\\z)", 1)
    bold = F.regexp_extract_all(sec, F.lit("\\*\\*([^*\\n]+)\\*\\*"), F.lit(1))
    t = (explode_once(pages, [], bold, "term").select(F.trim("term").alias("term"))
         .filter(F.col("term") != "").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
         .withColumn("slug", tx.term_slug("term")))
    return t.join(existing.select("slug"), "slug", "left_anti").select("term", "slug", "n")


def tag_counts(corpus: DataFrame, skip=("tool-guide", "word"), top: int = 12) -> DataFrame:
    return (corpus.select(F.explode("tags").alias("tag")).filter(~F.col("tag").isin(*skip))
            .groupBy("tag").agg(F.count(F.lit(1)).alias("documents"))
            .orderBy(F.desc("documents"), "tag").limit(top))


def code_counts(corpus: DataFrame, codes) -> DataFrame:
    return (corpus.filter(F.col("code").isin(*codes)).groupBy("code")
            .agg(F.count(F.lit(1)).alias("documents")))


def published_stats(corpus: DataFrame, skip=("tool-guide",)) -> DataFrame:
    """Published documents and distinct tools (tags) they cover."""
    tool = F.explode_outer(F.filter("tags", lambda t: ~t.isin(*skip)))
    return (corpus.filter("published").select("article_id", tool.alias("tool"))
            .agg(F.countDistinct("article_id").alias("published"),
                 F.countDistinct("tool").alias("tools")))


def index_group(label: Column) -> Column:
    """Index section of a title: kana row, or A for Latin letters and digits."""
    first = F.substring(label, 1, 1)
    plain = F.translate(first, C.KATAKANA + C.VOICED_KATAKANA, C.HIRAGANA + C.VOICED_PLAIN)
    out = F.when(label.rlike("^[A-Za-z0-9]"), "A")
    for key, chars in C.KANA_ROWS:
        out = out.when(plain.isin(*chars), key)
    return out


def title_index(pages: DataFrame) -> DataFrame:
    """Titles by index section; rows stay rows, so a big section is never collected."""
    label = F.regexp_replace("title", "とは？わかりやすく解説$", "")
    return (pages.withColumn("label", label).withColumn("section", index_group(F.col("label")))
            .filter(F.col("section").isNotNull()).orderBy("section", "title"))


def verification_progress(corpus: DataFrame, start, end) -> DataFrame:
    """Verified share and daily averages over one period; one row."""
    days = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    inside = F.col("changed").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    s = corpus.agg(F.count(F.lit(1)).alias("published"), count_if(F.col("verified")).alias("verified"),
                   count_if(inside).alias("modified"))
    return s.select("*", (F.col("published") - F.col("verified")).alias("unverified"),
                    ratio("verified", "published").alias("verification_rate"),
                    (F.col("modified") / days).alias("daily_modified"))


def trailing_weeks(corpus: DataFrame, end, weeks: int = 4) -> DataFrame:
    """Changes per trailing 7-day window ending at ``end``; 0 is the newest."""
    back = F.datediff(F.lit(end).cast("date"), F.col("changed"))
    spine = corpus.sparkSession.range(weeks).select(F.col("id").alias("week"))
    n = (corpus.filter((back >= 0) & (back < 7 * weeks))
         .groupBy(F.floor(back / 7).cast("long").alias("week"))
         .agg(F.count(F.lit(1)).alias("modified")))
    return spine.join(n, "week", "left").select(
        "week", F.coalesce("modified", F.lit(0)).cast("long").alias("modified"))


def secret_log(corpus: DataFrame, key: str, pattern: str, replacement: str) -> DataFrame:
    """Per document and secret value: replacement, occurrences and the lines holding it."""
    hit = corpus.filter(F.col("body").rlike(pattern))
    lines = hit.select(key, F.posexplode(F.split("body", "\\n", -1)).alias("pos", "content"))
    vals = lines.filter(F.col("content").rlike(pattern)).select(
        key, (F.col("pos") + 1).alias("line"), F.explode(F.regexp_extract_all(
            "content", F.lit(pattern), F.lit(1))).alias("old_value"))
    per_line = vals.groupBy(key, "old_value", "line").agg(F.count(F.lit(1)).alias("n"))
    return per_line.groupBy(key, "old_value").agg(
        F.sum("n").cast("long").alias("occurrences"),
        F.sort_array(F.collect_list("line")).alias("lines")
    ).withColumn("new_value", F.lit(replacement))


def replace_secrets(body, pattern: str, replacement: str) -> Column:
    """Replace only the captured value: pattern must be (before)(value)(after)."""
    return F.regexp_replace(as_col(body), pattern, f"$1{replacement}$3")
