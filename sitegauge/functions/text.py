"""Text column expressions: tokens, queries, URLs, Markdown and masking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import constants as C
from .common import any_of, as_col
from .pyudf import nfkc, spaced


# ------------------------------------------------------------------- tokenizing


def tokens(col, stop=C.STOP_WORDS) -> Column:
    """Distinct lower-case tokens; script changes and punctuation separate them."""
    t = F.regexp_replace(as_col(col), "([a-zA-Z0-9])([^\\x00-\\x7F])", "$1 $2")
    return _tokens(F.regexp_replace(t, "([^\\x00-\\x7F])([a-zA-Z0-9])", "$1 $2"), stop)


def text_tokens(col, stop=C.STOP_WORDS) -> Column:
    """``tokens`` of long texts: script changes are found in Arrow batches, at a tenth of the patterns' time.

    Not for use inside of array functions.
    """
    return _tokens(spaced(as_col(col)), stop)


def _tokens(t: Column, stop) -> Column:
    parts = F.split(F.lower(t), "[ \\t\\r\\n\\-_./,()\\[\\]\"':]+")
    stops = F.array(*[F.lit(s) for s in stop])
    return F.array_except(F.filter(parts, lambda p: F.length(p) >= 2), stops)


def normalize_query(col) -> Column:
    """Search query with quotes, edge punctuation and repeated space removed."""
    punct = C.QUERY_PUNCTUATION
    q = F.lower(F.trim(nfkc(F.coalesce(as_col(col), F.lit("")))))
    q = F.regexp_replace(q, "^[\"'`“”‘’]+|[\"'`“”‘’]+$", "")
    q = F.regexp_replace(q, f"^[\\s{punct}]+|[\\s{punct}]+$", "")
    q = F.regexp_replace(q, f"[{punct}]+", " ")
    return F.trim(F.regexp_replace(q, "\\s+", " "))


def is_bad_query(col) -> Column:
    """True for pasted error dumps, code, bare numbers and very short or vague queries."""
    n = normalize_query(col)
    word = lambda p: f"(^|[^\\p{{L}}\\p{{N}}_])({p})([^\\p{{L}}\\p{{N}}_]|$)"
    short_ok = n.rlike("[0-9]{3}\\s*(エラー|error|エラ|とは)") | n.isin(*C.SHORT_QUERIES)
    return ((n == "") | n.rlike(word("|".join(C.ERROR_DUMP_PHRASES)))
            | ((F.length(n) < 10) & ~short_ok)
            | n.rlike(word("|".join(C.CODE_WORDS)))
            | (n.rlike("[;=<>{}()]") & n.rlike(word("[a-z_][a-z0-9_]*")))
            | n.rlike("^[^\\p{L}]+$") | n.isin(*C.VAGUE_QUERIES))


# --------------------------------------------------------------- Markdown and URLs


def fenced_code(col) -> Column:
    """Array of fenced code bodies."""
    return F.regexp_extract_all(as_col(col), F.lit("(?s)```[^\\n]*\\n(.*?)```"), F.lit(1))


def fenced_languages(col) -> Column:
    return F.transform(
        F.regexp_extract_all(as_col(col), F.lit("(?s)```([^\\n]*)\\n.*?```"), F.lit(1)), F.trim)


def without_code(col) -> Column:
    return F.regexp_replace(as_col(col), "(?s)```.*?```", "")


def visible_length(col) -> Column:
    """Visible characters: no fenced code, link targets, Markdown marks, spaces or newlines."""
    t = F.regexp_replace(without_code(col), "\\[([^\\]]+)\\]\\([^)]+\\)", "$1")
    return F.length(F.regexp_replace(t, "[#\\-*`>\\[\\]()! \\n]", ""))


def all_urls(col) -> Column:
    """Link targets followed by bare URLs; a linked URL appears in both lists."""
    c = as_col(col)
    return F.concat(F.regexp_extract_all(c, F.lit("\\]\\((\\S+?)\\)"), F.lit(1)),
                    F.regexp_extract_all(c, F.lit("https?://\\S+"), F.lit(0)))


def distinct_urls(col) -> Column:
    """Distinct cited URLs in order of appearance, links first."""
    c = as_col(col)
    links = F.regexp_extract_all(c, F.lit("\\[[^\\]]+\\]\\((https?://[^)]+)\\)"), F.lit(1))
    bare = F.regexp_extract_all(c, F.lit("(?<!\\()https?://[^\\s)]+"), F.lit(0))
    return F.array_distinct(F.transform(F.concat(links, bare),
                                        lambda u: F.regexp_replace(u, "[.,)]+$", "")))


def url_host(col) -> Column:
    return F.lower(F.regexp_extract(as_col(col), "^[a-zA-Z][a-zA-Z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_suffixes(host) -> Column:
    """The host and its parent domains."""
    labels = F.split(as_col(host), "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))


def under_domain(host, domains) -> Column:
    """Host equals one of the domains or lies below it."""
    return F.arrays_overlap(host_suffixes(host), F.array(*[F.lit(d) for d in domains]))


def classify_host(host, table, default: str) -> Column:
    """Kind of a host from a precedence table; no join is needed, the table is fixed."""
    h = as_col(host)

    def test(match, values):
        if match == "starts":
            return h.rlike("^" + any_of(values))
        if match == "label":
            return F.concat(F.substring_index(h, ".", 1), F.lit(".")).isin(*values)
        if match == "exact":
            return h.isin(*values)
        if match == "ends":
            return h.rlike(any_of(values) + "$")
        return under_domain(h, values)

    out = None
    for kind, match, values in table:
        cond = test(match, values)
        out = F.when(cond, kind) if out is None else out.when(cond, kind)
    return out.otherwise(default)


def domain_tier(host, table=C.TIER_TABLE) -> Column:
    """Provenance tier of a host; a leading www. is dropped."""
    return classify_host(F.regexp_replace(as_col(host), "^www\\.", ""), table, "other")


def resolved_kind(host, table=C.RESOLVED_TABLE) -> Column:
    h = as_col(host)
    return F.when(h == "", "unknown").otherwise(classify_host(h, table, "unknown"))


def mask_error_text(col) -> Column:
    """Pasted error text with variable parts replaced by marks."""
    t = F.lower(as_col(col))
    for pattern, mark in C.MASK_PATTERNS:
        t = F.regexp_replace(t, pattern, mark)
    return F.trim(t)


def case_tokens(col) -> Column:
    parts = F.split(mask_error_text(col), "\\s+")
    return F.filter(parts, lambda p: (F.length(p) > 1) & ~p.isin("error", "from"))


def strip_tags(col) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(as_col(col), F.lit("")), "<[^>]+>", ""))


def html_text(html) -> Column:
    """Visible text of a page: skipped elements, comments and tags removed."""
    h = F.regexp_replace(as_col(html), "(?is)<!--.*?-->", " ")
    for tag in ("script", "style", "nav", "footer", "header", "title"):
        h = F.regexp_replace(h, f"(?is)<{tag}[\\s>].*?</{tag}>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(h, "<[^>]+>", " "), "\\s+", " "))


def strip_markdown(col) -> Column:
    t = F.regexp_replace(as_col(col), "\\[([^\\]]+)\\]\\([^)]*\\)", "$1")
    t = F.regexp_replace(t, "`([^`]+)`", "$1")
    t = F.regexp_replace(t, "\\*\\*([^*]+)\\*\\*", "$1")
    t = F.regexp_replace(t, "\\*([^*]+)\\*", "$1")
    return F.trim(F.regexp_replace(t, "\\s+", " "))


# ------------------------------------------------------------------------ slugs


def slug(col, replace: str = "[^a-z0-9_]") -> Column:
    return F.regexp_replace(F.lower(as_col(col)), replace, "_")


def dashed(col, keep: str = "a-z0-9") -> Column:
    t = F.regexp_replace(F.lower(as_col(col)), f"[^{keep}]", "-")
    return F.regexp_replace(F.regexp_replace(t, "-+", "-"), "^-|-$", "")


def term_slug(col) -> Column:
    s = dashed(col, "a-z0-9぀-鿿")
    return F.when(s == "", "term").otherwise(s)


def post_slug(stem, prefix: str = "") -> Column:
    """Hyphenated slug of 12 to 50 characters."""
    s = dashed(F.concat(F.lit(prefix), as_col(stem)))
    s = F.when(F.length(s) > 50, F.regexp_replace(F.substring(s, 1, 50), "-+$", "")).otherwise(s)
    missing = F.greatest(F.lit(0), F.ceil((12 - F.length(s)) / 2)).cast("int")
    return F.concat(s, F.repeat(F.lit("-x"), missing))


def topics(tags, stem) -> Column:
    """Up to five topic names from tags, with an error topic for error pages."""
    t = F.filter(as_col(tags), lambda x: ~x.rlike("^[0-9]+$"))
    t = F.transform(t, lambda x: F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9-]", "-"), "-+", "-"), "^-|-$", ""))
    t = F.filter(t, lambda x: F.length(x) >= 2)
    t = F.transform(t, lambda x: F.when(F.length(x) > 20, F.regexp_replace(
        F.substring(x, 1, 20), "-+$", "")).otherwise(x))
    t = F.slice(F.array_distinct(t), 1, 4)
    add = ~F.array_join(t, " ").contains("error") & ~as_col(stem).startswith("tool_")
    t = F.when(add, F.concat(t, F.array(F.lit("error")))).otherwise(t)
    return F.slice(F.when(F.size(t) == 0, F.array(F.lit("tech"))).otherwise(t), 1, 5)


def subsets(arr) -> Column:
    """All subsets of a short array, the empty one included."""
    empty = F.array(F.array().cast("array<string>"))
    return F.aggregate(as_col(arr), empty, lambda acc, x: F.concat(
        acc, F.transform(acc, lambda s: F.concat(s, F.array(x)))))


def grams(col, n: int) -> Column:
    """Substrings of ``n`` characters, by start; none in a shorter text."""
    c = as_col(col)
    last = F.length(c) - n + 1
    return F.when(last >= 1, F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(c, i, F.lit(n)))
    ).otherwise(F.array().cast("array<string>"))


def substrings(col, min_len=1, max_len=None) -> Column:
    """Distinct substrings of a short text, by start position and length."""
    c = as_col(col)
    n = F.length(c)
    low = F.lit(min_len)
    cap = n if max_len is None else F.least(n, as_col(max_len))
    def at(i):
        top = F.least(n - i + 1, cap)
        return F.when(top >= low, F.transform(
            F.sequence(low, F.greatest(top, low)), lambda k: F.substr(c, i, k))
        ).otherwise(F.array().cast("array<string>"))
    return F.when(n >= low, F.array_distinct(F.flatten(
        F.transform(F.sequence(F.lit(1), n), at)))).otherwise(F.array().cast("array<string>"))
