"""Keyed queues and ledgers: merges, flags, replacements, attempts and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import any_of, once


def merge_queue(scored: DataFrame, queue: DataFrame, source: str = "feedback") -> DataFrame:
    """New critical entries, new normal entries, then the queue; queued titles win."""
    new = (scored.join(queue.select("title"), "title", "left_anti")
           .select("title", "priority_score", "critical",
                   F.when(F.col("critical"), 0).otherwise(1).alias("part"),
                   F.lit(source).alias("source")))
    old = queue.select("title", "priority_score", "critical", F.lit(2).alias("part"), "source")
    return new.unionByName(old)


def upsert_thin_flags(queue: DataFrame, corpus: DataFrame, score: float = 0.3) -> DataFrame:
    """Set or clear the thin flag on queued titles and insert thin titles that are new.

    queue: title, priority_score, is_thin, thin_chars. corpus: title, chars, thin.
    """
    j = queue.withColumn("queued", F.lit(True)).join(
        corpus.select("title", "chars", "thin"), "title", "full_outer")
    queued, was = F.col("queued").isNotNull(), F.coalesce("is_thin", F.lit(False))
    j = j.filter(queued | F.col("thin"))
    fresh = F.col("thin") & ~was
    return j.select(
        "title", F.when(queued, F.col("priority_score")).otherwise(score).alias("priority_score"),
        F.coalesce("thin", was).alias("is_thin"),
        F.when(F.coalesce(fresh, F.lit(False)), F.col("chars")).otherwise(F.col("thin_chars"))
        .alias("thin_chars"),
        F.when(queued, "queue").otherwise("thin_scan").alias("source"))


def candidate_priority(critical: Column, degraded: Column, min_freshness: int = 50,
                       min_citation: int = 15) -> Column:
    return (F.when(critical | degraded | (F.col("risk") >= 70) | (F.col("factual") < 55), "high")
            .when((F.col("freshness") < min_freshness) | (F.col("citation") < min_citation), "medium")
            .otherwise("low"))


def upsert_candidates(existing: DataFrame, results: DataFrame) -> DataFrame:
    """Merge reasons and actions uniquely, old ones first; a new result sets the priority.

    Both sides: path, priority, reasons array, actions array. Order the result
    by (priority_rank, path).
    """
    none = F.array().cast("array<string>")
    o = existing.select("path", F.col("priority").alias("op"), F.col("reasons").alias("orr"),
                        F.col("actions").alias("oa"))
    j = o.join(results, "path", "full_outer")

    def both(a, b):
        return F.array_distinct(F.filter(F.concat(F.coalesce(a, none), F.coalesce(b, none)),
                                         lambda x: x != ""))

    pr = F.coalesce("priority", "op")
    rank = F.when(pr == "high", 0).when(pr == "medium", 1).when(pr == "low", 2).otherwise(9)
    return j.select("path", pr.alias("priority"), both(F.col("orr"), F.col("reasons")).alias("reasons"),
                    both(F.col("oa"), F.col("actions")).alias("actions"),
                    rank.alias("priority_rank"))


def compare_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows tagged both, left or right, in one aggregation."""
    cols = left.columns
    both = (left.select("*", F.lit(1).alias("l"), F.lit(0).alias("r"))
            .unionByName(right.select("*", F.lit(0).alias("l"), F.lit(1).alias("r"))))
    g = both.groupBy(*cols).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    side = F.when(F.col("r") == 0, "left").when(F.col("l") == 0, "right").otherwise("both")
    return g.select(*cols, side.alias("side"))


def replace_and_append(records: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Append rows, replacing those with the same composite key."""
    return records.join(new.select(*keys), list(keys), "left_anti").unionByName(
        new, allowMissingColumns=True)


def attempts_since_success(rows: DataFrame, key: str, success: Column, order,
                           review_at: int = 3) -> DataFrame:
    """Failures since the last success per key; keys ending in success have no entry."""
    o = F.struct(*order)
    last = rows.groupBy(key).agg(F.max(F.when(success, o)).alias("last"))
    open_rows = (rows.filter(~success).select(key, o.alias("o")).join(last, key)
                 .filter(F.col("last").isNull() | (F.col("o") > F.col("last"))))
    n = open_rows.groupBy(key).agg(F.count(F.lit(1)).alias("failures"))
    return n.withColumn("state", F.when(F.col("failures") >= review_at, "needs_manual_review")
                        .otherwise("retry"))


def dedupe_across_sources(records: DataFrame, order) -> DataFrame:
    """First record per slug, else URL, else title; all three empty counts as one key."""
    text = lambda c: F.when(F.col(c) != "", F.col(c))
    k = F.coalesce(text("slug"), text("url"), text("title"), F.lit(""))
    return (records.groupBy(k.alias("key"))
            .agg(F.min_by(F.struct(*records.columns), F.struct(*order)).alias("r"))
            .select("key", "r.*"))


def migrate_reviews(flat: DataFrame, key: str) -> DataFrame:
    """Flat verification records to a history of one (date, note) entry."""
    return flat.select(key, "verified", "verified_at", F.col("verified_at").alias("last_verified_at"),
                       F.array(F.struct(F.col("verified_at").alias("date"), "note")).alias("history"))


def append_reviews(status: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Append one new verification (date, note) per key, creating missing entries."""
    n = new.select(key, F.col("date").alias("nd"), F.struct("date", "note").alias("entry"))
    j = status.join(n, key, "full_outer")
    added = F.when(F.col("entry").isNotNull(), F.array("entry"))
    empty = F.slice(F.array(F.col("entry")), 1, 0)
    return j.select(
        key, (F.col("entry").isNotNull() | F.coalesce("verified", F.lit(False))).alias("verified"),
        F.coalesce("verified_at", "nd").alias("verified_at"),
        F.coalesce("nd", "last_verified_at").alias("last_verified_at"),
        F.concat(F.coalesce("history", empty), F.coalesce(added, empty)).alias("history"))


# fixed value: characters of list numbering and bullets
LIST_MARKS = "0-9.\\-）)・ "


def new_names(lines: DataFrame, existing: DataFrame, min_len: int = 2) -> DataFrame:
    """Unseen names from a list text: numbering and bullets stripped."""
    name = F.trim(F.regexp_replace(F.trim("line"), f"^[{LIST_MARKS}]+", ""))
    names = lines.select(name.alias("name")).filter(F.length("name") >= min_len).distinct()
    return names.join(existing.select("name"), "name", "left_anti")


# ----------------------------------------------------------------- payload validation

SCORE_KEYS = ("factual_score", "freshness_score", "citation_coverage", "risk_score")


def payload_text(raw: Column) -> Column:
    """The JSON object inside a reply: fences dropped, first brace to last."""
    t = F.trim(raw, F.lit(" \t\r\n"))
    fenced = F.regexp_extract(t, "(?is)```(?:json)?\\s*(.*?)```", 1)
    t = F.when(t.rlike("(?is)```.*?```"), F.trim(fenced, F.lit(" \t\r\n"))).otherwise(t)
    return once(t, lambda t: once(F.regexp_extract(t, "(?s)\\{.*\\}", 0), lambda obj: F.when(obj != "", obj).otherwise(t)))


def validate_payload(raw: Column, keys=SCORE_KEYS, low: int = 0, high: int = 100) -> Column:
    """Struct(status, error, scores): required keys, numeric type and range; booleans fail."""
    def parts(p):
        have = F.coalesce(F.json_object_keys(p), F.array().cast("array<string>"))
        return F.struct(F.schema_of_variant(F.try_parse_json(p)).alias("kind"),
                        F.array_except(F.array(*[F.lit(k) for k in keys]), have).alias("missing"),
                        F.array(*[F.get_json_object(p, f"$.{k}") for k in keys]).alias("text"))

    def numbers(f):
        num = [f["text"][i].try_cast("double") for i in range(len(keys))]
        return F.array(*[F.when(~F.isnan(n) & (F.abs(n) < 1e9), n.cast("int")) for n in num])

    def verdict(f, whole):
        error = (F.when(raw == "", "empty response").when(f["kind"].isNull(), "json_parse_error")
                 .when(~f["kind"].startswith("OBJECT"), "root is not an object")
                 .when(F.size(f["missing"]) > 0, F.concat(F.lit("missing required keys: "),
                                                          F.array_join(f["missing"], ", "))))
        for i, k in enumerate(keys):
            text = f["text"][i]
            error = error.when(text.isNull() | text.rlike("^\\s*[\\[{]") | text.isin("true", "false"),
                               f"invalid type for {k}")
            error = error.when(whole[i].isNull(), f"non numeric score for {k}")
            error = error.when(~whole[i].between(low, high), f"score out of range for {k}")
        scores = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), whole)
        return once(error.otherwise(""), lambda e: F.struct(
            F.when(e == "", "ok").otherwise("invalid_json").alias("status"),
            e.alias("error"), F.when(e == "", scores).alias("scores")))

    return once(payload_text(raw), lambda p: once(parts(p), lambda f: once(numbers(f), lambda w: verdict(f, w))))


PAYLOAD_LISTS = ("struct<sources: array<struct<url: string, title: string, claim: string, "
                 "source_type: string, type: string>>, unsupported_claims: array<string>, "
                 "claims: array<struct<text: string, source_urls: array<string>>>, "
                 "citation_mismatches: array<struct<url: string, claimed: string, actual: string>>>")


def payload_lists(raw: Column) -> Column:
    """Struct of normalized sources, unsupported claims and complete citation mismatches."""
    d = F.from_json(payload_text(raw), PAYLOAD_LISTS)
    t = lambda c: F.trim(F.coalesce(c, F.lit("")))
    none = F.array().cast("array<string>")
    src = F.transform(d["sources"], lambda s: F.struct(
        t(s["url"]).alias("url"), t(s["title"]).alias("title"), t(s["claim"]).alias("claim"),
        F.coalesce(F.nullif(t(s["source_type"]), F.lit("")), F.nullif(t(s["type"]), F.lit("")),
                   F.lit("unknown")).alias("source_type")))
    bare = F.filter(d["claims"], lambda c: (t(c["text"]) != "") & ~F.exists(
        F.coalesce(c["source_urls"], none), lambda u: u.rlike("^https?://")))
    unsupported = F.concat(F.coalesce(d["unsupported_claims"], none),
                           F.coalesce(F.transform(bare, lambda c: t(c["text"])), none))
    full = F.filter(F.transform(d["citation_mismatches"], lambda m: F.struct(
        t(m["url"]).alias("url"), t(m["claimed"]).alias("claimed"), t(m["actual"]).alias("actual"))),
        lambda m: (m["url"] != "") & (m["claimed"] != "") & (m["actual"] != ""))
    return F.struct(src.alias("sources"), unsupported.alias("unsupported_claims"),
                    full.alias("citation_mismatches"))
