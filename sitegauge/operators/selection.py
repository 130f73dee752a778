"""Selections, rewrite outcomes, change events and cost rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.common import count_if, r6

# ------------------------------------------------------------- J10, G14, K05, K06, A21

VERDICTS = ("worse", "improved", "unchanged", "pending")


def fill_after_metrics(experiments: DataFrame, pages: DataFrame, as_of: Column,
                       days: int = 14) -> DataFrame:
    """After-metrics and changes for old experiments that lack them, by URL without slash.

    experiments: url, rewrite_date, before_ctr, before_position, after_ctr.
    """
    key = lambda c: F.regexp_replace(c, "/+$", "")
    p = pages.groupBy(key("page").alias("u")).agg(
        F.max_by(F.struct("ctr", "position", "impressions"), "impressions").alias("m"))
    due = (F.col("rewrite_date") <= F.date_sub(as_of, days)) & F.col("after_ctr").isNull()
    j = experiments.join(p, key("url") == F.col("u"), "left").drop("u")
    hit = F.col("updated")
    return (j.withColumn("updated", due & F.col("m").isNotNull())
            .withColumn("ctr_change", F.when(hit, F.col("m.ctr") - F.coalesce("before_ctr", F.lit(0.0))))
            .withColumn("position_change", F.when(
                hit, F.col("m.position") - F.coalesce("before_position", F.lit(0.0))))
            .withColumn("after_ctr", F.when(hit, F.col("m.ctr")).otherwise(F.col("after_ctr")))
            .withColumn("after_impressions", F.when(hit, F.col("m.impressions")))
            .drop("m"))


def rewrite_verdict(as_of: Column, min_days: int = 14, gain: float = 0.2,
                    ranks: float = 3.0) -> dict[str, Column]:
    """Outcome of a rewrite with its reason and age in days."""
    age = F.datediff(as_of, F.col("rewrite_date"))
    bi, ai = F.col("before_impressions"), F.col("after_impressions")
    bp, ap = F.col("before_position"), F.col("after_position")
    change = F.try_divide((ai - bi).cast("double"), bi)
    better = bp - ap
    clicks = F.coalesce(F.col("after_clicks") > F.col("before_clicks"), F.lit(False))
    early = F.coalesce(age < min_days, F.lit(False))
    no_before, no_after = bi.isNull() | bp.isNull(), ai.isNull() | ap.isNull()
    good = change.isNotNull() & ((change >= gain) | (better >= ranks) | clicks)
    bad = change.isNotNull() & (change <= -gain) & (better <= -ranks)
    pending = early | no_before | no_after
    return {
        "verdict": F.when(pending, "pending").when(good, "improved").when(bad, "worse")
        .otherwise("unchanged"),
        "reason": F.when(early, "too early").when(no_before, "no before data")
        .when(no_after, "no after data").otherwise("measured"),
        "elapsed_days": age}


def outcome_order(rows: DataFrame, limit: int) -> DataFrame:
    """Worse, improved, unchanged, pending; longest elapsed first."""
    rank = F.coalesce(*[F.when(F.col("verdict") == v, F.lit(i)) for i, v in enumerate(VERDICTS)],
                      F.lit(9))
    return rows.orderBy(rank, F.desc(F.coalesce("elapsed_days", F.lit(-1))), "slug").limit(limit)


def ctr_rankings(rows: DataFrame, k: int = 20):
    """(largest ctr gains, largest losses)."""
    done = rows.filter(F.col("ctr_change").isNotNull())
    return (done.orderBy(F.desc("ctr_change"), "slug").limit(k),
            done.orderBy("ctr_change", "slug").limit(k))


def verdict_counts(rows: DataFrame) -> DataFrame:
    """Records per verdict with zeros for absent ones."""
    c = rows.agg(*[count_if(F.col("verdict") == v).alias(v) for v in VERDICTS])
    return c.unpivot([], list(VERDICTS), "verdict", "n")


# ----------------------------------------------------------------- A19 change events


def change_rollup(events: DataFrame) -> DataFrame:
    """Distinct new, modified and unpublished paths; a rename counts as modified only.

    events: status (A, M, D, Rnnn), path, old_path, new_path, old_draft, new_draft.
    """
    is_post = lambda c: F.coalesce(c.rlike("^content/posts/.*\\.md$"), F.lit(False))
    s, path = F.col("status"), F.col("path")
    renamed = s.startswith("R")
    out = F.coalesce(F.col("old_draft") & ~F.col("new_draft"), F.lit(False))
    back = F.coalesce(~F.col("old_draft") & F.col("new_draft"), F.lit(False))
    kind = (F.when(out, "new").when(back, "unpublished").when(s.startswith("A"), "new")
            .when(s.startswith("D"), "unpublished").when(s.startswith("M"), "modified"))
    none = F.lit(None).cast("string")
    marks = F.when(renamed, F.array(
        F.struct(F.when(is_post(F.col("new_path")), F.col("new_path")).alias("p"), F.lit("modified").alias("k")),
        F.struct(F.when(is_post(F.col("new_path")), F.col("new_path")).alias("p"), F.lit("renamed_to").alias("k")),
        F.struct(F.when(is_post(F.col("old_path")), F.col("old_path")).alias("p"), F.lit("renamed_from").alias("k")),
    )).otherwise(F.array(F.struct(F.when(is_post(path), path).otherwise(none).alias("p"), kind.alias("k"))))
    m = events.select(F.explode(marks).alias("m")).select("m.*").filter("p IS NOT NULL AND k IS NOT NULL")
    has = lambda k: F.max((F.col("k") == k))
    f = m.groupBy("p").agg(*[has(k).alias(k) for k in (
        "new", "modified", "unpublished", "renamed_from", "renamed_to")])
    return f.agg(count_if(F.col("new")).alias("added"),
                 count_if(F.col("modified") & ~F.col("new")).alias("modified"),
                 count_if(F.col("unpublished") & ~F.col("new")).alias("unpublished"),
                 count_if(F.col("renamed_from")).alias("renamed_from"),
                 count_if(F.col("renamed_to")).alias("renamed_to"))


# ------------------------------------------------------------------- A23 token costs

TOKEN_CLASSES = ("input", "output", "cache_write", "cache_read")


def token_costs(usage: DataFrame, prices: DataFrame, keys=("model",)) -> DataFrame:
    """Cost per key: tokens per million times price per class, plus web requests.

    Tokens are summed before the price join, so only one row per key is priced.
    """
    t = usage.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*TOKEN_CLASSES, "web_requests")])
    j = t.join(prices, "model")
    cost = lambda c: F.col(c) / 1e6 * F.col(f"{c}_price")
    web = F.col("web_requests") * F.col("web_price")
    cache = cost("cache_write") + cost("cache_read")
    return j.select(*keys, *[F.col(c).cast("long").alias(c) for c in (*TOKEN_CLASSES, "web_requests")],
                    r6(cost("input")).alias("input_cost"), r6(cost("output")).alias("output_cost"),
                    r6(cache).alias("cache_cost"), r6(web).alias("web_cost"),
                    r6(cost("input") + cost("output") + cache + web).alias("total_cost"))


# ------------------------------------------------------------------------ selections


def recheck_selection(docs: DataFrame, limit: int = 20) -> DataFrame:
    """Documents to score again, most urgent first.

    docs: path, age, stale, high_change, traffic, citations, prior (lowest
    factual - risk so far).
    """
    p = (F.col("age") + F.col("stale") + F.when(F.col("high_change"), 180).otherwise(0)
         + F.least(F.lit(200), F.coalesce("traffic", F.lit(0)))
         + F.when(F.col("citations") < 2, 80).otherwise(0)
         + F.when(F.col("prior") < 35, 40).otherwise(0))
    return docs.withColumn("priority", p.cast("long")).orderBy(
        F.desc("priority"), F.desc("path")).limit(limit)


def refresh_order(docs: DataFrame, queue: DataFrame, limit: int = 20) -> DataFrame:
    """Due documents by queue score, then the oldest check date."""
    q = queue.select("title", "priority_score")
    return (docs.join(q, "title", "left").withColumn("score", F.coalesce("priority_score", F.lit(0.0)))
            .orderBy(F.desc("score"), "check_date", "path").limit(limit))


def recent(docs: DataFrame, date: str, key: str, k: int = 10) -> DataFrame:
    return docs.orderBy(F.desc(date), F.desc(key)).limit(k)


def lacking_fields(queue: DataFrame, fields, order: str, n: int) -> DataFrame:
    """First rows of a queue with an empty required field."""
    empty = F.lit(False)
    for f in fields:
        empty = empty | (F.trim(F.coalesce(F.col(f), F.lit(""))) == "")
    return queue.filter(empty).orderBy(order).limit(n)


def rewrite_worklist(linted: DataFrame, key: str, deleted: DataFrame, fails: Column,
                     late_rule: str = "A1") -> DataFrame:
    """Error documents with a failure other than a disqualifier, late_rule ones last."""
    f = linted.withColumn("fails", fails)
    keep = F.col("is_error") & (F.size("fails") > 0) & ~F.array_contains("fails", "B2")
    return (f.filter(keep).join(deleted.select(key), key, "left_anti")
            .withColumn("late", F.array_contains("fails", late_rule)))


def allocate_slots(published_today: DataFrame, pending: DataFrame, queue: DataFrame,
                   quota: int, threshold: int = 10000, batch: int = 30) -> DataFrame:
    """Daily slots: oldest good pending entries first, then the queue; surplus waits.

    pending: key, ord, bad (exists already or garbled). queue: key, ord.
    Result: key, source, outcome (published, dropped or pending). The quota
    bounds every ranked set, so nothing but a few rows is ranked in one place.
    """
    slots = published_today.agg(F.greatest(F.lit(0), F.lit(quota) - F.count(F.lit(1))).alias("slots"))
    first = pending.filter("NOT bad").orderBy("ord", "key").limit(quota)
    rank = F.row_number().over(Window.orderBy("ord", "key"))
    good = (first.withColumn("rn", rank).join(F.broadcast(slots))
            .filter(F.col("rn") <= F.col("slots")))
    used = good.agg(F.count(F.lit(1)).alias("used"), F.max("ord").alias("cut"))
    state = (slots.join(F.broadcast(used)).join(F.broadcast(
        pending.agg(F.count(F.lit(1)).alias("waiting"))))
        .withColumn("left", F.col("slots") - F.col("used")))
    # entries after the last published one are not looked at once slots run out
    seen = (F.col("left") > 0) | (F.col("ord") <= F.col("cut"))
    outcome = (F.when((F.col("slots") > 0) & F.coalesce(seen, F.lit(False)),
                      F.when(F.col("bad"), "dropped").otherwise("published")).otherwise("pending"))
    p = pending.join(F.broadcast(state)).select(
        "key", F.lit("pending").alias("source"), outcome.alias("outcome"))
    heads = queue.orderBy("ord", "key").limit(batch).withColumn("rn", rank)
    q = (heads.join(F.broadcast(state)).filter((F.col("waiting") < threshold) & (F.col("left") > 0))
         .select("key", F.lit("queue").alias("source"),
                 F.when(F.col("rn") <= F.col("left"), "published").otherwise("pending").alias("outcome")))
    return p.unionByName(q)
