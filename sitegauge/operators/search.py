"""Search-console analytics: top queries, bottlenecks, priorities and queue updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.common import r6, top_per_key


def query_metrics(facts: DataFrame, keys=("page", "query")) -> DataFrame:
    clicks = F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).cast("long")
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("impressions"), clicks.alias("clicks"),
        (clicks / F.count(F.lit(1))).alias("ctr"), (F.avg("value") / 4).alias("position"))


def top_query(rows: DataFrame) -> DataFrame:
    """Query with most impressions per page; the first query text wins a tie."""
    return rows.groupBy("page").agg(
        F.min_by("query", F.struct(-F.col("impressions"), F.col("query"))).alias("top_query"))


def page_summary(facts: DataFrame) -> DataFrame:
    """Metrics and top query of each page from one aggregate per page and query, rolled up."""
    rows = facts.groupBy("page", "query").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"), F.count("value").alias("nv"),
        F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).cast("long").alias("c"))
    return rows.groupBy("page").agg(
        F.sum("n").alias("impressions"), F.sum("c").alias("clicks"),
        (F.sum("c") / F.sum("n")).alias("ctr"), (F.sum("v") / F.sum("nv") / 4).alias("position"),
        F.coalesce(F.min_by("query", F.struct(-F.col("n"), F.col("query"))), F.lit("")).alias("top_query"))


def with_top_query(pages: DataFrame, rows: DataFrame) -> DataFrame:
    return (pages.join(top_query(rows), "page", "left")
            .withColumn("top_query", F.coalesce("top_query", F.lit(""))))


def top_queries(rows: DataFrame, k: int = 10) -> DataFrame:
    return top_per_key(rows, ["page"], [F.desc("impressions"), F.col("query")], k)


def query_summary(rows: DataFrame, k: int = 10, show: int = 3) -> DataFrame:
    """Impression-weighted ctr and position over the top queries, with the first few."""
    w = F.col("impressions")
    total = F.sum(w)
    den = F.when(total == 0, 1).otherwise(total)
    listed = F.slice(F.transform(F.array_sort(F.collect_list(F.struct("rank", "query"))),
                                 lambda s: s["query"]), 1, show)
    return top_queries(rows, k).groupBy("page").agg(
        listed.alias("top_queries"), (F.sum(F.col("ctr") * w) / den).alias("avg_ctr"),
        (F.sum(F.col("position") * w) / den).alias("avg_position"))


def ctr_threshold(pages: DataFrame, cap: float = 0.015, share: float = 0.7) -> DataFrame:
    """One row: mean page ctr and the adaptive low-ctr threshold."""
    return pages.agg(F.avg("ctr").alias("mean_ctr")).withColumn(
        "threshold", F.least(F.lit(cap), F.coalesce("mean_ctr", F.lit(0.0)) * share))


def ctr_priority(min_impressions: int = 50) -> Column:
    i, c, p = F.col("impressions"), F.col("ctr"), F.col("position")
    return F.when(i < min_impressions, 0.0).otherwise(i * 0.6 + (1 - c) * 30 + p * 0.1)


def opportunity(min_impressions: int = 50) -> Column:
    i, c, p = F.col("impressions"), F.col("ctr"), F.col("position")
    return F.when(i < min_impressions, 0.0).otherwise(i * 0.6 + (1 - c) * 20 + p * 0.2)


def bottlenecks(pages: DataFrame, *, ctr_cap: float = 0.015, ultra_ctr: float = 0.01,
                ultra_impressions: int = 100, ctr_impressions: int = 10,
                pos_impressions: int = 5, pos_min: float = 11, pos_max: float = 20,
                min_impressions: int = 50) -> DataFrame:
    """Pages that are shown but not clicked, or stuck on the second result page.

    The threshold is one row by construction, so it is broadcast.
    """
    i, c, p = F.col("impressions"), F.col("ctr"), F.col("position")
    ultra = (i > ultra_impressions) & (c < ultra_ctr)
    low = ~ultra & (i >= ctr_impressions) & (c < F.col("threshold"))
    stuck = ~ultra & (i >= pos_impressions) & p.between(pos_min, pos_max)
    reasons = F.array_compact(F.array(F.when(ultra, "ultra"), F.when(low, "low ctr"),
                                      F.when(stuck, "stagnant")))
    return (pages.join(F.broadcast(ctr_threshold(pages, ctr_cap).select("threshold")))
            .withColumn("reasons", reasons).filter(F.size("reasons") > 0)
            .withColumn("ultra_priority", ultra)
            .withColumn("slug", F.regexp_extract("page", "/posts/([^/]+)/?$", 1))
            .withColumn("priority_score", ctr_priority(min_impressions))
            .withColumn("rewrite_eligible", i >= min_impressions).drop("threshold"))


def bottleneck_order(df: DataFrame, limit: int) -> DataFrame:
    return df.orderBy(F.desc("ultra_priority"), F.desc(r6("priority_score")), "page").limit(limit)


def priority_class(*, min_impressions: int = 20, low_ctr: float = 0.015) -> Column:
    """A: seen on the first pages but not clicked; B: just behind; else C."""
    i, c, p = F.col("impressions"), F.col("ctr"), F.col("position")
    return (F.when((i >= min_impressions) & p.between(4, 20) & (c < low_ctr), "A")
            .when((i >= min_impressions) & p.between(21, 40), "B").otherwise("C"))


def priority_order(df: DataFrame, limit: int) -> DataFrame:
    return df.orderBy("priority", F.desc("impressions"), "page").limit(limit)


def lowest_engagement(facts: DataFrame, min_views: int = 10, limit: int = 10) -> DataFrame:
    t = (facts.filter(F.col("page").contains("/posts/")).groupBy("page")
         .agg(F.count(F.lit(1)).alias("views"), F.avg("seconds").alias("avg_seconds")))
    return t.filter(F.col("views") >= min_views).orderBy("avg_seconds", "page").limit(limit)


def merge_bottlenecks(queue: DataFrame, found: DataFrame, titles: DataFrame) -> DataFrame:
    """Update matched queue entries from bottlenecks and append the unmatched ones.

    queue: title, priority_score, critical, top_query, source.
    """
    b = (found.filter(F.col("slug") != "").join(titles, "slug")
         .select("title", F.col("slug"), F.col("priority_score").alias("b_score"),
                 F.col("ultra_priority").alias("b_ultra"), F.col("top_query").alias("b_query"),
                 F.col("position").alias("gsc_position"), "rewrite_eligible"))
    j = queue.join(b, "title", "full_outer")
    hit, old = F.col("b_score").isNotNull(), F.col("priority_score").isNotNull()
    take = hit & (~old | F.col("b_ultra") | (F.col("b_score") > F.col("priority_score")))
    return j.select(
        "title", "slug",
        F.when(take, F.col("b_score")).otherwise(F.col("priority_score")).alias("priority_score"),
        F.when(take, F.col("b_ultra")).otherwise(F.col("critical")).alias("critical"),
        F.when(hit & (F.col("b_query") != ""), F.col("b_query"))
        .otherwise(F.coalesce("top_query", F.lit(""))).alias("top_query"),
        "gsc_position", "rewrite_eligible",
        F.when(old, F.col("source")).otherwise(F.lit("search_console")).alias("source"))


def urls_to_submit(queue: DataFrame, titles: DataFrame, submitted: DataFrame,
                   base: str) -> DataFrame:
    """Queue title to slug to URL, without URLs already submitted."""
    urls = queue.join(titles, "title").select(
        "title", F.concat(F.lit(base), F.lit("/posts/"), F.col("slug"), F.lit("/")).alias("url"))
    return urls.join(submitted.select("url"), "url", "left_anti")


def weights_of_newest(reports: DataFrame, file: str, newest: int = 3) -> DataFrame:
    """Largest weight per page over the newest reports."""
    keep = reports.select(file).distinct().orderBy(F.desc(file)).limit(newest)
    return (reports.join(keep, file, "left_semi").groupBy("page")
            .agg(F.max("impressions").alias("weight")))


def first_wins(rows: DataFrame, key: Column, order) -> DataFrame:
    """First row per normalized key, by an explicit order."""
    order = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return (rows.groupBy(key.alias("_k")).agg(F.min_by(F.struct(*rows.columns), order).alias("_r"))
            .select("_r.*"))


def gap_queries(rows: DataFrame, order) -> DataFrame:
    """Meaningful search queries, one per normalized form."""
    return first_wins(rows.filter(~tx.is_bad_query(F.col("query"))),
                      tx.normalize_query(F.col("query")), order)
