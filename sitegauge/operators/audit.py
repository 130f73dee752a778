"""Audits of repeated quality scores: variance, flips, sensitivity, rank correlation, drift.

Scores are integers from 0 to 100 (or null). Exact percentiles therefore keep
at most 101 counts per group, and rank tables have at most 101 rows per axis.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import constants as C
from ..functions.common import (count_if, dealt, first_per_key, latest_per_key, newest_first, ratio,
                                top_per_key)
from ..session import cut_lineage

AXES = ("factual", "freshness", "citation", "risk")


def as_score(c) -> Column:
    """Score as double; NaN and infinities count as null."""
    v = F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


# ----------------------------------------------------------------- rows and gates


def keep_last(raw: DataFrame, order: str = "order_key", rows: int | None = None) -> DataFrame:
    """Keep the last row per evaluation id; rows without an id stay as they are.

    With the number of ``rows`` they are dealt by id first, into partitions of bounded size.
    """
    ided = raw.filter(F.col("eval_id").isNotNull())
    if rows is not None:
        ided = dealt(ided, rows, "eval_id")
    ided = latest_per_key(ided, ["eval_id"], F.col(order))
    return ided.unionByName(raw.filter(F.col("eval_id").isNull())).drop(order)


def latest(history: DataFrame, keys=("path",)) -> DataFrame:
    """Newest row per key; on equal times the first seen wins."""
    return first_per_key(history, list(keys), F.struct(newest_first(history, "checked_at"), "seq"))


def axis_ok(axis: str, gate: dict) -> Column:
    kind, limit = gate[axis]
    return F.col(axis) >= limit if kind == "min" else F.col(axis) <= limit


def gate_passes(gate: dict) -> Column:
    """Verdict from scores; null when a needed score is missing."""
    ok = None
    for axis in gate:
        ok = axis_ok(axis, gate) if ok is None else ok & axis_ok(axis, gate)
    missing = F.lit(False)
    for axis in AXES:
        missing = missing | F.col(axis).isNull()
    return F.when(~missing, ok)


def live_status(gate: dict = C.LIVE_GATE, critical_topic: Column | None = None,
                critical_risk: int = 85, mode: str = "new") -> dict[str, Column]:
    """Live gate: pass, reject / needs_revision, or critical with its level."""
    topic = F.lit(False) if critical_topic is None else critical_topic
    level = (F.when(F.col("risk") >= critical_risk, "high")
             .when(topic & (F.col("factual") < 55), "medium").otherwise(""))
    fail = "reject" if mode == "new" else "needs_revision"
    passed = gate_passes(gate)
    return {"passed": passed, "critical_level": level,
            "status": F.when(level != "", "critical").when(passed, "pass").otherwise(fail)}


# ------------------------------------------------------------------- rescore groups


def rescore_groups(ok: DataFrame, gate: dict = C.AUDIT_GATE) -> DataFrame:
    """One row per path: size, hash stability, per-axis range and deviation, verdict spread.

    Everything the variance and flip audits need comes from this one
    aggregation; a path with very many rows is combined before the shuffle.
    """
    h = F.coalesce("article_hash", F.lit("\u0000none"))
    verdict = gate_passes(gate)
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(h).alias("h1"), F.max(h).alias("h2"),
            F.count(verdict).alias("verdicts"), F.min(verdict).alias("v1"),
            F.max(verdict).alias("v2"),
            count_if(verdict != (F.col("judgement") == "pass")).alias("disagreements")]
    for a in AXES:
        p = axis_ok(a, gate)
        many = F.count(a) >= 2
        aggs += [F.when(many, F.max(a) - F.min(a)).cast("double").alias(f"{a}_range"),
                 F.when(many, F.round(F.stddev_pop(a), 4)).alias(f"{a}_std"),
                 (F.min(p) != F.max(p)).alias(f"{a}_crosses")]
    g = ok.groupBy("path").agg(*aggs)
    pure = (F.col("h1") == F.col("h2")) & (F.col("rows") >= 2)
    flips = (F.col("verdicts") >= 2) & (F.col("v1") != F.col("v2"))
    return (g.withColumn("hash_changed", F.col("h1") != F.col("h2"))
            .withColumn("pure", pure).withColumn("flips", flips)
            .drop("h1", "h2", "v1", "v2", "verdicts"))


def hash_groups(ok: DataFrame) -> DataFrame:
    """Size and hash stability per path, as in ``rescore_groups``, without reading scores."""
    h = F.coalesce("article_hash", F.lit("\u0000none"))
    g = ok.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.min(h).alias("h1"), F.max(h).alias("h2"))
    return g.select("path", "rows", ((F.col("h1") == F.col("h2")) & (F.col("rows") >= 2)).alias("pure"),
                    (F.col("h1") != F.col("h2")).alias("hash_changed"))


def per_axis(df: DataFrame, suffix: str, value: str) -> DataFrame:
    """Unpivot ``<axis><suffix>`` columns to (axis, value)."""
    cols = [F.col(f"{a}{suffix}").cast("double").alias(a) for a in AXES]
    return df.select(*cols).unpivot([], list(AXES), "axis", value)


def variance_verdict(med: Column) -> Column:
    return (F.when(med.isNull(), "insufficient data").when(med < 5, "stable")
            .when(med <= 15, "consider voting").otherwise("revise gate"))


def rescore_variance(groups: DataFrame) -> DataFrame:
    """Median, p90 and maximum range per axis over the pure groups."""
    pure = groups.filter("pure")
    both = (per_axis(pure, "_range", "range").withColumn("std", F.lit(None).cast("double"))
            .unionByName(per_axis(pure, "_std", "std")
                         .withColumn("range", F.lit(None).cast("double"))))
    s = both.groupBy("axis").agg(
        F.count("range").alias("n_groups"), F.percentile("range", 0.5).alias("range_median"),
        F.percentile("range", 0.9).alias("range_p90"), F.max("range").alias("range_max"),
        F.percentile("std", 0.5).alias("std_median"))
    return s.withColumn("verdict", variance_verdict(F.col("range_median")))


def worst_groups(groups: DataFrame, k: int = 5) -> DataFrame:
    return (groups.filter("pure")
            .select("path", F.coalesce("factual_range", F.lit(0.0)).alias("factual_range"))
            .orderBy(F.desc("factual_range"), "path").limit(k))


def flip_rate(groups: DataFrame) -> DataFrame:
    """Share of pure groups whose verdict differs between runs, with the crossing axes."""
    flip = F.col("pure") & F.col("flips")
    s = groups.agg(
        count_if(F.col("pure")).alias("n_groups"), count_if(flip).alias("flip_count"),
        *[count_if(flip & F.col(f"{a}_crosses")).alias(f"cause_{a}") for a in AXES],
        F.sum("disagreements").cast("long").alias("judgement_disagreements"))
    rate = F.try_divide(F.col("flip_count").cast("double"), F.col("n_groups"))
    return (s.withColumn("flip_rate", rate)
            .withColumn("verdict", F.when(rate.isNull(), "insufficient data")
                        .when(rate < 0.10, "stable").when(rate <= 0.25, "consider voting")
                        .otherwise("revise gate")))


# --------------------------------------------------------------- threshold sensitivity


def score_counts(rows: DataFrame) -> DataFrame:
    """(axis, value, n): at most 101 rows per axis."""
    return (per_axis(rows, "", "value").filter(F.col("value").isNotNull())
            .groupBy("axis", "value").agg(F.count(F.lit(1)).alias("n")))


def _limits(gate: dict):
    limit = F.coalesce(*[F.when(F.col("axis") == a, F.lit(float(v))) for a, (_, v) in gate.items()])
    lower = F.coalesce(*[F.when(F.col("axis") == a, F.lit(k == "min")) for a, (k, _) in gate.items()])
    return limit, lower


def threshold_sensitivity(rows: DataFrame, gate: dict = C.AUDIT_GATE,
                          deltas=(-10, -5, 0, 5, 10)) -> DataFrame:
    """Distribution per axis and its pass rate at shifted thresholds."""
    limit, lower = _limits(gate)
    c = (score_counts(rows).withColumn("delta", F.explode(F.array(*[F.lit(d) for d in deltas])))
         .withColumn("threshold", limit + F.col("delta")))
    ok = F.when(lower, F.col("value") >= F.col("threshold")).otherwise(
        F.col("value") <= F.col("threshold"))
    p = lambda q: F.percentile("value", q, F.col("n"))
    s = c.groupBy("axis", "delta", "threshold").agg(
        F.sum("n").cast("long").alias("n"), p(0.5).alias("median"), p(0.1).alias("p10"),
        p(0.9).alias("p90"), F.min("value").alias("min"), F.max("value").alias("max"),
        ratio(F.sum(F.when(ok, F.col("n")).otherwise(0)), F.sum("n")).alias("pass_rate"))
    return s.withColumn("non_functional", (F.col("delta") == 0) & (F.col("pass_rate") > 0.95))


def grey_zone(rows: DataFrame, variance: DataFrame, gate: dict = C.AUDIT_GATE) -> DataFrame:
    """Share of rows within one median range of a threshold, per axis and overall.

    ``variance`` has one row per axis, so its pivot is one row and is broadcast.
    """
    med = variance.groupBy().agg(*[
        F.max(F.when(F.col("axis") == a, F.col("range_median"))).alias(f"m_{a}") for a in AXES])
    j = rows.join(F.broadcast(med))

    def near(a):
        kind, t = gate[a]
        m, v = F.col(f"m_{a}"), F.col(a)
        hit = ((v >= t - m) & (v < t + m)) if kind == "min" else ((v > t - m) & (v <= t + m))
        return F.coalesce(hit & (m > 0), F.lit(False))

    any_axis = near(AXES[0])
    for a in AXES[1:]:
        any_axis = any_axis | near(a)
    wide = j.agg(*[
        F.when(F.max(f"m_{a}") > 0, ratio(count_if(near(a)), F.count(a))).alias(a) for a in AXES],
        ratio(count_if(any_axis), F.count(F.lit(1))).alias("overall"))
    return wide.unpivot([], [*AXES, "overall"], "axis", "rate")


# ------------------------------------------------------------------- rank correlation


def spearman(rows: DataFrame, min_rows: int = 3, redundant: float = 0.8) -> DataFrame:
    """Spearman matrix with average ranks for ties over complete rows.

    Rows are reduced once to counts of score pairs (at most 101 x 101 per axis
    pair); ranks come from the per-axis counts, so nothing is sorted globally.
    """
    full = rows.dropna(subset=list(AXES)).select(*AXES)
    cells = F.array(*[F.struct(F.lit(a).alias("a1"), F.col(a).alias("v1"),
                               F.lit(b).alias("a2"), F.col(b).alias("v2"))
                      for i, a in enumerate(AXES) for b in AXES[i:]])
    pairs = (full.select(F.explode(cells).alias("c")).select("c.*")
             .groupBy("a1", "v1", "a2", "v2").agg(F.count(F.lit(1)).alias("n")))
    marginal = (pairs.filter(F.col("a1") == F.col("a2"))
                .select(F.col("a1").alias("a"), F.col("v1").alias("v"), "n"))
    w = Window.partitionBy("a").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy("a"))
    ranks = marginal.select(
        "a", "v", total.alias("total"),
        (F.sum("n").over(w) - (F.col("n") - 1) / 2 - (total + 1) / 2).alias("r"))
    j = (pairs.join(ranks.select(F.col("a").alias("a1"), F.col("v").alias("v1"),
                                 F.col("r").alias("r1"), "total"), ["a1", "v1"])
         .join(ranks.select(F.col("a").alias("a2"), F.col("v").alias("v2"),
                            F.col("r").alias("r2")), ["a2", "v2"]))
    n, r1, r2 = F.col("n"), F.col("r1"), F.col("r2")
    s = j.groupBy("a1", "a2").agg(
        F.max("total").cast("long").alias("n_rows"), F.sum(n * r1 * r2).alias("xy"),
        F.sum(n * r1 * r1).alias("xx"), F.sum(n * r2 * r2).alias("yy"))
    rho = F.when(F.col("n_rows") >= min_rows,
                 F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))))
    # each unordered pair was counted once; list it both ways
    ends = F.array_distinct(F.array(F.struct(F.col("a1").alias("axis1"), F.col("a2").alias("axis2")),
                                    F.struct(F.col("a2").alias("axis1"), F.col("a1").alias("axis2"))))
    return s.select(F.explode(ends).alias("e"), "n_rows", rho.alias("rho")).select(
        "e.*", "n_rows", "rho").withColumn(
        "redundant", (F.col("axis1") < F.col("axis2")) & (F.abs("rho") > redundant))


# ----------------------------------------------------------------- drift and segments


def week_key(ts) -> Column:
    """Year and Monday-start week of the year, weeks before the first Monday being 00."""
    t = F.col(ts) if isinstance(ts, str) else ts
    week = F.floor((F.dayofyear(t) - 1 + 7 - F.weekday(t)) / 7)
    return F.concat(F.year(t).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def weekly_medians(ok: DataFrame) -> DataFrame:
    n = sum((F.count(a) for a in AXES[1:]), F.count(AXES[0]))
    return ok.groupBy(week_key("checked_at").alias("week")).agg(
        *[F.percentile(a, 0.5).alias(a) for a in AXES],
        F.floor(n / len(AXES)).cast("long").alias("n"))


def change_points(history: DataFrame, cols=("model", "prompt_version")) -> DataFrame:
    """First appearance of every model and prompt version, without the very first one."""
    long = history.select("checked_at", *cols).unpivot(["checked_at"], list(cols), "type", "value")
    first = (long.filter(F.col("value") != "").groupBy("type", "value")
             .agg(F.min("checked_at").alias("first_seen")))
    oldest = first.groupBy("type").agg(F.min(F.struct("first_seen", "value")).alias("o"))
    return (first.join(oldest, "type").filter(F.struct("first_seen", "value") != F.col("o"))
            .select("type", "value", "first_seen"))


def enrich_history(history: DataFrame, deleted: DataFrame, articles: DataFrame,
                   name: Column) -> DataFrame:
    """Deleted flag, article type (auto_ files are feed articles) and tool (first tag)."""
    d = deleted.select("path").distinct().withColumn("is_deleted", F.lit(True))
    a = articles.select("path", F.get("tags", F.lit(0)).alias("tag"),
                        F.lit(True).alias("exists"))
    return (history.join(d, "path", "left").join(a, "path", "left")
            .withColumn("is_deleted", F.coalesce("is_deleted", F.lit(False)))
            .withColumn("article_type", F.when(name.startswith("auto_"), "rss").otherwise("daily"))
            .withColumn("tool", F.when(F.col("exists").isNull(), "deleted")
                        .otherwise(F.coalesce("tag", F.lit("unknown"))))
            .drop("tag", "exists"))


def segment_quantiles(rows: DataFrame) -> DataFrame:
    seg = F.when(F.col("is_deleted"), "deleted").otherwise(F.col("article_type"))
    long = (rows.select(seg.alias("segment"), *[F.col(a).cast("double").alias(a) for a in AXES])
            .unpivot(["segment"], list(AXES), "axis", "value"))
    return long.groupBy("segment", "axis").agg(
        F.count("value").alias("n"), F.percentile("value", 0.25).alias("p25"),
        F.percentile("value", 0.5).alias("median"), F.percentile("value", 0.75).alias("p75"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def tool_medians(rows: DataFrame, min_rows: int = 3) -> DataFrame:
    n = F.greatest(*[F.count(a) for a in AXES])
    return (rows.groupBy("tool").agg(n.alias("n"), *[F.percentile(a, 0.5).alias(a) for a in AXES])
            .filter(F.col("n") >= min_rows))


# ------------------------------------------------------------------------ run health


def status_rates(history: DataFrame) -> DataFrame:
    s = history.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("n"))
    total = s.agg(F.sum("n").alias("total"))  # one row
    return s.join(F.broadcast(total)).select("status", "n", ratio("n", "total").alias("rate"))


def error_patterns(details: DataFrame, col: str, k: int = 10) -> DataFrame:
    """Most frequent first words of error details."""
    word = F.substring(F.get(F.split(F.trim(F.col(col)), "[ \\t\\r\\n:|]"), F.lit(0)), 1, 60)
    return (details.select(word.alias("pattern")).filter(F.col("pattern") != "")
            .groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "pattern").limit(k))


def source_rollup(history: DataFrame, redirect: str = "vertexaisearch|googleapis.com/v1/grounding"):
    """(source rows per check status, one row of redirect rate and claim statistics)."""
    src = history.select(F.explode_outer("sources").alias("s")).filter(F.col("s").isNotNull())
    by_status = src.groupBy(F.coalesce("s.url_check_status", F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("n"),
        count_if(F.coalesce("s.url", F.lit("")).rlike(redirect)).alias("redirects"))
    claims = F.when(F.col("status") == "ok",
                    F.greatest(F.size(F.coalesce("unsupported_claims",
                                                 F.array().cast("array<string>"))), F.lit(0)))
    totals = by_status.agg(F.sum("n").cast("long").alias("sources"),
                           ratio(F.sum("redirects"), F.sum("n")).alias("redirect_rate"))
    stats = history.agg(F.percentile(claims, 0.5).alias("claims_median"),
                        F.max(claims).cast("long").alias("claims_max"))
    return by_status, totals.join(F.broadcast(stats))


# ------------------------------------------------------------------- votes and previous


def majority_vote(votes: DataFrame, gate: dict = C.LIVE_GATE, min_votes: int = 2) -> DataFrame:
    """Per-axis integer median of the valid votes, its verdict and the template vote.

    Votes are first reduced to one row per (group, factual score), so looking
    for the vote nearest the median never scans a whole group in one task.
    """
    valid = votes.dropna(subset=list(AXES))
    med = valid.groupBy("path").agg(
        F.count(F.lit(1)).alias("votes"),
        *[F.percentile(a, 0.5).cast("int").alias(a) for a in AXES]
    ).filter(F.col("votes") >= min_votes)
    firsts = valid.groupBy("path", F.col("factual").alias("f")).agg(
        F.min(F.struct("seq", "eval_id")).alias("first"))
    template = (firsts.join(med.select("path", "factual"), "path").groupBy("path").agg(
        F.min(F.struct(F.abs(F.col("f") - F.col("factual")).alias("d"), "first")).alias("t")))
    cols = live_status(gate)
    return (med.select("*", *[c.alias(n) for n, c in cols.items()])
            .join(template.select("path", F.col("t.first.eval_id").alias("template")), "path"))


def distinct_mismatches(votes: DataFrame) -> DataFrame:
    """Citation mismatches of a vote group, first one per URL."""
    m = votes.select("path", "seq", F.posexplode("citation_mismatches").alias("pos", "m"))
    return (m.filter(F.trim("m.url") != "").groupBy("path", F.trim("m.url").alias("url"))
            .agg(F.min_by("m", F.struct("seq", "pos")).alias("mismatch")))


def degraded(history: DataFrame, drop: int = 10, rise: int = 15) -> DataFrame:
    """Newest score against the previous one, skipping one exact duplicate of it."""
    t = top_per_key(history, ["path"], [F.desc("checked_at"), F.col("seq")], 3, "rn")
    at = lambda i: F.max(F.when(
        F.col("rn") == i, F.struct("eval_id", "factual", "risk", "judgement")))
    w = t.groupBy("path").agg(at(1).alias("cur"), at(2).alias("p1"), at(3).alias("p2"))
    same = ((F.col("p1.factual") == F.col("cur.factual")) & (F.col("p1.risk") == F.col("cur.risk"))
            & (F.col("p1.judgement") == F.col("cur.judgement")))
    prev = F.when(F.col("p2").isNotNull() & same, F.col("p2")).otherwise(F.col("p1"))
    w = w.withColumn("prev", prev)
    bad = ((F.col("prev.factual") - F.col("cur.factual") >= drop)
           | (F.col("cur.risk") - F.col("prev.risk") >= rise))
    return w.select("path", F.col("cur.eval_id").alias("eval_id"),
                    F.col("prev.eval_id").alias("previous"),
                    F.coalesce(bad, F.lit(False)).alias("degraded"))


# ------------------------------------------------------------------ retention and runs


def retain(rows: DataFrame, keys, order, age_ok: Column, keep: int = 500) -> DataFrame:
    """Newest ``keep`` rows per partition that are also young enough.

    Both conditions cut the tail of the same order, so the age filter goes first.
    """
    return top_per_key(rows.filter(age_ok), keys, order, keep).drop("rank")


def cooldown(history: DataFrame, as_of: Column, checked_hours: int = 168,
             unavailable_hours: int = 24) -> DataFrame:
    """State per path: recently_checked, recently_unavailable or due."""
    g = history.groupBy("path").agg(
        F.max("checked_at").alias("checked"),
        F.max(F.when(F.col("status") == "fact_check_unavailable", F.col("checked_at")))
        .alias("unavailable"))
    since = lambda h: as_of - F.make_dt_interval(hours=F.lit(h))
    return g.withColumn("state", F.when(F.col("checked") > since(checked_hours), "recently_checked")
                        .when(F.col("unavailable") > since(unavailable_hours),
                              "recently_unavailable").otherwise("due"))


def resume_states(progress: DataFrame, ok: DataFrame, posts: DataFrame,
                  rows: int | None = None) -> DataFrame:
    """done: in progress and ok; requeue: in progress but not ok; missing: never ok.

    Both lists meet the ok paths in one join. With the number of ``rows`` of the lists and of ``ok``,
    all are dealt by path into partitions of bounded size.
    """
    by_path = lambda d: d if rows is None else dealt(d, rows, "path")
    ok = by_path(ok.select("path")).distinct().withColumn("ok", F.lit(True))
    tag = lambda d, started: d.select("path", F.lit(started).alias("started"))
    listed = by_path(tag(progress, True).unionByName(tag(posts, False)))
    state = (F.when(F.col("started"), F.when(F.col("ok"), "done").otherwise("requeue"))
             .when(F.col("ok").isNull(), "missing"))
    return (listed.join(ok, "path", "left").select("path", state.alias("state"))
            .filter(F.col("state").isNotNull()))


def newest_report(posts: DataFrame, reports: DataFrame, is_new: Column) -> DataFrame:
    """Newest report per document; reports of new-document runs come first."""
    order = F.struct(F.when(F.col("is_new"), 0).otherwise(1), newest_first(reports, "checked_at"), "seq")
    best = first_per_key(reports.withColumn("is_new", is_new), ["path"], order)
    return posts.join(best, "path", "left")


def pass_audit_sample(history: DataFrame, as_of: Column, days: int = 14, skip_hours: int = 168,
                      seed: int = 42, n: int = 1) -> DataFrame:
    """Recent passes not checked lately, one by seeded hash order."""
    g = history.groupBy("path").agg(
        F.max("checked_at").alias("checked"),
        F.max(F.when(F.col("judgement") == "pass", F.col("checked_at"))).alias("passed"))
    ok = ((F.col("passed") >= as_of - F.make_dt_interval(days=F.lit(days)))
          & (F.col("checked") <= as_of - F.make_dt_interval(hours=F.lit(skip_hours))))
    return g.filter(ok).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "path"))).limit(n)


def stop_rule(rows: DataFrame, run: str, order, share: float = 0.6) -> DataFrame:
    """Where each run stops: when unavailable rows reach ceil(share x rows).

    The rows are dealt by ranges of (run, order) and stored once, with the number of their range.
    Sums per run and range, one row each, say in which range a run crosses; only the rows of those
    ranges are ranked, so no task gets more than ranges hold. ``order`` must name each row of a run.
    """
    bad = F.col("status") == "fact_check_unavailable"
    ranged = cut_lineage(rows.select(run, "eval_id", F.coalesce(bad, F.lit(False)).alias("bad"),
                                     F.struct(*order).alias("ord"))
                         .repartitionByRange(run, "ord").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy(run).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (ranged.groupBy(run, "part").agg(F.count(F.lit(1)).alias("n"), count_if(F.col("bad")).alias("u"))
             .select(run, "part", "u", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
                     F.coalesce(F.sum("u").over(before), F.lit(0)).alias("bad_before"),
                     F.sum("n").over(Window.partitionBy(run)).alias("total"))
             .withColumn("need", F.greatest(F.lit(1), F.ceil(F.col("total") * share)).cast("long")))
    crossed = parts.filter((F.col("bad_before") < F.col("need"))
                           & (F.col("bad_before") + F.col("u") >= F.col("need")))
    inside = ranged.join(crossed.select(run, "part", "rows_before", (F.col("need") - F.col("bad_before")).alias("k")),
                         [run, "part"])
    w = Window.partitionBy(run).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    stop = (inside.withColumn("place", F.count(F.lit(1)).over(w)).withColumn("nth", F.sum(F.col("bad").cast("int")).over(w))
            .filter(F.col("bad") & (F.col("nth") == F.col("k")))
            .select(run, F.col("eval_id").alias("stop_at"), (F.col("rows_before") + F.col("place")).alias("at")))
    return (parts.groupBy(run).agg(F.max("total").alias("total"), F.max("need").alias("need"))
            .join(stop, run, "left").select(
                run, "total", "need", F.col("stop_at").isNotNull().alias("stopped"), "stop_at",
                F.coalesce("at", "total").alias("processed")))


def stratified_sample(pool: DataFrame, key: str, stratum: str, length: str, n: int = 30,
                      per_stratum: int = 2, extremes: int = 2, seed: int = 42) -> DataFrame:
    """Shortest and longest items first, then a seeded fill, few per stratum."""
    p = pool.select(key, stratum, length)
    short = p.orderBy(length, key).limit(extremes).select(key, F.lit(0).alias("cls"))
    long = p.orderBy(F.desc(length), F.desc(key)).limit(extremes).select(key, F.lit(1).alias("cls"))
    must = short.unionByName(long).groupBy(key).agg(F.min("cls").alias("cls"))
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    # must holds at most 2 x extremes rows
    t = (p.join(F.broadcast(must), key, "left").withColumn("cls", F.coalesce("cls", F.lit(2)))
         .withColumn("pos", F.when(F.col("cls") < 2, F.col(length)))
         .withColumn("h", F.when(F.col("cls") == 2, h)))
    order = ["cls", "pos", "h", key]
    return (top_per_key(t, [stratum], [F.col(o) for o in order], per_stratum)
            .orderBy(*order).limit(n).select(key, stratum, length))
