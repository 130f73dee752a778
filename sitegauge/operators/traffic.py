"""Web analytics: reports, shares, noise filtering, engagement and period changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import (any_of, as_col, between_days, count_if, lag_ranges, ratio,
                                top_per_key)

# ------------------------------------------------------------------ S05 report


def metric_value(col) -> Column:
    """A metric read as text: unparseable values count as zero."""
    return F.coalesce(as_col(col).try_cast("double"), F.lit(0.0))


def report(events: DataFrame, dims, metrics: dict[str, Column], *, start=None, end=None,
           day="day", filters=(), order_by=(), limit: int | None = None,
           rollup: bool = False) -> DataFrame:
    """Dimension x metric report over an inclusive date range.

    ``filters`` holds ``(dimension, "EXACT" | "CONTAINS", value)`` triples;
    ``limit`` with ``order_by`` becomes a top-k plan.
    """
    if start is not None and end is not None:
        events = events.filter(between_days(day, start, end))
    for dim, kind, value in filters:
        c = F.col(dim)
        events = events.filter(c == value if kind == "EXACT" else c.contains(value))
    grouped = events.rollup(*dims) if rollup else events.groupBy(*dims)
    out = grouped.agg(*[m.alias(name) for name, m in metrics.items()])
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(limit) if limit is not None else out


def page_metrics(facts: DataFrame, key="page") -> DataFrame:
    """Search-console metrics per key: impressions, clicks, ctr, position."""
    clicks = count_if(F.col("event_type") == "click")
    return facts.groupBy(key).agg(
        F.count(F.lit(1)).alias("impressions"), clicks.alias("clicks"),
        (clicks / F.count(F.lit(1))).alias("ctr"), (F.avg("value") / 4).alias("position"))


# -------------------------------------------------------------- F01-F03, F09


def host_filter(facts: DataFrame, primary: str) -> DataFrame:
    """Rows of the primary host; keep the unfiltered input for host_shares."""
    return facts.filter(F.col("host").contains(primary))


def page_filter(pages: DataFrame, part: str = "/posts/", min_views: int = 10,
                views: str = "views") -> DataFrame:
    return pages.filter(F.col("page").contains(part) & (F.col(views) >= min_views))


def noise_condition(df: DataFrame, countries, min_seconds: float = 5.0,
                    country: str = "country", seconds: str = "seconds") -> Column:
    """True for noise rows; no country list or a missing column means no noise."""
    if not countries or country not in df.columns or seconds not in df.columns:
        return F.lit(False)
    return (F.coalesce(F.col(country), F.lit("")).isin(*countries)
            & (F.coalesce(F.col(seconds), F.lit(0.0)) < min_seconds))


def drop_noise(df: DataFrame, countries, min_seconds: float = 5.0):
    """(rows kept, dropped rows and users per country)."""
    noise = noise_condition(df, countries, min_seconds)
    dropped = (df.filter(noise).groupBy("country")
               .agg(F.count(F.lit(1)).alias("rows"), F.sum("users").cast("long").alias("users")))
    return df.filter(~noise), dropped


def tag_period(facts: DataFrame, run_date: str, lag: int = 3, days: int = 7) -> DataFrame:
    """Keep the lagged reporting range and its predecessor, tagged by period."""
    s, e, ps, pe = lag_ranges(run_date, lag, days)
    return (facts.filter(between_days("day", ps, e))
            .withColumn("period", F.when(between_days("day", s, e), "current")
                        .otherwise("previous")))


def reference_only(previous_start: Column, launch_dates) -> Column:
    """True when a comparison month begins before the latest measurement start."""
    starts = [F.lit(d).cast("date") for d in launch_dates if d]
    if not starts:
        return F.lit(False)
    start = starts[0] if len(starts) == 1 else F.greatest(*starts)
    return previous_start < start


# ------------------------------------------------------------ A01-A05, A35, J01


def vote_pivot(facts: DataFrame, title: str, status: Column, weight: Column) -> DataFrame:
    """yes / no per title; an unknown status counts as no, blank titles drop."""
    t = F.trim(F.col(title))
    yes = status == "yes"
    return (facts.filter(t != "").groupBy(t.alias("title"))
            .agg(F.coalesce(F.sum(F.when(yes, weight)), F.lit(0)).cast("long").alias("yes"),
                 F.coalesce(F.sum(F.when(~yes, weight)), F.lit(0)).cast("long").alias("no")))


def votes_with_engagement(votes: DataFrame, engagement: DataFrame) -> DataFrame:
    """Left join on trimmed title; a repeated title keeps its last row, missing is 0 s."""
    eng = (engagement.filter(F.trim("title") != "").groupBy(F.trim("title").alias("title"))
           .agg(F.max_by("seconds", "ord").alias("engagement_sec")))
    return (votes.join(eng, "title", "left")
            .withColumn("engagement_sec", F.coalesce("engagement_sec", F.lit(0.0))))


def vote_priority(df: DataFrame, min_no: int = 3, min_ratio: float = 0.5,
                  instant_bounce: float = 30.0, critical: float = 1.0) -> DataFrame:
    """Feedback priority: share of no votes raised by short engagement."""
    no_ratio = ratio("no", F.col("yes") + F.col("no"))
    bounce = F.greatest(F.lit(0.0), 1 - F.col("engagement_sec") / instant_bounce)
    score = (F.when((F.col("no") < min_no) & (no_ratio < min_ratio), 0.0)
             .otherwise(no_ratio * (1 + bounce)))
    return (df.withColumn("no_ratio", no_ratio).withColumn("priority_score", score)
            .filter(F.col("priority_score") > 0)
            .withColumn("critical", F.col("priority_score") >= critical))


def sessions() -> Column:
    """Sessions as distinct user-days."""
    return F.countDistinct("user_id", "day")


def traffic_summary(facts: DataFrame, group: str | None = None, *, organic: str = "Organic Search",
                    direct: str = "Direct", home_country: str = "",
                    error_events: str = "error") -> DataFrame:
    """Traffic totals: channel sessions, ratios and error-event count per group.

    Sessions are distinct user-days. Shares are taken of the sum over channels, and of the users
    summed over countries, as a user-day with two channels is a session of both. Rows are first
    reduced to one per (group, channel, country, user, day), before any shuffle by group.
    """
    keys = [group] if group else []
    channel, country = (F.coalesce(c, F.lit("")) for c in ("channel", "country"))
    rows = facts.groupBy(*keys, channel.alias("channel"), country.alias("country"), "user_id", "day").agg(
        F.count(F.lit(1)).alias("views"),
        count_if(F.lower("event_type").rlike(error_events)).alias("errors"))

    def user_days(cond):
        return F.countDistinct(F.when(cond, F.struct("user_id", "day")))

    return rows.groupBy(*keys).agg(
        F.countDistinct("user_id").alias("active_users"),
        F.countDistinct("user_id", "day").alias("sessions"),
        F.countDistinct("channel", "user_id", "day").alias("channel_sessions"),
        F.countDistinct("country", "user_id").alias("country_users"),
        F.sum("views").cast("long").alias("page_views"),
        user_days(F.col("channel") == organic).alias("organic_sessions"),
        user_days(F.lower("channel") == direct.lower()).alias("direct_sessions"),
        F.countDistinct(F.when(F.col("country") == home_country, F.col("user_id")))
        .alias("home_users"),
        F.sum("errors").cast("long").alias("js_errors"),
    ).select(
        *keys, "active_users", "sessions", "organic_sessions", "direct_sessions",
        ratio("organic_sessions", "channel_sessions").alias("organic_ratio"),
        ratio("home_users", "country_users").alias("home_ratio"),
        ratio("page_views", "sessions").alias("pv_per_session"), "js_errors")


def host_shares(facts: DataFrame, primary: str) -> DataFrame:
    """Views, users and sessions per host with share of the total, largest first."""
    per_host = facts.groupBy("host").agg(
        F.count(F.lit(1)).alias("pv"), F.countDistinct("user_id").alias("uu"),
        sessions().alias("sessions"))
    totals = per_host.agg(F.sum("pv").alias("tpv"), F.sum("uu").alias("tuu"),
                          F.sum(F.when(F.col("host").contains(primary), F.col("pv"))
                                .otherwise(0)).alias("ppv"))
    # totals is one row by construction
    return per_host.join(F.broadcast(totals)).select(
        "host", "pv", "uu", "sessions", ratio("pv", "tpv").alias("pv_share"),
        ratio("uu", "tuu").alias("uu_share"), ratio("ppv", "tpv").alias("primary_share"))


def bounce() -> Column:
    return F.avg(F.when(F.col("value") < 10, 1.0).otherwise(0.0))


def country_table(facts: DataFrame, top: int = 10, min_seconds: float = 10.0,
                  max_bounce: float = 0.9) -> DataFrame:
    """Largest countries by users with a flag for short or bouncing traffic."""
    t = facts.groupBy("country").agg(
        sessions().alias("sessions"), F.countDistinct("user_id").alias("users"),
        F.avg("seconds").alias("avg_seconds"), bounce().alias("bounce_rate"))
    flag = (F.col("avg_seconds") < min_seconds) | (F.col("bounce_rate") > max_bounce)
    return t.withColumn("flag", flag).orderBy(F.desc("users"), "country").limit(top)


def daily_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy("day").agg(
        F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("views"))


def channel_engagement(facts: DataFrame, bot_channel: str = "Direct",
                       min_seconds: float = 10.0) -> DataFrame:
    t = facts.groupBy("channel").agg(
        F.countDistinct("user_id").alias("users"), sessions().alias("sessions"),
        F.avg("seconds").alias("avg_seconds"))
    return t.withColumn("suspected_bot", (F.col("channel") == bot_channel)
                        & (F.col("avg_seconds") < min_seconds))


# --------------------------------------------------- W05, G12, G13, G15, W06, W11

# kind of each compared metric; only "number" has a percentage change
CHANGE_KINDS = {
    "impressions": "number", "clicks": "number", "ctr": "rate", "position": "position",
    "active_users": "number", "sessions": "number", "organic_sessions": "number",
    "direct_sessions": "number", "home_ratio": "ratio", "pv_per_session": "number",
    "bounce_rate": "rate",
}


def period_change(current: Column, previous: Column, kind: Column) -> dict[str, Column]:
    """Delta and percentage change; rates, ratios and positions have no percentage."""
    cur, prev = F.coalesce(current, F.lit(0.0)), F.coalesce(previous, F.lit(0.0))
    pct = F.when(kind.isin("rate", "ratio", "position") | (prev == 0), F.lit(None)
                 .cast("double")).otherwise((cur - prev) / prev)
    return {"current": cur, "previous": prev, "current_exists": current.isNotNull(),
            "previous_exists": previous.isNotNull(), "delta": cur - prev, "pct_change": pct}


def compare_periods(long: DataFrame, keys=()) -> DataFrame:
    """(keys, metric, kind, period, value) rows to one change row per metric."""
    agg = long.groupBy(*keys, "metric", "kind").agg(
        F.max(F.when(F.col("period") == "current", F.col("value"))).alias("c"),
        F.max(F.when(F.col("period") == "previous", F.col("value"))).alias("p"))
    cols = period_change(F.col("c"), F.col("p"), F.col("kind"))
    return agg.select(*keys, "metric", "kind", *[c.alias(n) for n, c in cols.items()])


def unpivot_metrics(wide: DataFrame, keys, metrics) -> DataFrame:
    """Wide metric columns to (keys, metric, value, kind) rows."""
    long = wide.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(keys), list(metrics), "metric", "value")
    kind = F.create_map(*[F.lit(x) for m in metrics for x in (m, CHANGE_KINDS[m])])
    return long.withColumn("kind", kind[F.col("metric")])


def wide_changes(changes: DataFrame, keys=()) -> DataFrame:
    """Change rows back to one row per key: <metric>_pct, <metric>_delta, ..."""
    def pick(metric, col):
        return F.max(F.when(F.col("metric") == metric, F.col(col)))

    metrics = ["impressions", "clicks", "ctr", "position", "organic_sessions", "sessions"]
    return changes.groupBy(*keys).agg(
        *[pick(m, "pct_change").alias(f"{m}_pct") for m in metrics],
        *[pick(m, "delta").alias(f"{m}_delta") for m in metrics],
        pick("position", "previous_exists").alias("position_previous_exists"),
        pick("home_ratio", "current").alias("home_ratio"))


def weekly_alerts(drop: float = -0.5, position_rise: float = 10.0) -> Column:
    """Names of the weekly anomalies that fired."""
    return F.array_compact(F.array(
        F.when(F.col("impressions_pct") <= drop, "impressions"),
        F.when(F.col("clicks_pct") <= drop, "clicks"),
        F.when(F.coalesce("position_previous_exists", F.lit(True))
               & (F.col("position_delta") >= position_rise), "position"),
        F.when(F.col("organic_sessions_pct") <= drop, "organic")))


def weekly_judgement(step: float = 0.1, organic_drop: float = -0.25) -> Column:
    imp, pos = F.col("impressions_pct"), F.col("position_delta")
    return (F.when((imp <= -step) & (pos >= 1), "impressions and position worse")
            .when((imp <= -step) & (F.col("ctr_delta") > 0), "fewer impressions, better ctr")
            .when((imp >= step) & (pos <= -1), "impressions and position better")
            .when(F.col("organic_sessions_pct") <= organic_drop, "organic sessions down")
            .otherwise("no large change"))


def monthly_alerts(reference_only: Column, foreign_share: Column, home_ratio: Column) -> Column:
    """Monthly anomalies; period comparisons are suppressed for partial months."""
    use = ~reference_only
    return F.array_compact(F.array(
        F.when(use & (F.col("impressions_pct") <= -0.5), "impressions"),
        F.when(use & (F.col("clicks_pct") <= -0.5), "clicks"),
        F.when(use & F.coalesce("position_previous_exists", F.lit(True))
               & (F.col("position_delta") >= 10), "position"),
        F.when(use & (F.col("organic_sessions_pct") <= -0.5), "organic"),
        F.when(use & (F.col("sessions_pct") <= -0.5), "sessions"),
        F.when(foreign_share >= 0.9, "foreign host share"),
        F.when(home_ratio < 0.3, "home country ratio")))


def monthly_judgement(reference_only: Column, improved: Column = None,
                      worsened: Column = None) -> Column:
    def flag(c):
        return F.coalesce(c, F.lit(False))

    imp, clk, org = (F.col(f"{m}_pct") for m in ("impressions", "clicks", "organic_sessions"))
    pos, ctr = F.col("position_delta"), F.col("ctr_delta")
    imp_up, imp_down = flag(imp >= 0.2), flag(imp <= -0.2)
    clk_up, clk_down = flag(clk >= 0.2), flag(clk <= -0.2)
    org_up, org_down = flag(org >= 0.2), flag(org <= -0.2)
    better, worse = flag(pos <= -3), flag(pos >= 3)
    good = imp_up | clk_up | better | org_up
    bad = imp_down | clk_down | worse | org_down
    improved = F.lit(0) if improved is None else improved
    worsened = F.lit(0) if worsened is None else worsened
    return (F.when(reference_only, "partial month, no judgement")
            .when(imp_down & flag(ctr > 0), "less traffic, better ctr")
            .when((imp_up | clk_up | org_up) & worse, "more traffic, worse position")
            .when(clk_up & org_down, "more clicks, less organic")
            .when(good & ~bad, "improving").when(bad & ~good, "worsening")
            .when(good & bad, "mixed")
            .when((improved > worsened) & (improved > 0), "rewrites improving")
            .otherwise("no large change"))


def status_signal(value: Column, good: float, bad: float, lower_is_better: bool = False) -> Column:
    if lower_is_better:
        return F.when(value <= good, "good").when(value >= bad, "bad").otherwise("watch")
    return F.when(value >= good, "good").when(value <= bad, "bad").otherwise("watch")


def trend(history: DataFrame, keys, period: str, keep: int = 8, newest: int = 4,
          step: float = 0.1, rank_step: float = 1.0) -> DataFrame:
    """Direction over the newest ``newest`` of the last ``keep`` periods per key."""
    recent = top_per_key(history, keys, [F.desc(period)], keep)
    at = lambda i, c: F.max(F.when(F.col("rank") == i, F.col(c)))
    agg = recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("periods"),
        at(1, "impressions").alias("li"), at(newest, "impressions").alias("fi"),
        at(1, "position").alias("lp"), at(newest, "position").alias("fp"))
    imp = F.try_divide(F.col("li") - F.col("fi"), F.col("fi"))
    pos = F.col("lp") - F.col("fp")
    label = (F.when((F.col("periods") < newest) | imp.isNull(), "insufficient")
             .when((imp >= step) & (pos <= -rank_step), "up")
             .when((imp <= -step) & (pos >= rank_step), "down").otherwise("flat"))
    return agg.select(*keys, "periods", label.alias("trend"))


def keep_history(current: DataFrame, past: DataFrame, period: str, limit: int = 6) -> DataFrame:
    """Newest ``limit`` periods; a current row replaces a past row of its period."""
    past = past.join(current.select(period), period, "left_anti")
    return (current.unionByName(past).orderBy(F.desc(period)).limit(limit))


def backfill_weekly(facts: DataFrame, run_dates: DataFrame, lag: int = 3, days: int = 7) -> DataFrame:
    """Recompute the weekly page report for a list of run dates.

    Each fact belongs to at most ``days`` run dates per calendar week, so the
    range join is written as an equi-join: facts are first rolled up to one row
    per day, and each run date lists its days.
    """
    per_day = facts.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("event_type") == "click").alias("c"),
        F.sum("value").alias("v"))
    span = run_dates.select("run_date", F.explode(F.sequence(
        F.date_sub("run_date", lag + days - 1), F.date_sub("run_date", lag))).alias("day"))
    return (span.join(per_day, "day").groupBy("run_date").agg(
        F.sum("n").cast("long").alias("impressions"), F.sum("c").cast("long").alias("clicks"),
        ratio(F.sum("c"), F.sum("n")).alias("ctr"),
        (F.sum("v") / F.sum("n") / 4).alias("position")))


def matching_events(facts: DataFrame, pattern) -> DataFrame:
    """Event counts for names matching a pattern (case-insensitive)."""
    pat = pattern if isinstance(pattern, str) else any_of(pattern)
    return facts.filter(F.col("event_type").rlike("(?i)" + pat))
