import datetime as dt

from pyspark.sql import functions as F

from sitegauge.functions import text as tx
from sitegauge.functions.common import lag_ranges
from sitegauge.operators import search as se
from sitegauge.operators import selection as sel
from sitegauge.operators import traffic as tr


def one(df):
    return df.collect()[0]


def test_lagged_ranges():
    s, e, ps, pe = lag_ranges("2024-01-31")
    assert (str(s), str(e), str(ps), str(pe)) == (
        "2024-01-22", "2024-01-28", "2024-01-15", "2024-01-21")


def test_period_change(spark):
    rows = [("a", "number", "current", 80.0), ("a", "number", "previous", 100.0),
            ("b", "number", "current", 10.0), ("b", "number", "previous", 0.0),
            ("c", "number", "current", 10.0),
            ("d", "position", "current", 43.9), ("d", "position", "previous", 19.0)]
    df = spark.createDataFrame(rows, "metric string, kind string, period string, value double")
    got = {r.metric: r for r in tr.compare_periods(df).collect()}
    assert abs(got["a"].pct_change + 0.2) < 1e-12
    assert got["b"].pct_change is None and got["b"].previous_exists
    assert not got["c"].previous_exists
    assert abs(got["d"].delta - 24.9) < 1e-9 and got["d"].pct_change is None


def test_weekly_alerts_all_four(spark):
    rows = [("impressions", "number", 388.0, 2304.0), ("clicks", "number", 6.0, 20.0),
            ("position", "position", 43.9, 19.0), ("organic_sessions", "number", 10.0, 30.0)]
    long = [(m, k, p, v) for m, k, c, q in rows for p, v in (("current", c), ("previous", q))]
    df = spark.createDataFrame(long, "metric string, kind string, period string, value double")
    w = tr.wide_changes(tr.compare_periods(df))
    assert one(w.select(tr.weekly_alerts().alias("a"))).a == [
        "impressions", "clicks", "position", "organic"]


def test_priority_classes(spark):
    df = spark.createDataFrame([(20, 0.0, 10.0), (20, 0.02, 25.0), (5, 0.04, 40.0)],
                               "impressions int, ctr double, position double")
    assert [r.p for r in df.select(se.priority_class().alias("p")).collect()] == ["A", "B", "C"]


def gap(spark, queries):
    df = spark.createDataFrame(list(enumerate(queries)), "ord int, query string")
    return [r.query for r in se.gap_queries(df, ["ord"]).orderBy("ord").collect()]


def test_gap_queries_drop_code_and_repeats(spark):
    assert gap(spark, ["apiが過負荷状態です。", "apiが過負荷状態です",
                       "const sellingpartnerapi = require('amazon-sp-api')", "cliとは",
                       "github api 403 forbidden"]) == [
        "apiが過負荷状態です。", "github api 403 forbidden"]


def test_gap_queries_keep_short_terms(spark):
    assert gap(spark, ["+429", "429+", "401エラー", "bashとは", "docker compose",
                       "the model returned the following errors: data retention mode"]) == [
        "401エラー", "bashとは", "docker compose"]


def test_full_width_query_is_normalized(spark):
    df = spark.createDataFrame([("ＨＴＴＰ　４０４！",)], "q string")
    assert one(df.select(tx.normalize_query("q").alias("k"))).k == "http 404"


def verdict(spark, row, as_of):
    df = spark.createDataFrame([row], "rewrite_date date, before_impressions long, "
                               "after_impressions long, before_clicks long, after_clicks long, "
                               "before_position double, after_position double")
    v = sel.rewrite_verdict(F.lit(as_of).cast("date"))
    return one(df.select(v["verdict"].alias("v"), v["reason"].alias("r")))


def test_rewrite_verdicts(spark):
    day = dt.date(2026, 6, 1)
    assert verdict(spark, (day, 10, 10, None, None, 20.0, 16.5), "2026-07-01").v == "improved"
    assert verdict(spark, (day, 10, 7, None, None, 10.0, 14.0), "2026-07-01").v == "worse"
    assert verdict(spark, (day, 10, 7, None, None, 10.0, 12.0), "2026-07-01").v == "unchanged"
    assert verdict(spark, (day, 0, 50, 0, 9, 20.0, 1.0), "2026-07-01").v == "unchanged"
    assert verdict(spark, (dt.date(2026, 7, 1), 1, 1, 1, 1, 1.0, 1.0), "2026-07-10").r == "too early"


def test_rename_counts_as_modified(spark):
    p = "content/posts/{}.md".format
    rows = [("R100", None, p("a"), p("b"), None, None), ("A", p("n"), None, None, None, None),
            ("M", p("n"), None, None, None, None), ("M", p("x"), None, None, True, False),
            ("M", p("y"), None, None, False, True), ("D", "static/z.md", None, None, None, None)]
    df = spark.createDataFrame(rows, "status string, path string, old_path string, "
                               "new_path string, old_draft boolean, new_draft boolean")
    r = one(sel.change_rollup(df))
    assert (r.added, r.modified, r.unpublished, r.renamed_from, r.renamed_to) == (2, 1, 1, 1, 1)


def test_unknown_vote_counts_as_no_and_blank_titles_drop(spark):
    df = spark.createDataFrame([("t", "yes", 2), (" t ", "no", 1), ("t", "maybe", 1), (" ", "no", 9)],
                               "title string, status string, n int")
    r = tr.vote_pivot(df, "title", F.col("status"), F.col("n")).collect()
    assert [(x.title, x.yes, x.no) for x in r] == [("t", 2, 2)]


def test_noise_filter_without_countries_is_a_no_op(spark):
    df = spark.createDataFrame([("A", 1.0, 3), ("B", 1.0, 1)], "country string, seconds double, users int")
    assert tr.drop_noise(df, [])[0].count() == 2
    kept, dropped = tr.drop_noise(df, ["A"])
    assert kept.count() == 1 and one(dropped).users == 3
    assert tr.drop_noise(df.drop("seconds"), ["A"])[0].count() == 2


def test_monthly_alerts_are_suppressed_for_partial_months(spark):
    df = spark.createDataFrame([(-0.9, -0.9, 12.0, -0.9, -0.9, True)],
                               "impressions_pct double, clicks_pct double, position_delta double, "
                               "organic_sessions_pct double, sessions_pct double, "
                               "position_previous_exists boolean")
    a = lambda ref: one(df.select(tr.monthly_alerts(
        F.lit(ref), F.lit(0.95), F.lit(0.2)).alias("a"))).a
    assert len(a(False)) == 7
    assert a(True) == ["foreign host share", "home country ratio"]


def test_slots_stop_inspecting_when_full(spark):
    today = spark.range(1)
    pending = spark.createDataFrame([(1, 1, True), (2, 2, False), (3, 3, False), (4, 4, True)],
                                    "key long, ord long, bad boolean")
    queue = spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "key long, ord long")

    def run(quota):
        return {r.key: r.outcome for r in sel.allocate_slots(today, pending, queue, quota).collect()}

    assert run(2) == {1: "dropped", 2: "published", 3: "pending", 4: "pending"}
    assert run(4) == {1: "dropped", 2: "published", 3: "published", 4: "dropped",
                      10: "published", 11: "pending", 12: "pending"}
    assert run(1) == {1: "pending", 2: "pending", 3: "pending", 4: "pending"}


def test_sessions_of_a_user_on_two_channels_in_a_day(spark):
    rows = [(1, "2024-01-01", "Organic Search", "A", "view"), (1, "2024-01-01", "Direct", "B", "view"),
            (1, "2024-01-02", "Direct", "A", "error"), (2, "2024-01-01", None, None, "view")]
    facts = spark.createDataFrame(rows, "user_id long, day string, channel string, country string, event_type string")
    t = tr.traffic_summary(facts, home_country="A").first()
    assert (t.active_users, t.sessions, t.organic_sessions, t.direct_sessions, t.js_errors) == (2, 3, 1, 2, 1)
    # channel sessions 1 + 2 + 1, users over countries 1 + 1 + 1
    assert t.organic_ratio == 0.25 and abs(t.home_ratio - 1 / 3) < 1e-12 and abs(t.pv_per_session - 4 / 3) < 1e-12
