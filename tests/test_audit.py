import datetime as dt
import json

from pyspark.sql import functions as F

from sitegauge.functions import common, constants as C
from sitegauge.operators import audit as au
from sitegauge.operators import queues as qu
from sitegauge.plans import QUERIES
from sitegauge.sources.readers import read_history

SCHEMA = ("path string, eval_id string, article_hash string, factual int, freshness int, "
          "citation int, risk int, judgement string, checked_at timestamp_ntz, seq long, "
          "status string")


def rec(path, h="h", factual=80, risk=20, freshness=80, citation=50, day=1, seq=0, judgement="pass"):
    return (path, f"{path}-{seq}-{day}", h, factual, freshness, citation, risk, judgement,
            dt.datetime(2024, 1, day), seq, "ok")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_pure_and_changed_groups(spark):
    g = au.rescore_groups(frame(spark, [rec("a"), rec("a", seq=1), rec("b", "x"), rec("b", "y", seq=1),
                                        rec("c")]))
    got = {r.path: (r.pure, r.hash_changed) for r in g.collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (False, False)}


def test_null_hash_is_a_value(spark):
    g = au.rescore_groups(frame(spark, [rec("a", None), rec("a", "x", seq=1), rec("b", None),
                                        rec("b", None, seq=1)]))
    assert {r.path: r.pure for r in g.collect()} == {"a": False, "b": True}


def test_flip_rate_one_of_three(spark):
    rows = [rec("a", factual=80), rec("a", factual=70, seq=1), rec("b"), rec("b", seq=1),
            rec("c"), rec("c", seq=1)]
    r = au.flip_rate(au.rescore_groups(frame(spark, rows))).collect()[0]
    assert (r.n_groups, r.flip_count, r.cause_factual, r.cause_risk) == (3, 1, 1, 0)
    assert round(r.flip_rate, 4) == 0.3333 and r.verdict == "revise gate"


def test_gate_boundaries_are_inclusive(spark):
    s = au.live_status()
    rows = [rec("a", factual=75, risk=55), rec("b", factual=70, risk=40), rec("c", factual=90, risk=60),
            rec("d", factual=90, risk=90), rec("e", citation=14)]
    got = {r.path: r.s for r in frame(spark, rows).select("path", s["status"].alias("s")).collect()}
    assert got == {"a": "pass", "b": "reject", "c": "reject", "d": "critical", "e": "reject"}


def test_gate_is_null_without_scores(spark):
    df = frame(spark, [rec("a", factual=None)])
    assert df.select(au.gate_passes(C.AUDIT_GATE).alias("g")).collect()[0].g is None


def test_majority_vote_median_and_template(spark):
    rows = [rec("a", factual=95, risk=5, seq=0), rec("a", factual=50, risk=100, seq=1),
            rec("a", factual=80, risk=30, seq=2), rec("b", factual=80, seq=0)]
    r = au.majority_vote(frame(spark, rows)).collect()
    assert [(x.path, x.factual, x.risk, x.status, x.template) for x in r] == [
        ("a", 80, 30, "pass", "a-2-1")]


def test_latest_keeps_first_seen_on_ties(spark):
    rows = [rec("a", seq=0, day=2), rec("a", seq=1, day=2), rec("a", seq=2, day=1)]
    assert au.latest(frame(spark, rows)).collect()[0].seq == 0


def test_degraded_skips_one_duplicate(spark):
    rows = [rec("a", factual=95, day=1), rec("a", factual=80, day=2), rec("a", factual=80, day=3)]
    r = au.degraded(frame(spark, rows)).collect()[0]
    assert r.previous == "a-0-1" and r.degraded


def test_spearman_with_ties_matches_pairwise_ranks(spark):
    xs = [(10, 20, 30, 90), (10, 25, 30, 80), (20, 25, 20, 70), (40, 50, 10, 10), (40, 60, 5, 5)]
    rows = [rec(f"p{i}", factual=a, freshness=b, citation=c, risk=d) for i, (a, b, c, d) in enumerate(xs)]
    got = {(r.axis1, r.axis2): r.rho for r in au.spearman(frame(spark, rows)).collect()}

    def ranks(v):
        return [sum(y < x for y in v) + (sum(y == x for y in v) + 1) / 2 for x in v]

    def corr(a, b):
        n, ma, mb = len(a), sum(a) / len(a), sum(b) / len(b)
        xy = sum((x - ma) * (y - mb) for x, y in zip(a, b))
        return xy / (sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b)) ** 0.5

    cols = list(zip(*xs))
    want = corr(ranks(cols[0]), ranks(cols[3]))
    assert abs(got[("factual", "risk")] - want) < 1e-12
    assert abs(got[("risk", "risk")] - 1) < 1e-12


def test_read_history_keeps_last_and_bad_dates(spark, tmp_path):
    lines = [{"eval_id": "1", "path": "a", "factual_score": 10, "checked_at": "2024-01-02T00:00:00Z"},
             {"eval_id": "1", "path": "a", "factual_score": 20, "checked_at": "2024-01-03T00:00:00"},
             {"path": "b", "factual_score": "NaN", "checked_at": "2020-01-01T00:00:00Z"},
             {"path": "c", "checked_at": "soon", "sources": [{"url": "u"}]}]
    f = tmp_path / "h.jsonl"
    f.write_text("\n".join(json.dumps(x) for x in lines) + "\n{broken\n")
    rows, bad = read_history(spark, str(f), since="2024-01-01")
    got = {r.path: (r.factual, r.checked_at) for r in rows.collect()}
    assert set(got) == {"a", "c"} and got["a"][0] == 20 and got["c"][1] is None
    assert [r.value for r in bad.collect()] == ["{broken"]
    everything, _ = read_history(spark, str(f))
    assert {r.path: r.factual for r in everything.collect()} == {"a": 20, "b": None, "c": None}


def test_stop_rule_equals_a_plain_scan(spark):
    import random
    rnd = random.Random(3)
    rows = [(f"r{i % 3}", dt.date(2024, 1, 1 + rnd.randrange(5)), i,
             "fact_check_unavailable" if rnd.random() < 0.4 else "ok", f"e{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "run string, day date, ord int, status string, eval_id string")
    got = {r.run: (r.stop_at, r.processed) for r in
           au.stop_rule(df, "run", ["day", "ord"], 0.2).collect()}
    for run in ("r0", "r1", "r2"):
        mine = sorted((r for r in rows if r[0] == run), key=lambda r: (r[1], r[2]))
        need, bad, want = -(-len(mine) * 2 // 10), 0, (None, len(mine))
        for n, r in enumerate(mine, 1):
            bad += r[3] != "ok"
            if bad >= need:
                want = (r[4], n)
                break
        assert got[run] == want


def test_sample_is_seeded_diverse_and_keeps_extremes(spark):
    pool = spark.createDataFrame([(i, f"t{i % 7}", i * 10) for i in range(100)],
                                 "id long, tool string, n long")
    a = au.stratified_sample(pool, "id", "tool", "n", 10).collect()
    b = au.stratified_sample(pool, "id", "tool", "n", 10).collect()
    ids = {r.id for r in a}
    assert ids == {r.id for r in b} and len(ids) == 10 and {0, 1, 98, 99} <= ids
    per = {}
    for r in a:
        per[r.tool] = per.get(r.tool, 0) + 1
    assert max(per.values()) <= 2


def test_payload_lists(spark):
    raw = json.dumps({"sources": [{"url": " u ", "type": "blog"}], "unsupported_claims": ["x"],
                      "claims": [{"text": "c1", "source_urls": ["https://a"]},
                                 {"text": "c2", "source_urls": ["nope"]}],
                      "citation_mismatches": [{"url": "u", "claimed": "a", "actual": ""},
                                              {"url": "u", "claimed": "a", "actual": "b"}]})
    df = spark.createDataFrame([(raw,)], "raw string")
    r = df.select(qu.payload_lists(F.col("raw")).alias("p")).collect()[0].p
    assert r.sources[0].source_type == "blog" and r.sources[0].url == "u"
    assert r.unsupported_claims == ["x", "c2"] and len(r.citation_mismatches) == 1


def test_payload_errors(spark):
    ok = {k: 50 for k in qu.SCORE_KEYS}
    cases = {"": "empty response", "[1]": "root is not an object", "{": "json_parse_error",
             json.dumps(ok): "", "```json\n" + json.dumps(ok) + "\n```": "",
             json.dumps({**ok, "risk_score": True}): "invalid type for risk_score",
             json.dumps({**ok, "risk_score": "61.7"}): "",
             json.dumps({**ok, "risk_score": 101}): "score out of range for risk_score",
             json.dumps({**ok, "risk_score": "high"}): "non numeric score for risk_score",
             json.dumps({"factual_score": 1}):
             "missing required keys: freshness_score, citation_coverage, risk_score"}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    for r in df.select("raw", qu.validate_payload(F.col("raw")).alias("v")).collect():
        assert r.v.error == cases[r.raw], r


def test_distinct_mismatches(spark):
    df = spark.createDataFrame(
        [("p", 1, [("u", "a"), ("", "b")]), ("p", 0, [("u", "first"), ("w", "c")])],
        "path string, seq int, citation_mismatches array<struct<url: string, claimed: string>>")
    got = {r.url: r.mismatch.claimed for r in au.distinct_mismatches(df).collect()}
    assert got == {"u": "first", "w": "c"}


def test_resume_states_keep_repeats_and_nulls(spark):
    frames = [spark.createDataFrame([(p,) for p in ps], "path string")
              for ps in (["a", "a", "b", None], ["a", "a", None], ["a", "b", "c", "c", None])]
    want = sorted([("a", "done")] * 2 + [("b", "requeue"), ("b", "missing"), ("None", "requeue"), ("None", "missing")]
                  + [("c", "missing")] * 2)
    for rows in (None, 12):
        assert sorted((str(r.path), r.state) for r in au.resume_states(*frames, rows).collect()) == want


def test_dealt_partitions_grow_with_rows(spark):
    got = [common.dealt(spark.range(3), n, "id").rdd.getNumPartitions()
           for n in (0, 50 * 2 ** 18, 1000 * 2 ** 18, 300 * 2 ** 21)]
    assert got == [spark.sparkContext.defaultParallelism, 50, 200, 300]


def test_resume_deals_every_side_by_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "PART_ROWS", 100)
    sf = "/root/testdata/sf0.001"
    rows = [spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("lineitem", "orders")]
    df = QUERIES["j12_resume"](spark, sf)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Aggregate [eval_id") == 1
    parts = [-(-n // 100) for n in (rows[0], sum(rows))]
    assert [plan.count(f"RepartitionByExpression [{k}") for k in ("eval_id", "path")] == [1, 2]
    assert df.rdd.getNumPartitions() == parts[1] and f", {parts[0]}\n" in plan
    most = df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0]
    assert most < 4 * 100
