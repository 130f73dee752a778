"""Costly expressions stand once in a plan, however often their value is used."""

import datetime as dt

from pyspark.sql import functions as F

from sitegauge.operators import corpus as co


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


NOTE = "```\nx\n```\n## Editor's Note\nhttps://a.example/b\n## Next\nrest"


def test_note_rules_mask_code_once(spark):
    df = spark.createDataFrame([(NOTE,), (None,), ("plain",)], "body string")
    got = df.select(F.concat(co.rule_e1(), co.rule_e2()).alias("i"))
    assert plan(got).count("zip_with") == 2  # one section per rule
    assert [len(r.i) if r.i is not None else None for r in got.collect()][0] == 0


def test_note_reason_masks_code_once(spark):
    df = spark.createDataFrame([(NOTE,), (None,), ("plain",)], "body string")
    got = df.select(co.invalid_note_reason().alias("r"))
    assert plan(got).count("zip_with") == 1
    assert [r.r for r in got.collect()] == ["too short", None, None]


def test_payload_is_parsed_once(spark):
    from sitegauge.operators.queues import validate_payload
    df = spark.createDataFrame([('```json\n{"k": 7}\n```',), ("{",), ("",), (None,)], "raw string")
    got = df.select(validate_payload(F.col("raw"), ("k",)).alias("v")).select("v.status", "v.error", "v.scores")
    assert plan(got).count("get_json_object") == 1
    assert [(r.status, r.error, r.scores) for r in got.collect()] == [
        ("ok", "", {"k": 7}), ("invalid_json", "json_parse_error", None),
        ("invalid_json", "empty response", None), ("invalid_json", "json_parse_error", None)]


def test_heuristic_scores_test_the_body_once(spark):
    from sitegauge.plans import QUERIES
    text = plan(QUERIES["g06_heuristic_scores"](spark, "/root/testdata/sf0.001"))
    assert [text.count(w) for w in ("kubernetes", "chmod", "never")] == [1, 1, 1]


def test_bundles_hold_whole_documents(spark, tmp_path):
    from sitegauge.sources import readers as rd
    texts = ["---\nid: a\ntags: [x]\n---\none\ntwo\n", "", "end \x1e mark \x1f0 \x1f1 \x1f\n\n", "last"]
    df = spark.createDataFrame([(t,) for t in texts], "page string").coalesce(1)
    rd.write_bundles(df, "page", str(tmp_path / "c"))
    got = rd.read_corpus(spark, str(tmp_path / "c"), bundles=True)
    assert sorted(r.body for r in got.collect()) == sorted(["one\ntwo\n", *texts[1:]])
    assert got.select("path").distinct().count() == 1


def test_history_lines_are_parsed_once(spark, tmp_path):
    from sitegauge.sources import readers as rd
    spark.createDataFrame([('{"eval_id": "e", "path": "p", "factual_score": 5}',), ('{"eval_id',)], "value string").write.text(
        str(tmp_path / "h"))
    rows, bad = rd.read_history(spark, str(tmp_path / "h"))
    kept = rows.filter("eval_id is not null")
    assert plan(kept).count("from_json") == 2  # rows with an id, and those without
    assert [(r.eval_id, r.factual) for r in kept.collect()] == [("e", 5)] and bad.count() == 1


def test_term_links_are_taken_out_once(spark):
    from sitegauge.plans import QUERIES
    text = plan(QUERIES["t23_term_links"](spark, "/root/testdata/sf0.001"))
    assert "arrays_zip" not in text and text.count("regexp_extract_all") == 1


def test_history_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """Lines of text took 13 times the room of their rows; files keep the order of the events."""
    from sitegauge.plans import markdown as md

    rows = [(o, n, 10 * o + n, o, float(n), 0.01 * n, 0.02, 1000.0 + i, "A", "F", dt.datetime(1995, 1, 1 + i))
            for i, (o, n) in enumerate([(1, 1), (1, 2), (2, 1), (1, 1), (2, 1), (1, 2), (3, 7)])]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_discount double, l_tax double, l_extendedprice double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(md, "new_folder", lambda *_: str(tmp_path / "out"))
    monkeypatch.setattr(md, "FILE_LINES", 2)
    got = md.s02_files(spark, str(tmp_path)).collect()
    files = sorted(p.name for p in (tmp_path / "out").glob("part-*"))
    assert len(files) > 3 and all(f.endswith(".gz") for f in files)
    assert sorted((r.eval_id, r.day) for r in got if r.eval_id) == [
        ("1-1", "1995-01-04"), ("1-2", "1995-01-06"), ("2-1", "1995-01-05"), ("3-7", "1995-01-07")]
    assert [r.bad for r in got if r.eval_id is None] == [0]
