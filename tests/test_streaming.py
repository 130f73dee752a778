import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitegauge.operators import linking as li
from sitegauge.operators import queues as qu
from sitegauge.plans.feeds import shape_entries
from sitegauge.session import new_folder
from sitegauge.sources import readers as rd
from sitegauge.sources import sinks
from sitegauge.streaming import feeds as fd

SF = "/root/testdata/sf0.001/events.parquet"


def split_events(spark):
    """The events in time order as several files."""
    src = spark.read.parquet(SF)
    folder = new_folder(spark, "events")
    cuts = ["2024-01-01", "2024-01-08", "2024-01-20", "2024-02-10"]
    for a, b in zip(cuts, cuts[1:]):
        part = src.filter((F.col("ts") >= F.lit(a).cast("timestamp_ntz"))
                          & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(folder)
    return src, folder


def stream(spark, src, folder):
    s = fd.read_stream(spark, folder, src.schema, 1)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def put(spark, folder, rows, schema):
    """One more file of a stream; later files are processed later."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def flags_of(spark, folder):
    return fd.read_stream(spark, folder, fd.FLAGS, 1)


def test_incidents_end_by_timer_over_batches_and_restarts(spark):
    folder, out = new_folder(spark, "flags"), new_folder(spark, "incidents")

    def run():
        fd.run_incidents(flags_of(spark, folder), out, 24, "1 hour")
        log = spark.read.schema(fd.CHANGES).parquet(f"{out}/log")
        return (sorted((r.event, r.service, r.title) for r in log.collect()),
                {(r.service, r.title) for r in fd.open_incidents(log).collect()})

    put(spark, folder, [("A", at(1), "a1", ["X"]), ("B", at(1, 1), "b1", []), ("C", at(1, 2), "c1", None),
                        ("A", at(1), "a0", [])], fd.FLAGS)
    log, opened = run()
    assert log == [("raise", "A", "a1"), ("raise", "B", "b1"), ("raise", "C", "c1")]
    put(spark, folder, [("A", at(1, 10), "a2", ["Y"]), ("D", at(1, 9), "d1", []), ("B", at(1, 1), "b0", [])], fd.FLAGS)
    log, opened = run()
    assert opened == {("A", "a2"), ("B", "b1"), ("C", "c1"), ("D", "d1")}
    assert run() == (log, opened)  # nothing new after a restart
    put(spark, folder, [("E", at(2, 3), "e1", [])], fd.FLAGS)  # event time 02:00: B and C are over
    log, opened = run()
    assert opened == {("A", "a2"), ("D", "d1"), ("E", "e1")}
    assert [x for x in log if x[0] == "end"] == [("end", "B", "b1"), ("end", "C", "c1")]
    put(spark, folder, [("B", at(1, 20), "late", []), ("E", at(2, 4), "e2", [])], fd.FLAGS)
    put(spark, folder, [("F", at(9), "f1", [])], fd.FLAGS)
    log, opened = run()
    assert opened == {("F", "f1")}
    assert ("end", "E", "e2") in log and ("end", "E", "e1") not in log and ("raise", "B", "late") not in log
    assert len(log) == len(set(log))


def test_a_replayed_batch_notifies_nobody_twice(spark):
    folder, out = new_folder(spark, "pages"), new_folder(spark, "notify")
    schema, sent, fail = "page_id long, url string", [], [True]

    def send(rows):
        sent.append(sorted(r.url for r in rows.collect()))
        if len(sent) == 2 and fail:
            fail.clear()
            raise RuntimeError("mail server")

    def run():
        fd.run_notify(fd.read_stream(spark, folder, schema, 1), out, ["page_id"], send)

    put(spark, folder, [(1, "a"), (2, "b"), (3, "a")], schema)
    run()
    put(spark, folder, [(4, "b"), (5, "c"), (6, "d")], schema)
    put(spark, folder, [(7, "d"), (8, "e"), (9, "a")], schema)
    with pytest.raises(Exception, match="mail server"):
        run()
    run()
    assert sent == [["a", "b"], ["c", "d"], ["c", "d"], ["e"]]  # the failed batch again, with the same rows
    log = fd.read_epochs(spark, f"{out}/notified", schema).collect()
    assert sorted((r.url, r.page_id, r.epoch) for r in log) == [
        ("a", 1, 0), ("b", 2, 0), ("c", 5, 1), ("d", 6, 1), ("e", 8, 2)]


def test_flags_are_applied_and_cleared_over_batches(spark):
    folder, out = new_folder(spark, "flags"), new_folder(spark, "changes")
    articles = spark.createDataFrame(
        [(1, "GitHub API", [], False), (2, "Docker", [], True), (3, "", ["Region"], False), (4, "AWS", [], False)],
        "id long, service string, components array<string>, flagged boolean")

    def run():
        fd.run_flags(flags_of(spark, folder), articles, "id", out, li.match_incidents, 24)
        log = fd.read_epochs(spark, f"{out}/changes", "id long, change string")
        state = fd.flag_state(articles, log, "id").collect()
        return (sorted((r.epoch, r.id, r.change) for r in log.collect()), {r.id for r in state if r.flagged})

    put(spark, folder, [("GitHub", at(1), "g", ["Region"])], fd.FLAGS)
    first = [(0, 1, "apply"), (0, 2, "clear"), (0, 3, "apply")]
    assert run() == (first, {1, 3})
    put(spark, folder, [("Docker", at(1, 12), "d", [])], fd.FLAGS)
    assert run() == (first + [(1, 2, "apply")], {1, 2, 3})
    put(spark, folder, [("AWS", at(2, 6), "w", []), ("GitHub", at(1, 1), "old", [])], fd.FLAGS)
    log, flagged = run()  # GitHub's flag ended at 01:00 of the second day
    assert flagged == {2, 4} and log[4:] == [(2, 1, "clear"), (2, 3, "clear"), (2, 4, "apply")]
    assert run() == (log, flagged)


def test_ids_that_leave_the_state_come_back(spark):
    """Seen ids are marked with the batch that emits them, and forgotten after ``keep``."""
    folder, out = new_folder(spark, "entries"), new_folder(spark, "seen")
    schema = "id string, ts timestamp"
    days = [[("x", at(1)), ("y", at(1)), ("x", at(1, 2))], [("x", at(2)), ("z", at(2))],
            [("w", at(20)), ("y", at(20))], [("x", at(21)), ("w", at(21))], [("x", at(22)), ("y", at(22))]]
    got = []
    for rows in days:
        put(spark, folder, rows, schema)
        stream_ = fd.dedupe_stream(fd.read_stream(spark, folder, schema, 1), "3 days")
        fd.run_append(stream_.select("id", F.dayofmonth("ts").alias("day")), out)  # a restart each time
        log = spark.read.schema("id string, day int").parquet(f"{out}/log").collect()
        got.append(sorted((r.id, r.day) for r in log))
    assert got[0] == [("x", 1), ("y", 1)] and got[1] == got[0] + [("z", 2)]
    assert got[2] == sorted(got[1] + [("w", 20)])  # y is forgotten with this batch, not before
    assert got[3] == sorted(got[2] + [("x", 21)])  # x has come back
    assert got[4] == sorted(got[3] + [("y", 22)])


def test_a_retried_append_adds_no_line_twice(spark):
    path, schema = new_folder(spark, "log"), "a long, b string"
    rows = lambda *xs: spark.createDataFrame(xs, schema)
    assert sinks.append_log(rows((1, "x"), (2, None)), path, "r1")
    rows((9, "torn")).write.json(f"{path}/rows/run=r2")  # a run that failed before its manifest
    read = lambda: sorted((r.run, r.a, r.b) for r in sinks.read_log(spark, path, schema).collect())
    assert read() == [("r1", 1, "x"), ("r1", 2, None)]
    assert sinks.append_log(rows((3, "y")), path, "r2")
    assert not sinks.append_log(rows((3, "y")), path, "r2") and not sinks.append_log(rows((7, "z")), path, "r1")
    assert read() == [("r1", 1, "x"), ("r1", 2, None), ("r2", 3, "y")]


def test_history_over_splits_of_one_file(spark):
    """The last line of an id wins across splits, and broken lines are set aside."""
    import json
    path = new_folder(spark, "history")
    lines = []
    for i in range(400):
        lines.append(json.dumps({"eval_id": f"e{i % 37}", "path": f"p{i}", "factual_score": i % 101, "status": "ok",
                                 "checked_at": "2024-01-05T00:00:00Z" if i % 2 else "unknown"}))
        if i % 50 == 0:
            lines.append('{"eval_id": "e1", "path')
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        good, bad = rd.read_history(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        assert {r.eval_id: r.path for r in good.collect()} == {f"e{i % 37}": f"p{i}" for i in range(400)}
        assert bad.count() == 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_dedupe_stream_equals_batch(spark):
    src, folder = split_events(spark)
    out = new_folder(spark, "dedupe")
    fd.run_append(fd.dedupe_stream(shape_entries(stream(spark, src, folder)), "60 days").select("id"), out)
    got = [r.id for r in spark.read.schema("id string").parquet(f"{out}/log").collect()]
    assert len(got) == len(set(got)) == shape_entries(src).select("id").distinct().count()


def test_incident_detection(spark):
    t = dt.datetime(2024, 1, 2)
    rows = [("1", "GitHub Status", "status", "The API Is Slow In Tokyo Region", "", t, "l"),
            ("2", "GitHub Status", "status", "Later", "", t + dt.timedelta(hours=1), "l"),
            ("3", "Docker Blog", "blog", "Release", "a partial outage", t, "l"),
            ("4", "AWS News", "blog", "New Thing", "", t, "l"),
            ("5", "Old Status", "status", "Old", "", t - dt.timedelta(days=3), "l")]
    df = spark.createDataFrame(rows, "id string, feed_name string, category string, title string, "
                               "summary string, ts timestamp_ntz, link string")
    since = F.lit("2024-01-01").cast("timestamp_ntz")
    got = {r.service: r.keywords for r in fd.detect_incidents(df, since).collect()}
    assert got == {"GitHub": ["API", "Slow", "Tokyo", "Region"], "Docker": ["Release"]}


def test_attempts_since_success(spark):
    rows = [("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", 1, False), ("b", 2, False),
            ("b", 3, False), ("c", 1, False), ("c", 2, True)]
    df = spark.createDataFrame(rows, "key string, ord int, ok boolean")
    got = {r.key: (r.failures, r.state) for r in
           qu.attempts_since_success(df, "key", F.col("ok"), ["ord"]).collect()}
    assert got == {"a": (1, "retry"), "b": (3, "needs_manual_review")}


def test_sync_due(spark):
    t = dt.datetime(2024, 1, 5)
    src = spark.createDataFrame([("a", t, True), ("b", t, True), ("c", t, True), ("d", t, False)],
                                "k string, updated timestamp_ntz, exists boolean")
    led = spark.createDataFrame([("a", "2024-01-06T00:00:00"), ("b", "bad"), ("d", "2025-01-01")],
                                "k string, synced string")
    assert {r.k: r.due for r in fd.sync_due(src, led, "k").collect()} == {
        "a": False, "b": True, "c": True, "d": True}


def test_written_folders_are_removed(spark, monkeypatch):
    from sitegauge import session
    table = session.cut_lineage(spark.range(3))
    assert table.count() == 3 and session._scratch(spark) in table.inputFiles()[0]
    other = f"{session._scratch(spark)}-other"
    monkeypatch.setattr(session, "_scratch", lambda _: other)
    path = session.new_folder(spark, "x")
    spark.range(2).write.parquet(path)
    session.remove_folders(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
