"""Incremental feeds: seen entries, incidents with a lifetime, ledgers and windows.

Stream functions take and return streaming DataFrames or run them with an
``availableNow`` trigger into tables below the shared checkpoint folder, so a
lost executor or a restart resumes from the checkpoint. The module is pickled by value, so executors
need no copy of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import constants as C
from ..functions.common import contains_any, latest_per_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# -------------------------------------------------------------------- R01 seen entries


def entry_id(feed: Column, raw: Column) -> Column:
    return F.md5(F.concat(feed, F.lit(":"), raw))


def unseen(entries: DataFrame, seen: DataFrame, order) -> DataFrame:
    """First occurrence of every entry id that no earlier run has seen."""
    new = entries.join(seen.select("id"), "id", "left_anti")
    rest = [c for c in entries.columns if c != "id"]
    return (new.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
            .select("id", "r.*"))


def dedupe_stream(entries: DataFrame, keep: str = "30 days", time: str = "ts") -> DataFrame:
    """Stream without repeated ids; state is bounded by time, not by a count."""
    return entries.withWatermark(time, keep).dropDuplicatesWithinWatermark(["id"])


# ---------------------------------------------------------------------- R02 incidents


def feed_service(feed: Column) -> Column:
    return F.trim(F.regexp_replace(feed, "(?i)\\s*(Status|Blog|Changelog|News)\\s*$", ""))


def is_incident(keywords=C.INCIDENT_KEYWORDS) -> Column:
    """Entry of a status feed, or with an incident word in title or summary."""
    text = F.lower(F.concat_ws(" ", "title", "summary"))
    status = (F.lower("category") == "status") | F.lower("feed_name").contains("status")
    return F.coalesce(status, F.lit(False)) | contains_any(text, keywords)


def title_keywords(title="title", k: int = 5) -> Column:
    found = F.regexp_extract_all(F.col(title), F.lit("\\b[A-Z][a-zA-Z]+\\b"), F.lit(0))
    return F.slice(F.filter(found, lambda w: ~w.isin(*C.TITLE_STOP_WORDS)), 1, k)


def detect_incidents(entries: DataFrame, since: Column | None = None) -> DataFrame:
    """First incident entry per service, optionally not older than ``since``."""
    e = entries if since is None else entries.filter(F.col("ts") >= since)
    return (e.filter(is_incident()).groupBy(feed_service(F.col("feed_name")).alias("service"))
            .agg(F.min_by(F.struct(title_keywords().alias("keywords"),
                                   F.col("ts").alias("detected_at"), "title", "link"),
                          F.struct("ts", "id")).alias("r"))
            .select("service", "r.*"))


def active_incidents(flags: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Latest flag per service that is younger than its lifetime."""
    newest = latest_per_key(flags, ["service"], F.struct("detected_at", "title"))
    return newest.filter(F.col("detected_at") > now - F.make_dt_interval(hours=F.lit(hours)))


def flag_changes(articles: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """apply: matches an active incident and is not flagged; clear: flagged without a match."""
    m = matched.select(key).distinct().withColumn("hit", F.lit(True))
    j = articles.join(m, key, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return j.withColumn("change", F.when(F.col("hit") & ~F.col("flagged"), "apply")
                        .when(~F.col("hit") & F.col("flagged"), "clear")).filter("change IS NOT NULL")


# ---------------------------------------------------------------- R06 / R08 ledgers


def to_notify(published: DataFrame, ledger: DataFrame, order) -> DataFrame:
    """Published URLs not notified yet, each once."""
    new = published.join(ledger.select("url"), "url", "left_anti")
    rest = [c for c in published.columns if c != "url"]
    return (new.groupBy("url").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
            .select("url", "r.*"))


def sync_due(sources: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Sources newer than their last sync; a missing or unreadable time means due.

    sources: key, updated (timestamp), exists. ledger: key, synced (text).
    """
    j = sources.join(ledger.select(key, "synced"), key, "left")
    last = F.col("synced").try_cast("timestamp_ntz")
    return j.withColumn("due", ~F.col("exists") | last.isNull() | (F.col("updated") > last))


# ------------------------------------------------------------------- R07 lagged windows


def settled_windows(events: DataFrame, delay: str = "3 days", size: str = "7 days",
                    time: str = "ts") -> DataFrame:
    """Tumbling windows emitted once the settle delay has passed; keys stay spread
    because counts are combined per task before the state shuffle."""
    return (events.withWatermark(time, delay).groupBy(F.window(time, size).alias("w"))
            .agg(F.count(F.lit(1)).alias("views"),
                 F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("clicks"))
            .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "views",
                    F.col("clicks").cast("long").alias("clicks")))


# -------------------------------------------------------------------- running streams


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(path)


def run_append(stream: DataFrame, path: str) -> None:
    """Process what is available into an append-only parquet log with its checkpoint."""
    (stream.writeStream.outputMode("append").format("parquet")
     .option("path", f"{path}/log").option("checkpointLocation", f"{path}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def run_batches(stream: DataFrame, path: str, step: Callable[[DataFrame, int], None]) -> None:
    """Run ``step`` on every micro-batch that is available, from the checkpoint on."""
    (stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{path}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def put_epoch(df: DataFrame, path: str, epoch: int) -> None:
    """One batch's rows of a log. A replayed batch replaces its own rows."""
    df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def read_epochs(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of a log with their epoch, by default of all batches, or of those before one.

    A batch must not see what a replaced run of itself or of a later one has left.
    """
    full = f"{schema}, epoch int"
    if before == 0:
        return spark.createDataFrame([], full)
    log = spark.read.schema(full).parquet(path)
    return log if before is None else log.filter(F.col("epoch") < before)


# ------------------------------------------------------ R03 incidents with a lifetime

FLAGS = "service string, detected_at timestamp, title string, keywords array<string>"
CHANGES = f"{FLAGS}, event string"


class _Incidents(StatefulProcessor):
    """Newest flag per service; a timer ends it ``hours`` after its own time."""

    def __init__(self, hours: int):
        self.life_ms = hours * 3_600_000

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState(
            "newest", "detected_at timestamp, title string, keywords array<string>")

    def _row(self, service, state, event):
        return pd.DataFrame({"service": [service], "detected_at": [state[0]], "title": [state[1]],
                             "keywords": [list(state[2])], "event": [event]})

    def handleInputRows(self, key, rows, timerValues):
        old = self.newest.get() if self.newest.exists() else None
        best = None
        for frame in rows:
            for r in frame[["detected_at", "title", "keywords"]].itertuples(index=False, name=None):
                if best is None or r[:2] > best[:2]:
                    best = r
        if best is None or (old is not None and (old[0], old[1]) >= best[:2]):
            return  # nothing newer; a late flag changes nothing
        end = int(pd.Timestamp(best[0]).tz_localize("UTC").value // 1_000_000) + self.life_ms
        if end <= timerValues.getCurrentWatermarkInMs():
            return  # over before it arrived
        if old is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        self.newest.update((best[0].to_pydatetime(), best[1], list(best[2])))
        self.handle.registerTimer(end)
        yield self._row(key[0], best, "raise")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        old = self.newest.get()
        self.newest.clear()
        yield self._row(key[0], (pd.Timestamp(old[0]), old[1], old[2]), "end")

    def close(self) -> None:
        pass


def _newest_in_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per service and Arrow batch, so that a busy service sends few rows to its task."""
    for frame in frames:
        if len(frame):
            yield frame.sort_values(["detected_at", "title"]).drop_duplicates("service", keep="last")


def incident_changes(flags: DataFrame, hours: int = 24, delay: str = "1 hour") -> DataFrame:
    """Stream of raised and ended incidents from a stream of flags, by event time.

    State holds one flag per service and is gone when the flag ends; nothing is written twice. A flag
    over when it arrives raises nothing, and one without a time is no flag.
    flags: service, detected_at, title, keywords.
    """
    clean = flags.filter(F.col("detected_at").isNotNull()).select(
        "service", "detected_at", F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"))
    return (clean.mapInPandas(_newest_in_task, FLAGS)
            .withWatermark("detected_at", delay).groupBy("service")
            .transformWithStateInPandas(_Incidents(hours), CHANGES, "Append", "EventTime"))


def run_incidents(flags: DataFrame, path: str, hours: int = 24, delay: str = "1 hour") -> None:
    """Append the changes to a log; state and log resume from the checkpoint."""
    spark = flags.sparkSession
    name, provider = "spark.sql.streaming.stateStore.providerClass", (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    old = spark.conf.get(name, None)
    spark.conf.set(name, provider)  # keyed state with timers needs it
    try:
        run_append(incident_changes(flags, hours, delay), path)
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


def open_incidents(changes: DataFrame) -> DataFrame:
    """Incidents of a change log that are raised and neither ended nor replaced."""
    ended = changes.filter("event = 'end'").select("service", "detected_at", "title")
    raised = latest_per_key(changes.filter("event = 'raise'").drop("event"), ["service"],
                            F.struct("detected_at", "title"))
    return raised.join(ended, ["service", "detected_at", "title"], "left_anti")


# ------------------------------------------------------------ R04 / R06 ledgers by batch

def run_flags(flags: DataFrame, articles: DataFrame, key: str, path: str,
              match: Callable[[DataFrame, DataFrame, str], DataFrame], hours: int = 24) -> None:
    """Apply and clear article flags as incidents come and go.

    Every batch logs the newest flag per service and the changes it makes to the flags that batches
    before it left. articles: the columns of ``match`` and ``flagged``, the state before the stream.
    """
    kind = dict(articles.dtypes)[key]

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        put_epoch(latest_per_key(batch.select("service", "detected_at", "title", "keywords"), ["service"],
                                 F.struct("detected_at", "title")), f"{path}/flags", epoch)
        seen = read_epochs(spark, f"{path}/flags", FLAGS, epoch + 1).drop("epoch")
        now = seen.agg(F.max("detected_at")).first()[0]  # event time
        if now is None:
            put_epoch(spark.createDataFrame([], f"{key} {kind}, change string"), f"{path}/changes", epoch)
            return
        active = active_incidents(seen, F.lit(now), hours)
        current = flag_state(articles, read_epochs(spark, f"{path}/changes", f"{key} {kind}, change string", epoch), key)
        put_epoch(flag_changes(current, match(current, active, key), key).select(key, "change"),
                  f"{path}/changes", epoch)

    run_batches(flags, path, step)


def flag_state(articles: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Articles with the flag that the last change left."""
    last = changes.groupBy(key).agg(F.max_by("change", "epoch").alias("_change"))
    return articles.join(last, key, "left").withColumn("flagged", F.coalesce(
        F.col("_change") == "apply", F.col("flagged"))).drop("_change")


def run_notify(published: DataFrame, path: str, order, send: Callable[[DataFrame], None] | None = None) -> None:
    """Notify each URL once: a batch logs the URLs that no batch before it has.

    The log is written before ``send`` gets it, so a batch that fails in between and runs again sends
    the same rows, and no later batch sends them again.
    """
    schema = ", ".join(f"{n} {t}" for n, t in published.dtypes)

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        log = f"{path}/notified"
        new = to_notify(batch, read_epochs(spark, log, schema, epoch), order)
        put_epoch(new.select(*published.columns), log, epoch)
        if send is not None:
            send(read_epochs(spark, log, schema).filter(F.col("epoch") == epoch).drop("epoch"))

    run_batches(published, path, step)
