"""Sources: Markdown corpora, score histories, nested JSON reports, queues and HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import text as tx

# ---------------------------------------------------------------------- corpus


def split_front_matter(text: Column) -> dict[str, Column]:
    """Front matter map and body; without a closed block the whole text is the body."""
    block = "(?s)^---.(.*?)\\n---\\n"
    has = text.rlike(block)
    raw = F.regexp_extract(text, block, 1)
    lines = F.filter(F.split(raw, "\\r?\\n"), lambda x: x.contains(":"))
    entry = lambda x: F.struct(
        F.trim(F.substring_index(x, ":", 1)).alias("key"),
        F.regexp_replace(F.regexp_replace(
            F.trim(F.regexp_replace(x, "^[^:]*:", "")), '^"+|"+$', ""), "^'+|'+$", "").alias("value"))
    # a repeated key keeps its last value
    entries = F.reverse(F.transform(lines, entry))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    firsts = F.transform(keys, lambda k: F.get(F.filter(
        entries, lambda e: e["key"] == k), F.lit(0)))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    body = F.regexp_replace(text, block, "")
    return {"fm": F.when(has, F.map_from_entries(firsts)).otherwise(empty),
            "body": F.when(has, body).otherwise(text)}


def list_field(value: Column) -> Column:
    """Inline list ``[a, "b"]`` as array."""
    inner = F.regexp_extract(F.trim(F.coalesce(value, F.lit(""))), "^\\[(.*)\\]$", 1)
    items = F.transform(F.split(inner, ","), lambda x: F.regexp_replace(
        F.trim(x), "^[\"']|[\"']$", ""))
    return F.filter(items, lambda x: x != "")


#: Ends a document in a bundle; ``MARK`` stands before what replaces either of them in a text.
END, MARK = "\x1e", "\x1f"


def write_bundles(documents: DataFrame, text: str, path: str) -> None:
    """Whole documents one after another in as many files as there are partitions."""
    safe = F.replace(F.replace(text, F.lit(MARK), F.lit(MARK + "1")), F.lit(END), F.lit(MARK + "0"))
    documents.select(safe.alias("value")).write.option("lineSep", END).text(path)


def read_corpus(spark: SparkSession, path: str, bundles: bool = False) -> DataFrame:
    """One row per document: path, stem, fm, tags, body.

    One file is one row, read by its task, or holds many documents of ``write_bundles``: a file costs
    more than a document, so large corpora come in bundles.
    """
    t = spark.read.text(path, lineSep=END) if bundles else spark.read.text(path, wholetext=True)
    if bundles:
        plain = F.replace(F.replace("value", F.lit(MARK + "0"), F.lit(END)), F.lit(MARK + "1"), F.lit(MARK))
        t = t.withColumn("value", plain)
    t = t.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("text"))
    parts = split_front_matter(F.col("text"))
    return t.select(
        "path", F.regexp_extract("path", "([^/]+?)(?:\\.[^./]*)?$", 1).alias("stem"),
        parts["fm"].alias("fm"), parts["body"].alias("body")
    ).withColumn("tags", list_field(F.col("fm")["tags"]))


# --------------------------------------------------------------------- histories

HISTORY_SCHEMA = T.StructType([
    T.StructField("eval_id", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("article_hash", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("factual_score", T.StringType()), T.StructField("freshness_score", T.StringType()),
    T.StructField("citation_coverage", T.StringType()), T.StructField("risk_score", T.StringType()),
    T.StructField("gemini_model", T.StringType()), T.StructField("prompt_version", T.StringType()),
    T.StructField("checked_at", T.StringType()), T.StructField("overall_judgement", T.StringType()),
    T.StructField("mode", T.StringType()), T.StructField("error_detail", T.StringType()),
    T.StructField("sources", T.ArrayType(T.StructType([
        T.StructField("url", T.StringType()), T.StructField("claim", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("url_check_status", T.StringType())]))),
    T.StructField("unsupported_claims", T.ArrayType(T.StringType())),
    T.StructField("vote_group_id", T.StringType()), T.StructField("_corrupt", T.StringType()),
])


def read_history(spark: SparkSession, path: str, since: str | None = None,
                 until: str | None = None):
    """(records, corrupt lines) of a JSON-lines score history.

    The last line per eval_id wins (file, then position); lines without an id
    are all kept. Times without a zone are UTC; unparseable times survive the
    date filter.
    """
    from ..operators.audit import as_score, keep_last

    order = F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    raw = (spark.read.text(path).select(order.alias("order_key"), "value")
           .filter(F.trim("value") != ""))
    # parsed once per line: a generator keeps the filter and the fields from parsing again
    raw = raw.select("order_key", "value", F.explode_outer(F.array(F.from_json("value", HISTORY_SCHEMA, opts))).alias("r"))
    bad = raw.filter(F.col("r._corrupt").isNotNull()).select("value")
    good = raw.filter(F.col("r._corrupt").isNull()).select("order_key", "r.*").drop("_corrupt")
    score = lambda c: as_score(c).cast("int")
    ts = F.try_to_timestamp(F.regexp_replace("checked_at", "Z$", "+00:00"))
    rows = good.select(
        "eval_id", "path", "article_hash", "status", score("factual_score").alias("factual"),
        score("freshness_score").alias("freshness"), score("citation_coverage").alias("citation"),
        score("risk_score").alias("risk"), F.col("gemini_model").alias("model"), "prompt_version",
        ts.alias("checked_at"), F.col("overall_judgement").alias("judgement"), "mode",
        "error_detail", "sources", "unsupported_claims", "vote_group_id",
        F.col("order_key").alias("seq"), "order_key")
    out = keep_last(rows)
    for bound, after in ((since, True), (until, False)):
        if bound is not None:
            b = F.lit(bound).cast("timestamp")
            keep = F.col("checked_at") >= b if after else F.col("checked_at") <= b
            out = out.filter(F.col("checked_at").isNull() | keep)
    return out, bad


def read_json_reports(spark: SparkSession, path: str, schema, explode: str | None = None) -> DataFrame:
    """Multi-line JSON reports, one per file; unreadable files are dropped."""
    df = (spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED")
          .json(path).withColumn("file", F.col("_metadata.file_path")))
    return df if explode is None else df.withColumn(explode, F.explode_outer(explode))


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """Topic queue: CSV with a header, all columns text."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


# -------------------------------------------------------------------------- pages


def read_pages(pages: DataFrame) -> DataFrame:
    """Title and visible text of HTML pages."""
    title = F.trim(F.regexp_replace(
        F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1), "\\s+", " "))
    return pages.select("page_id", "url", title.alias("title"), tx.html_text("html").alias("text"))


def outline(pages: DataFrame, second: str = "h2", third: str = "h3") -> DataFrame:
    """Title (120 characters), up to 10 second-level and 20 third-level headings."""
    def heads(tag, k):
        found = F.regexp_extract_all("html", F.lit(f"<{tag}>([^<]+)"), F.lit(1))
        cut = F.transform(found, lambda x: F.trim(F.substring(F.trim(x), 1, 100)))
        return F.slice(F.filter(cut, lambda x: x != ""), 1, k)

    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return pages.select("page_id", "url", F.trim(F.substring(title, 1, 120)).alias("title"),
                        heads(second, 10).alias("h2"), heads(third, 20).alias("h3"))
