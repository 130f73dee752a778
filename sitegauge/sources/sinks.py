"""Sinks: run-dated reports, append-only logs, Markdown rows and search indexes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_report(df: DataFrame, path: str, run_date: str, fmt: str = "json") -> None:
    """One report partition per run date; running a date again replaces it."""
    (df.withColumn("run_date", F.lit(run_date)).write.partitionBy("run_date")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").format(fmt).save(path))


def append_log(df: DataFrame, path: str, run: str) -> bool:
    """Append one run's rows to a log of JSON lines; true if this call committed them.

    The rows go into a folder of the run, and a manifest written after them commits the run. A run
    that failed in between is written anew by its retry, and a committed one is left as it is, so
    no line comes twice.
    """
    spark = df.sparkSession
    if not _committed(spark, path).filter(F.col("run") == run).isEmpty():
        return False
    df.write.mode("overwrite").json(f"{path}/rows/run={run}")
    spark.range(1).select(F.lit(run).alias("run")).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return True


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """Runs with a manifest; the pattern also fits where nothing was committed yet."""
    try:
        return spark.read.schema("run string").json(f"{path}/manifest").distinct()
    except AnalysisException:  # the folder does not exist before the first commit
        return spark.createDataFrame([], "run string")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of committed runs, with the run's name."""
    rows = spark.read.schema(f"{schema}, run string").json(f"{path}/rows")
    return rows.join(_committed(spark, path), "run", "left_semi")


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def markdown_rows(df: DataFrame) -> DataFrame:
    """A table as Markdown lines: header, rule, one line per row (columns ord, line)."""
    cells = [F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit(""))
             for c in df.columns]
    bar = lambda xs: F.concat(F.lit("| "), F.concat_ws(" | ", *xs), F.lit(" |"))
    head = df.sparkSession.range(2).select(
        F.col("id").cast("int").alias("ord"),
        F.when(F.col("id") == 0, bar([F.lit(c) for c in df.columns]))
        .otherwise(bar([F.lit(":---")] * len(df.columns))).alias("line"))
    return head.unionByName(df.select(F.lit(2).alias("ord"), bar(cells).alias("line")))


def case_index(articles: DataFrame) -> DataFrame:
    """One flat search row per error case of a published article.

    articles: title, service, errorCode, error_name, error_type, aliases, tags,
    permalink, draft, hidden, error_cases array<struct<id, messages, situation,
    cause, check, fix, label>>.
    """
    t = lambda c: F.coalesce(c, F.lit(""))
    some = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))
    none = F.array().cast("array<string>")
    a = articles.filter(~F.coalesce("draft", F.lit(False)) & ~F.coalesce("hidden", F.lit(False)))
    c = F.col("c")
    return a.withColumn("c", F.explode("error_cases")).filter(t(c["id"]) != "").select(
        "title", some(F.col("service"), F.get("tags", F.lit(0))).alias("service"),
        t(F.col("errorCode")).alias("errorCode"),
        some(F.col("error_name"), F.col("errorCode"), F.col("error_type"), F.col("title")).alias("errorName"),
        F.coalesce("aliases", none).alias("aliases"), c["id"].alias("causeId"),
        t(c["situation"]).alias("situation"), some(c["cause"], c["label"]).alias("cause"),
        t(c["check"]).alias("check"), t(c["fix"]).alias("fix"),
        F.coalesce(c["messages"], none).alias("messages"), "permalink", c["id"].alias("anchor"),
        F.concat("permalink", F.lit("#"), c["id"]).alias("url"))


def page_index(pages: DataFrame, chars: int = 200) -> DataFrame:
    """One search row per page: title, shortened content, permalink, code and first tag."""
    return pages.filter(~F.coalesce("hidden", F.lit(False))).select(
        "title", F.substring("content", 1, chars).alias("content"), "permalink",
        F.coalesce("errorCode", F.lit("")).alias("errorCode"),
        F.coalesce(F.get("tags", F.lit(0)), F.lit("")).alias("tag"))


def write_index(df: DataFrame, path: str) -> None:
    """The search index: one JSON row per line, empty fields as empty text."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_index(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
