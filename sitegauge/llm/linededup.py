"""Line dedup: sorted runs of line hashes, first occurrences, keep bitmaps.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; keys shorter than
``min_chars`` code points never count. Hashes are range-partitioned by (hash, document), so a line
that a third of all rows share spreads over many runs; inside a run the rows are read in order and
compared with the first document of their key. A key that crosses a run border is the last key of
one run and the first of the next: there are at most as many as runs, and their first documents are
broadcast. Decisions leave as bitmaps of 64 lines a word, for documents that lose lines only.

Defined results: a null or empty text is one empty line, which stays; a null doc_id comes after all
others, and rows with a null id count as one document; rows with the same id count as one document
and keep their lines; an empty table gives an empty one; other columns are ignored. Keys are
compared by two 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ASCII_SPACE, ascii_lower, cut_lineage, free_name

KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc, text_hash, pos, h1, h2): one row per line whose key is long enough."""
    # Hash and lines are made before the explode: else every line would carry and hash the text.
    split = docs.select(F.col("doc_id").alias("doc"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                        lines_of(F.col("text")).alias("lines"))
    lines = split.select("doc", "text_hash", F.posexplode("lines").alias("pos", "line"))
    stripped = F.btrim("line", F.lit(ASCII_SPACE))
    key = ascii_lower(F.col("stripped"))
    return (lines.select("doc", "text_hash", "pos", stripped.alias("stripped"))
            .filter(F.char_length("stripped") >= min_chars)
            .select("doc", "text_hash", "pos", F.xxhash64(key).alias("h1"),
                    F.xxhash64(F.lit("second"), key).alias("h2")))


def later_lines(hashes: DataFrame) -> DataFrame:
    """The rows of ``line_hashes`` whose key a document with a smaller id holds."""
    by_doc = F.col("doc").asc_nulls_last()
    runs = cut_lineage(hashes.repartitionByRange("h1", "h2", by_doc)
                       .sortWithinPartitions("h1", "h2", by_doc, "pos")
                       .withColumn("run", F.spark_partition_id()))
    ends = runs.groupBy("run").agg(F.min(F.struct(*KEY)).alias("low"),
                                   F.max(F.struct(*KEY)).alias("high"))
    crossing = (ends.select("high.*", F.col("run").alias("run_a"))
                .join(ends.select("low.*", F.col("run").alias("run_b")), KEY)
                .filter("run_a < run_b").select(*KEY).distinct())
    carried = (runs.join(F.broadcast(crossing), KEY)  # at most one key per run
               .groupBy(*KEY).agg(F.min("doc").alias("carried"))
               .withColumn("crosses", F.lit(True)))
    inside = Window.partitionBy("run", *KEY).orderBy(by_doc, "pos")
    first = F.when(F.col("crosses"), F.col("carried")).otherwise(F.col("first_in_run"))
    return (runs.withColumn("first_in_run", F.first("doc").over(inside))
            .join(F.broadcast(carried), KEY, "left")
            .filter(~F.col("doc").eqNullSafe(first))
            .select("doc", "text_hash", "pos"))


def drop_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc, text_hash, n_dropped, words): which lines go, for documents that lose any.

    ``words`` is a sparse bitmap: structs of the word's index and its 64 bits.
    """
    rows = later_lines(line_hashes(docs, min_chars))
    words = (rows.groupBy("doc", "text_hash", F.expr("pos div 64").cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    return words.groupBy("doc", "text_hash").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def with_kept_text(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` with a struct column ``line_dedup``: n_lines, n_dropped and the kept text."""
    out = free_name(docs, "line_dedup")
    rows = docs.withColumn("_line_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    maps = (drop_bitmaps(docs, min_chars)
            .select(F.col("doc").alias("_line_doc"), F.col("text_hash").alias("_line_text"),
                    F.col("n_dropped").alias("_line_dropped"),
                    F.expr("flatten(transform(words, (x, i) -> concat(array_repeat(0L, "
                           "x.word - 1 - if(i = 0, -1, words[i - 1].word)), array(x.bits))))")
                    .alias("_line_bits")))
    joined = rows.join(maps, rows["doc_id"].eqNullSafe(maps["_line_doc"])
                       & (rows["_line_hash"] == maps["_line_text"]), "left")
    keep = F.expr(
        "array_join(filter(split(coalesce(text, ''), '\\n'), (x, i) -> "
        "(coalesce(shiftright(get(_line_bits, i div 64), i % 64), 0L) & 1L) = 0), '\\n')")
    return joined.select(*[rows[c] for c in docs.columns], F.struct(
        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("_line_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_line_bits").isNull(), F.coalesce("text", F.lit("")))
        .otherwise(keep).alias("text")).alias(out))


def op5(docs: DataFrame) -> DataFrame:
    rows = with_kept_text(docs.select("doc_id", "text"))
    return rows.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
                       F.sha2("line_dedup.text", 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the kept lines as text."""
    rows = with_kept_text(docs)
    out = rows.columns[-1]
    changed = F.col(f"{out}.n_dropped") > 0
    text = F.when(changed, F.col(f"{out}.text")).otherwise(F.col("text"))
    cols = {"text": text}
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.when(changed, F.char_length(f"{out}.text")).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[cols.get(c, F.col(c)).alias(c) for c in docs.columns])


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, rowid_, i, ls[i] AS line, length(ls) AS n_lines,
         translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, row_number() OVER () AS rowid_,
               string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(range(1, length(ls) + 1)) AS i)),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT l.*, (length(l.key) >= 10 AND l.doc_id <> f.first_doc) AS gone
  FROM lines l LEFT JOIN firsts f ON l.key = f.key AND length(l.key) >= 10)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, rowid_
"""
