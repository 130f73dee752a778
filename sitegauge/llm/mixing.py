"""Mixing sources to target weights by hash order, prefix sums and exact budgets.

Each document gets a key from the MD5 of its id, so its place in its source's order is random but
the same in every run. Sources are cut into equal key ranges in proportion to their rows: a range
is one window partition, however large the source. Sums of the ranges give each range its start,
and a document's words lie at [start + words before it in the range, ...). A source's budget is its
target rounded to whole words: whole epochs first, then the words before the cut; the document at
the cut gives its leading words only.

Weights go to sources by code point, null last, repeating the given cycle. Targets share
``share`` times all words by weight, at most ``epochs`` times the source; the excess is shared anew
by weight among the others (water filling by running sums over the sources sorted by the share at
which they are full).

Defined results: null text has 0 words and gives none; sources without words have target 0; rows
with equal ids are ordered by size and otherwise alike; null ids share one key and are ordered by
size; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, cut_lineage, n_words, partitions, running_totals

WEIGHTS = (5, 2, 1)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, epochs: int = 2) -> DataFrame:
    """One row per source: source, source_no, source_size, source_rows, target."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                            F.count(F.lit(1)).alias("source_rows"))
    numbered = running_totals(by_source, [F.col("source").asc_nulls_last()], {"source_no": F.lit(1)})
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = numbered.withColumn(
        "weight", F.get(cycle, (F.col("source_no") % len(weights)).cast("int")))
    full = weighted.withColumn("full_at", F.col("source_size") * float(epochs) / F.col("weight"))
    filled = running_totals(full, [F.col("full_at"), F.col("source_no")],
                            {"caps_before": F.col("source_size") * epochs,
                             "weights_before": F.col("weight")})
    totals = filled.agg((F.sum("source_size") * share).alias("all_target"),
                        F.sum("weight").alias("all_weight"))
    level = ((F.col("all_target") - F.col("caps_before"))
             / (F.col("all_weight") - F.col("weights_before")))
    levels = filled.crossJoin(F.broadcast(totals)).withColumn("level", level)  # one row
    top = levels.agg(F.max("level").alias("top_level"))
    return levels.crossJoin(F.broadcast(top)).select(  # one row
        "source", "source_no", "source_size", "source_rows",
        F.least(F.col("source_size") * float(epochs),
                F.col("weight") * F.col("top_level")).alias("target"))


def plan_mix(docs: DataFrame, keep=(), weights=WEIGHTS, share: float = 1.5, epochs: int = 2,
             seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target and taken, with the columns of ``keep``.

    ``keep`` are narrow columns or expressions that go along; texts should not.
    """
    key = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")
    sized = cut_lineage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                                    key.alias("key"), *keep))
    kept = sized.columns[4:]
    sources = cut_lineage(source_targets(sized, weights, share, epochs))
    # Ranges in proportion to rows; as many in all as a shuffle has partitions, and one per source.
    ranges = 1 + F.floor(F.lit(partitions(docs.sparkSession)) * F.col("source_rows")
                         / F.lit(max(1, sized.count())))
    joined = (sized.withColumnRenamed("source", "own_source")
              .join(sources, F.col("own_source").eqNullSafe(F.col("source")))
              .withColumn("range_no", F.shiftright(F.shiftright("key", 28) * ranges, 32)))
    sums = joined.groupBy("source_no", "range_no").agg(F.sum("size").alias("range_size"))
    before = (Window.partitionBy("source_no").orderBy("range_no")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("source_no", "range_no",
                         F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("source_no", "range_no")
              .orderBy("key", "doc_id", "size", *kept)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (joined.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(starts, ["source_no", "range_no"]))
    budget = F.floor(F.col("target") + 0.5)
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))
                    ).otherwise(0)
    rest = budget - rounds * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start") - F.col("before")))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (rounds * F.col("size") + last).cast("long").alias("taken"), *kept)


def op1(docs: DataFrame) -> DataFrame:
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: one row per whole copy, and the leading
    words of the document at a source's cut.

    Rows alike in id, source and text count as one document that comes several times.
    """
    alike = ["_mix_id", "_mix_source", "_mix_hash"]
    own = [F.col("doc_id").alias(alike[0]), F.col("source").alias(alike[1]),
           F.xxhash64("text").alias(alike[2])]
    plan = plan_mix(docs, keep=[own[2]])
    total = (plan.groupBy(F.col("doc_id").alias("_plan_id"), F.col("source").alias("_plan_source"),
                          F.col(alike[2]).alias("_plan_hash"), F.col("size").alias("_plan_size"))
             .agg(F.sum("taken").alias("_plan_taken")).filter("_plan_taken > 0"))
    rows = docs.select(*own, F.struct(*docs.columns).alias("_mix_row")).groupBy(*alike).agg(
        F.first("_mix_row").alias("_mix_row"))
    joined = rows.join(total, F.col("_mix_id").eqNullSafe(F.col("_plan_id"))
                       & F.col("_mix_source").eqNullSafe(F.col("_plan_source"))
                       & (F.col("_mix_hash") == F.col("_plan_hash")))
    whole = F.expr("_plan_taken div _plan_size")
    part = F.expr("cast(_plan_taken % _plan_size as int)")
    copies = joined.select("_mix_row.*", whole.alias("_mix_whole"), part.alias("_mix_part"),
                           F.explode(F.sequence(F.lit(1), whole + F.when(part > 0, 1).otherwise(0))
                                     ).alias("_mix_copy"))
    cut = F.col("_mix_copy") > F.col("_mix_whole")
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col("_mix_part")), "")
    cols = {"text": F.when(cut, head).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.when(cut, F.char_length(head)).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType)
    return copies.select(*[cols.get(c, F.col(c)).alias(c) for c in docs.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, coalesce(CAST(sum(2 * source_size) OVER w AS DOUBLE), 0) AS caps_before,
         coalesce(sum(weight) OVER w, 0) AS weights_before,
         sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM sources
  WINDOW w AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, max((CAST(all_size AS DOUBLE) * 1.5::DOUBLE - caps_before)
                / (all_weight - weights_before)) OVER () AS top_level
  FROM filled),
targets AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, weight * top_level) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY substr(h, 1, 15), doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CAST(floor(target + 0.5) AS BIGINT) AS budget
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
rounds AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS r FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(r * size + greatest(0, least(size, budget - r * source_size - before)) AS BIGINT) AS taken
FROM rounds
"""
