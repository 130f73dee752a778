"""Small column helpers shared by the operators."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c) -> Column:
    """Report rounding to 6 places.

    The offset moves exact ties off the boundary, so sums added up in another
    order round alike.
    """
    return F.round(as_col(c) + 1e-10, 6)


def count_if(cond: Column) -> Column:
    """Number of rows where the condition holds, zero on empty input."""
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("long")


def ratio(num, den, empty: float = 0.0) -> Column:
    """num / den, with a fixed value where the denominator is zero or missing."""
    return F.coalesce(F.try_divide(as_col(num).cast("double"), as_col(den).cast("double")),
                      F.lit(empty))


def any_of(words) -> str:
    """Regular expression matching any of the given literal words."""
    return "(" + "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w))) + ")"


def contains_any(col, words) -> Column:
    """A literal word lies in the text; plain searches cost less than one pattern of all words."""
    return once(as_col(col), lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in words]))


def lag_ranges(run_date: str, lag: int = 3, days: int = 7):
    """Reporting range ending ``lag`` days before the run, and the range before it."""
    run = dt.date.fromisoformat(run_date)
    end = run - dt.timedelta(days=lag)
    start = end - dt.timedelta(days=days - 1)
    prev_end = start - dt.timedelta(days=1)
    return start, end, prev_end - dt.timedelta(days=days - 1), prev_end


def between_days(col, start, end) -> Column:
    return as_col(col).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def top_per_key(df: DataFrame, keys, order, k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key.

    The rank filter is applied right above the window, so Spark limits each
    map task to ``k`` rows per key before the shuffle; a hot key stays small.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def numbered(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """Add each row's place (from 0) in the order of its key, however many rows a key has.

    Rows are dealt by ranges of (key, order) and stored once; a window sees one range of one key, and
    one row per range says how many rows lie before it. ``order`` must name each row of a key.
    """
    from pyspark.sql import Window

    from ..session import cut_lineage

    ranged = cut_lineage(df.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (ranged.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
             .select(key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy(key, "_part").orderBy(order))
    return (ranged.join(parts, [key, "_part"])
            .withColumn(name, F.col("_before") + inside - 1).drop("_part", "_before"))


def latest_per_key(df: DataFrame, keys, order: Column) -> DataFrame:
    """One row per key with the greatest ``order``; partial aggregation, no window."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*")


def first_per_key(df: DataFrame, keys, order: Column) -> DataFrame:
    """One row per key with the smallest ``order``."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*")


def newest_first(df: DataFrame, col: str) -> Column:
    """Number that sorts a time column newest first, missing times last."""
    c = F.col(col)
    if df.schema[col].dataType.typeName() == "timestamp_ntz":
        micros = (F.unix_date(F.to_date(c)).cast("long") * 86400000000
                  + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1000000
                  + (F.extract(F.lit("SECOND"), c) * 1000000).cast("long"))
    else:
        micros = F.unix_micros(c)
    return F.coalesce(-micros, F.lit(2 ** 62))


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer partitions than cores; larger inputs stay as they are.

    Text work is heavy per byte, so a table in a single row group would keep
    all but one core idle. Tables with enough splits are returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


PART_ROWS, MOST_ROWS, FLAT_PARTS = 2 ** 18, 2 ** 21, 200


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Deal rows by key into partitions whose number grows with ``rows``, so no task sorts a fixed share.

    A partition gets about 2^18 rows. Up to 200 partitions a shuffle is written without holding a
    task's rows, so from there on partitions grow, to 2^21 rows at most. Every core gets a partition,
    however few rows there are. Adaptive execution does not merge partitions dealt this way, so the
    rows of one key stay in one task.
    """
    parts = max(min(FLAT_PARTS, -(-rows // PART_ROWS)), -(-rows // MOST_ROWS),
                df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(parts, *keys)


def guarded(cond: Column, value: Column, otherwise: Column) -> Column:
    """Evaluate a costly expression only where a cheap test holds."""
    return F.when(cond, value).otherwise(otherwise)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def explode_once(df: DataFrame, keep, values: Column, name: str) -> DataFrame:
    """One row per element of a computed array (null elements drop out).

    A plain explode adds a size filter that evaluates the array again; the
    outer form does not, so costly text expressions run once per row.
    """
    return (df.select(*keep, F.explode_outer(values).alias(name))
            .filter(F.col(name).isNotNull()))
