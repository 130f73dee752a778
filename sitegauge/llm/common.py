"""What several operators of this folder share.

Words are maximal runs of characters other than space and tab to carriage return. ``bytes.split()``
splits UTF-8 at exactly these, and ``bytes.lower()`` lower-cases exactly A-Z, so Python code works
on the bytes of a text.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage, new_folder  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; the fast path serves texts of ASCII only."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """CRC-32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % buckets


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def bounded_sample(df: DataFrame, by: list[str], max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows of the smallest hashes of ``by``.

    Tasks keep a share of the rows first, so together they send about one and a half times as many.
    """
    h = free_name(df, "_hash")
    rows = df.withColumn(h, F.xxhash64(*by))
    share = min(1.0, (1.5 * max_rows + 100) / max(1, df.count()))
    return (rows.filter(F.pmod(h, F.lit(1 << 30)) < int(share * (1 << 30)))
            .orderBy(h, *by).limit(max_rows).drop(h))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Sums of all rows before each row in a global order, without one task seeing all rows.

    Rows are range-partitioned and sorted; runs are summed, and a table of one row per run
    holds what lies before each. ``order`` must be total for a defined result.
    """
    from pyspark.sql import Window

    run = free_name(df, "_run")
    named = {k: free_name(df, f"_{k}") for k in sums}
    runs = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumns({run: F.spark_partition_id(),
                                     **{named[k]: v for k, v in sums.items()}}))
    before = Window.orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    starts = (runs.groupBy(run).agg(*[F.sum(named[k]).alias(named[k]) for k in sums])
              .select(run, *[F.coalesce(F.sum(named[k]).over(before), F.lit(0)).alias(f"start_{k}")
                             for k in sums]))
    inside = Window.partitionBy(run).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = runs.withColumns({f"local_{k}": F.coalesce(F.sum(named[k]).over(inside), F.lit(0))
                              for k in sums})
    return (local.join(F.broadcast(starts), run)  # one row per partition of a shuffle
            .select(*df.columns, *[(F.col(f"start_{k}") + F.col(f"local_{k}")).alias(k) for k in sums]))
