"""Quality rules as a bitmask ledger.

``ledger`` reads each text once and stores measurements and one bit per failed rule. Policies are
versioned sets of rules, that is masks over the bits; a policy or an ablation needs the ledger only.
Rules keep their bit for good; new ones are appended.

Defined results: a null or empty text has no words and all counts 0, so it fails ``few_words``;
lines are compared whole; other columns go along untouched, also when they are named like a
measurement; an empty table gives an empty ledger; equal rows get equal bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import free_name, texts_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_exclaims", "n_capitals")

#: Name and failing condition over the measurements; the position is the bit.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("exclaims", "2 * n_exclaims > n_words"),
    ("capitals", "10 * n_capitals > 4 * word_chars"),
    ("word_length", "word_chars > 12 * n_words or 2 * word_chars < 5 * n_words"),
    ("repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
)

BASE = ("few_words", "repeated_windows")
POLICIES = {"v1": BASE, "v2": tuple(name for name, _ in RULES)}
CURRENT = "v2"

_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, by exact window codes."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    vocab: dict[bytes, int] = {}
    ids = np.fromiter((vocab.setdefault(w, len(vocab)) for w in words), np.int64, len(words))
    base = len(vocab)
    if base == len(words):
        return 0
    code, span = ids[:n], base
    for k in range(1, width):
        if span > (2 ** 62) // base:  # renumber before the codes run over
            _, code = np.unique(code, return_inverse=True)
            span = int(code.max()) + 1
        code = code * base + ids[k:n + k]
        span *= base
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edge = np.zeros(len(words) + 1, np.int64)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: bytes, n_chars: int) -> tuple[int, ...]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    spaces = len(text) - sum(map(len, words))
    return (len(words), n_chars - spaces, len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines), text.count(b"!"),
            len(text) - len(text.translate(None, _CAPITALS)))


def _measured(batches: Iterator[pa.RecordBatch], position: int, name: str,
              passed: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(position)
        sizes = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
        rows = [measure(t, n) for t, n in zip(texts_of(column), sizes)]
        values = list(zip(*rows)) if rows else [()] * len(MEASURES)
        found = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], list(MEASURES))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in passed), found],
            [*(batch.schema.names[i] for i in passed), name])


def ledger(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, str, str]:
    """The columns of ``keep``, a struct of measurements and the failure bits; and both names."""
    name, bits = free_name(docs, "measures"), free_name(docs, "fail_bits")
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    position = rows.columns.index("text")
    passed = [rows.columns.index(c) for c in keep]
    found = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField(name, found)])
    measured = rows.mapInArrow(lambda it: _measured(it, position, name, passed), schema)
    return measured.withColumn(bits, fail_bits(name)), name, bits


def fail_bits(measures: str) -> Column:
    import re

    bits = F.lit(0).cast("long")
    for bit, (_, fails) in enumerate(RULES):
        cond = re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"{measures}.\1", fails)
        bits = bits.bitwiseOR(F.when(F.expr(cond), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def mask(policy: str) -> int:
    """The bits that a policy looks at."""
    return sum(1 << bit for bit, (name, _) in enumerate(RULES) if name in POLICIES[policy])


def passes(bits, policy: str = CURRENT) -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, bits: str = "fail_bits", policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    Bit sets are counted first (at most 2 to the number of rules), so the rest is independent
    of the number of documents.
    """
    sets = (rows.groupBy(F.col(bits).bitwiseAND(F.lit(mask(policy)).cast("long")).alias("bits"))
            .agg(F.count(F.lit(1)).alias("n")))
    names = [(bit, name) for bit, (name, _) in enumerate(RULES) if name in POLICIES[policy]]
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"),
                                         F.lit(1 << bit).cast("long").alias("bit"))
                                for bit, name in names])).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (sets.select("bits", "n", rules).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_fail"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0))
                 .alias("n_only")))


def op2(docs: DataFrame) -> DataFrame:
    rows, name, bits = ledger(docs.select("doc_id", "text"), ["doc_id"])
    return rows.select("doc_id", *[F.col(f"{name}.{m}") for m in MEASURES[:5]],
                       (~passes(bits, "v1")).alias("base_failed"),
                       passes(bits).alias("kept"), F.col(bits).alias("fail_bits"))


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows that a policy keeps, columns unchanged."""
    rows, _, bits = ledger(docs, docs.columns)
    return rows.filter(passes(bits, policy)).select(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT r, w, unnest(range(1, length(w) - 3)) AS i FROM d WHERE length(w) >= 5),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS n FROM pos),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
        FROM win, (SELECT unnest(range(0, 5)) AS k) WHERE n >= 2 GROUP BY r),
ln AS (SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
lines AS (SELECT r, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM ln GROUP BY r),
m AS (
  SELECT doc_id, CAST(length(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaims,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
b AS (
  SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
    + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_exclaims > n_words)::INT
    + 16 * (10 * n_capitals > 4 * word_chars)::INT
    + 32 * (word_chars > 12 * n_words OR 2 * word_chars < 5 * n_words)::INT
    + 64 * (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""
