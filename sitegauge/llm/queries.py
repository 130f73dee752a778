"""Queries and SQL oracles of this folder's operators."""

from __future__ import annotations

from . import (grading, katz, langid, lexical, linededup, mixing, neardup, onebit, packing, passages,
               pii, pivots, rules)
from .common import read


def _on(table, operator):
    return lambda spark, sf_dir: operator(read(spark, sf_dir, table))


QUERIES = {
    "op1_source_mix": _on("documents", mixing.op1),
    "op2_quality_rules": _on("documents", rules.op2),
    "op3_near_duplicates": _on("documents", neardup.op3),
    "op4_best_fit_packing": _on("documents", packing.op4),
    "op5_line_dedup": _on("documents", linededup.op5),
    "op6_personal_data": _on("documents", pii.op6),
    "op7_quality_grades": lambda spark, sf_dir: grading.op7(read(spark, sf_dir, "documents"),
                                                            read(spark, sf_dir, "labels")),
    "op8_one_bit_search": _on("embeddings", onebit.op8),
    "op9_katz_scores": _on("documents", katz.op9),
    "op10_language_id": _on("documents", langid.op10),
    "op11_lexical_search": lambda spark, sf_dir: lexical.op11(read(spark, sf_dir, "documents"),
                                                              read(spark, sf_dir, "benchmark")),
    "op12_pivot_codes": _on("embeddings", pivots.op12),
    "op13_repeated_passages": _on("documents", passages.op13),
}

ORACLES = {
    "op1_source_mix": mixing.ORACLE,
    "op2_quality_rules": rules.ORACLE,
    "op3_near_duplicates": neardup.ORACLE,
    "op5_line_dedup": linededup.ORACLE,
    "op8_one_bit_search": onebit.ORACLE,
    "op11_lexical_search": lexical.ORACLE,
    "op12_pivot_codes": pivots.ORACLE,
    "op13_repeated_passages": passages.ORACLE,
}
