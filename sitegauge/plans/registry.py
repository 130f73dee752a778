"""Query registry: name -> callable(spark, sf_dir), and name -> oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; ``oracle`` is SQL over the same tables."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            # the same tie offset as functions.common.r6
            ORACLES[name] = re.sub(r"(?<!, \d)(?<!\(\d), 6\)", " + 1e-10, 6)", oracle.strip())
        return fn

    return register
