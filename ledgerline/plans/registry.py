"""The query list: name -> Spark query, and name -> SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return register


def load_all() -> None:
    # flow_queries first: other modules build on its SQL parts
    from ledgerline.plans import flow_queries  # noqa: F401, I001
    from ledgerline.plans import (  # noqa: F401
        budget_queries,
        landing_queries,
        payroll_queries,
        question_queries,
        upkeep_queries,
    )
