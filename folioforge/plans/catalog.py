"""Every query of the library with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import block_queries, composite_queries, connector_queries, relational_queries, row_queries

MODULES = (row_queries, block_queries, relational_queries, connector_queries, composite_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}
