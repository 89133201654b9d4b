"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_landing, q_relational, q_warehouse  # noqa: F401  (register on import)
from .common import NOTES, QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def notes() -> dict[str, str]:
    return dict(NOTES)
