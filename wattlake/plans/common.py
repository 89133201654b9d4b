"""Shared building blocks for the registered queries."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import intervals, revenue, scd2
from ..session import scratch_path
from ..sources.adapters import x_contracts, x_prices, x_prices_clean, x_products
from .oracle import with_ctes

# Fixed parameters of the test feeds: the as-of date and the newest extract.
AS_OF = _dt.date(2001, 8, 1)
NEWEST_EXTRACT = _dt.date(2001, 8, 1)
# Month split of the feeds for incremental cases: loads up to June are the
# existing history, July and August arrive as the new load.
SPLIT_TABLE = "20010701"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NOTES: dict[str, str] = {}


def register(name: str, sql: str | None = None, note: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_ctes(sql)
        if note:
            NOTES[name] = note
        return fn
    return deco


def comparable(df: DataFrame, drop: tuple[str, ...] = ("inserted_at", "contract_sk", "price_sk",
                                                       "product_sk")) -> DataFrame:
    """Decimals -> DOUBLE, clock and hash-key columns dropped."""
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ feeds
def contracts_history(spark: SparkSession, d: str) -> DataFrame:
    return scd2.scd2_contracts(x_contracts(spark, d), tiebreak=["seq"])


def clean_price_history(spark: SparkSession, d: str) -> DataFrame:
    return scd2.scd2_prices(x_prices_clean(spark, d))


def raw_price_history(spark: SparkSession, d: str) -> DataFrame:
    return scd2.scd2_prices(x_prices(spark, d))


def published(df: DataFrame) -> DataFrame:
    """Write to a fresh folder under the shared checkpoint dir and read back,
    as the warehouse job publishes a table: consumers scan the files instead
    of recomputing the plan per branch, and lineage is cut."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def clean_price_periods(spark: SparkSession, d: str) -> DataFrame:
    pieces = intervals.price_period_split(clean_price_history(spark, d), max_date=NEWEST_EXTRACT)
    return published(intervals.price_periods(pieces))


def raw_price_periods(spark: SparkSession, d: str) -> DataFrame:
    pieces = intervals.price_period_split(raw_price_history(spark, d), max_date=NEWEST_EXTRACT)
    return published(intervals.price_periods(pieces))


def mart(spark: SparkSession, d: str) -> DataFrame:
    return revenue.contract_revenue(contracts_history(spark, d), clean_price_periods(spark, d),
                                    AS_OF)


def products_history(spark: SparkSession, d: str) -> DataFrame:
    return scd2.scd2_products(x_products(spark, d))
