"""Constraint reports.

A warehouse table's UNIQUE and NOT NULL constraints become a violation
report; a writer refuses to publish a table whose report is not empty.
Both checks are single aggregations (partial, so a hot key is combined
map-side), never a collect of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = "check_name string, key_text string, violations bigint"


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key that occurs more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("violations"))
              .where(F.col("violations") > 1)
              .select(F.lit("unique").alias("check_name"),
                      F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key_text"),
                      "violations"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column holding nulls, with the number of null rows."""
    if not cols:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(f"not_null:{c}").alias("check_name"), F.col(c).alias("violations"))
        for c in cols])).alias("r"))
    return (stacked.select("r.check_name", F.lit(None).cast("string").alias("key_text"),
                           "r.violations")
                   .where(F.col("violations") > 0))


def constraint_report(df: DataFrame, unique_key: Sequence[str],
                      not_null: Sequence[str]) -> DataFrame:
    """Duplicate keys (skipped when ``unique_key`` is empty) and null counts."""
    nulls = null_counts(df, not_null)
    if not unique_key:
        return nulls
    return duplicate_keys(df, unique_key).unionByName(nulls)


class ConstraintViolation(RuntimeError):
    pass


def assert_constraints(df: DataFrame, unique_key: Sequence[str], not_null: Sequence[str]) -> None:
    """Raise when the report is non-empty; the message has the total and a few rows."""
    report = constraint_report(df, unique_key, not_null)
    sample = report.limit(5).collect()
    if sample:
        raise ConstraintViolation(f"{report.count()} constraint violations, among them: "
                                  f"{[r.asDict() for r in sample]}")
