"""Analyst reports over the warehouse.

All are one grouped aggregation (partial + final, one shuffle of the
pre-aggregated rows).  ``first_last_change`` reduces a grouped series to one
row with ``min_by``/``max_by``; the series itself is already aggregated.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_month_first
from ..operators.filters import active_on, month_before_matches
from ..schema import IN_DELIVERY


def _date(d: _dt.date | str | Column) -> Column:
    """A date parameter; text is read month first, ``10.01.2020`` = 1 Oct (Q25)."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        return parse_month_first(F.lit(d))
    return F.lit(d)


def revenue_by_created_product(mart: DataFrame, ordered: bool = True) -> DataFrame:
    """SUM(revenue), SUM(consumption) by createdat, productid."""
    out = (mart.groupBy("createdat", "productid")
               .agg(F.sum("revenue").alias("sum_revenue"),
                    F.sum("consumption").alias("sum_consumption")))
    return out.orderBy("createdat", "productid") if ordered else out


def revenue_by_created(mart: DataFrame, start: _dt.date | Column, end: _dt.date | Column,
                       ordered: bool = True) -> DataFrame:
    """The same by createdat inside an inclusive date range."""
    out = (mart.where(F.col("createdat").between(_date(start), _date(end)))
               .groupBy("createdat")
               .agg(F.sum("revenue").alias("sum_revenue"),
                    F.sum("consumption").alias("sum_consumption")))
    return out.orderBy("createdat") if ordered else out


def average_revenue_by_created(mart: DataFrame, start: _dt.date | Column,
                               end: _dt.date | Column) -> DataFrame:
    """The README's question read literally: AVG instead of SUM (Q24 option).

    The mean revenue is rounded once to 6 decimals from the exact sum.
    """
    return (mart.where(F.col("createdat").between(_date(start), _date(end)))
                .groupBy("createdat")
                .agg(F.round(F.sum("revenue") / F.count("revenue").cast("decimal(20,0)"), 6)
                      .alias("avg_revenue"),
                     F.avg("consumption").alias("avg_consumption")))


def first_last_change(series: DataFrame, day_col: str, value_col: str) -> DataFrame:
    """Relative change from the first to the last day of a series.

    ``change_ratio = round((last - first) / first, 6)``, exact decimals.
    """
    v = F.col(value_col).cast("decimal(20,6)")
    one = series.agg(F.min(day_col).alias("first_day"), F.max(day_col).alias("last_day"),
                     F.min_by(v, F.col(day_col)).alias("first_value"),
                     F.max_by(v, F.col(day_col)).alias("last_value"))
    change = F.round((F.col("last_value") - F.col("first_value"))
                     / F.nullif(F.col("first_value"), F.lit(0)), 6)
    return one.withColumn("change_ratio", change)


def count_in_delivery(history: DataFrame, on: _dt.date | Column) -> DataFrame:
    """COUNT(DISTINCT contract_id) in delivery on a date."""
    return (history.where((F.col("status") == IN_DELIVERY)
                          & active_on("startdate", "enddate", _date(on)))
                   .agg(F.countDistinct("contract_id").alias("contracts_in_delivery")))


def new_contracts(history: DataFrame) -> DataFrame:
    """Rows whose created month is the month before the snapshot.

    As coded the year is ignored; ``new_contracts_in_month`` keeps it.
    """
    return history.where(month_before_matches("snapshot_date", "createdat"))


def new_contracts_in_month(history: DataFrame) -> DataFrame:
    """Year-aware variant of :func:`new_contracts` (Q24 option)."""
    prev = F.add_months("snapshot_date", -1)
    return history.where((F.month(prev) == F.month("createdat"))
                         & (F.year(prev) == F.year("createdat")))


def rows_per_source(df: DataFrame, source_col: str = "source_table") -> DataFrame:
    """Rows loaded per staged table."""
    return df.groupBy(source_col).agg(F.count(F.lit(1)).alias("rows_loaded"))


def year_totals(mart: DataFrame) -> DataFrame:
    """SUM(days), MAX(baseprice) per contract year."""
    return (mart.groupBy("contract_id", "contract_year")
                .agg(F.sum("days_in_period").alias("total_days_in_year"),
                     F.max("baseprice").alias("baseprice")))


def contract_terms(mart: DataFrame) -> DataFrame:
    """Distinct contract terms: GROUP BY without aggregates."""
    return mart.select("contract_id", "startdate", "enddate", "total_contract_years",
                       "final_end").distinct()
