"""Contract revenue mart.

Every stage is keyed by ``contract_id``.  After the first shuffle on that
key, later windows and groupings on (contract_id, ...) reuse the same hash
distribution, so the mart costs one contract shuffle plus the price-side
joins.  The reference's join-backs of per-contract and per-contract-year
aggregates become a projection (the years depend only on the row's own
start/end) and partition-only windows (the year totals).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions.dates import add_years, days_between
from ..schema import IN_DELIVERY, OPEN_END
from .dedup import latest_per_key
from .intervals import (contract_breakpoints, contract_periods, effective_prices, price_dedup,
                        range_join_prices)
from .joins import DEFAULT_MAX_ROWS, rows_at_most

MART_COLUMNS = ["contract_id", "productid", "period_start", "period_end", "status", "consumption",
                "startdate", "enddate", "createdat", "baseprice", "workingprice",
                "days_in_period", "days_since_start", "contract_year", "total_contract_years",
                "final_end", "terminated_mid_year", "total_days_in_year", "period_share",
                "base_cost", "variable_cost", "weighted_consumption", "consumption_share",
                "revenue", "baseprice_total_due", "inserted_at"]


def _date(d: _dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d)


def contract_input(history: DataFrame) -> DataFrame:
    """Contract versions feeding the mart.

    Drops in-delivery rows (and null status), takes usagenet else usage and
    closes open versions at the newest snapshot of (contract, product).
    That maximum is taken over the peers of the product inside a window on
    the contract alone (``rangeBetween(0, 0)`` on product_id), so this step
    and every later one share one hash distribution on contract_id.
    """
    h = history.where(F.col("status") != IN_DELIVERY)
    same_product = (Window.partitionBy("contract_id").orderBy("product_id")
                    .rangeBetween(Window.currentRow, Window.currentRow))
    newest = F.max("snapshot_date").over(same_product)
    return h.select(
        "contract_id", F.col("product_id").alias("productid"), "status",
        F.coalesce("usagenet", "usage").alias("consumption"),
        F.col("valid_from").alias("startdate"),
        F.when(F.col("valid_until") == F.lit(OPEN_END), newest)
         .otherwise(F.col("valid_until")).alias("enddate"),
        F.col("createdat").cast("date").alias("createdat"),
    ).distinct()


_HEAD_FIELDS = ["status", "consumption", "startdate", "enddate", "createdat"]
_HEAD_ORDER = ["createdat", "startdate", "productid", "enddate", "status", "consumption"]


def latest_contract(ci: DataFrame) -> DataFrame:
    """The newest-created version of each contract, full tie-break."""
    return latest_per_key(ci, ["contract_id"], _HEAD_ORDER)


def with_latest_version(ci: DataFrame, alias: str = "__head") -> DataFrame:
    """Attach the contract's newest-created version to each of its rows.

    A partition-only window aggregate on contract_id: the same answer as
    joining :func:`latest_contract` back, without a second pass over ``ci``.
    """
    w = Window.partitionBy("contract_id")
    head = F.max_by(F.struct(*_HEAD_FIELDS), F.struct(*_HEAD_ORDER)).over(w)
    return ci.withColumn(alias, head)


def contract_price_periods(ci: DataFrame, periods_table: DataFrame, as_of: _dt.date | Column,
                           yearly_pieces: bool = True, overlap: str = "latest",
                           small_prices: bool | None = None) -> DataFrame:
    """Periods inside the newest version of each contract, priced at their
    start (I9, C3, C6, B14).

    One linear chain on the contract distribution: latest version attached
    by window, breakpoints exploded (own dates + the product's price dates),
    distinct, lead, filter, range join to the (small) price side, whose
    overlaps were resolved beforehand so each period gets at most one price:
    the latest (``overlap="latest"``), or the job fails where a period has
    several (``"error"``: the table's unique key as it stands, Q19).
    ``small_prices`` states whether the price side may be broadcast; by default
    it is counted.
    """
    if overlap not in ("latest", "error"):
        raise ValueError(f"overlap must be 'latest' or 'error', not {overlap!r}")
    # One bounded count of the price periods bounds both price-side lookups
    # (one row per product; at most two segments per period), so both are
    # broadcast behind this single check or both stay shuffle joins.
    small = rows_at_most(periods_table, DEFAULT_MAX_ROWS // 2) if small_prices is None else small_prices
    head = [f"__h_{c}" for c in _HEAD_FIELDS]
    ci_h = with_latest_version(ci).select(
        *ci.columns, *[F.col(f"__head.{c}").alias(f"__h_{c}") for c in _HEAD_FIELDS])
    bp = contract_breakpoints(ci_h, periods_table, extra=head, small_prices=small,
                              within=("__h_startdate", "__h_enddate"))
    # The head's creation date is constant per contract; carrying it as a
    # window key lets report filters on createdat skip whole contracts early.
    periods = contract_periods(bp, extra=head, constant_per_contract=[F.col("__h_createdat")])
    inside = (periods
              .where((F.col("period_start") >= F.col("__h_startdate"))
                     & (F.col("__h_enddate").isNull()
                        | (F.col("period_start") < F.col("__h_enddate")))
                     & (F.col("period_start") < _date(as_of)))
              .select("contract_id", "productid", "period_start", "period_end",
                      *[F.col(f"__h_{c}").alias(c) for c in _HEAD_FIELDS]))
    prices = effective_prices(price_dedup(periods_table), yearly_pieces).drop("__pf", "__pu")
    return range_join_prices(inside, prices, yearly_pieces=yearly_pieces, small_prices=small,
                             strict=overlap == "error")


def prorate(cpp: DataFrame, as_of: _dt.date | Column,
            run_ts: _dt.datetime | Column | None = None) -> DataFrame:
    """Contract years, shares, costs and revenue.

    * days_in_period = end - start; days_since_start = start - startdate
    * contract_year = floor(days_since_start / 365)
    * total_contract_years = ceil((coalesce(enddate, as_of) - startdate) / 365)
    * terminated_mid_year = final_end < startdate + total years
    * period_share = days / days of the contract year
    * base_cost = the year's largest base price x period_share
    * variable_cost = working price (ct) / 100 x consumption x days / 365
    * revenue = base_cost + variable_cost; baseprice_total_due = years x base price
    All roundings are half away from zero on exact decimals.
    """
    final_end = F.coalesce(F.col("enddate"), _date(as_of))
    b = (cpp
         .withColumn("days_in_period", days_between("period_end", "period_start"))
         .withColumn("days_since_start", days_between("period_start", "startdate"))
         .withColumn("contract_year", F.floor(F.col("days_since_start") / F.lit(365)).cast("int"))
         .withColumn("final_end", final_end)
         .withColumn("total_contract_years",
                     F.ceil(days_between(final_end, "startdate") / F.lit(365)).cast("int"))
         .withColumn("terminated_mid_year",
                     F.col("final_end") < add_years("startdate", F.col("total_contract_years"))))
    # createdat is the contract's own (one value per contract): as a partition
    # key it changes no group, but lets report filters on it pass this window.
    year = Window.partitionBy("contract_id", "createdat", "contract_year")
    y = (b.withColumn("total_days_in_year", F.sum("days_in_period").over(year))
          .withColumn("__year_bp", F.max("baseprice").over(year)))

    days = F.col("days_in_period")
    total = F.col("total_days_in_year")
    qty = F.col("consumption").cast(N.QTY)
    usage_days = qty * days.cast(N.DAYS)  # exact integer product
    wp = F.coalesce(F.col("workingprice"), F.lit(0))
    out = (y
           .withColumn("period_share", N.day_share(days, total).cast("decimal(12,6)"))
           .withColumn("base_cost", N.amount_share("__year_bp", days, total).cast("decimal(18,6)"))
           .withColumn("variable_cost",
                       N.per_year_of_days(usage_days, amount=wp, divisor=36500)
                       .cast("decimal(18,6)"))
           .withColumn("weighted_consumption", N.per_year_of_days(usage_days).cast("decimal(18,6)"))
           .withColumn("consumption_share",
                       F.when(qty != 0, N.day_share(days, F.lit(365))).cast("decimal(12,6)"))
           .withColumn("revenue", F.round(F.col("base_cost") + F.col("variable_cost"), 6)
                       .cast("decimal(18,6)"))
           .withColumn("baseprice_total_due",
                       F.round(F.col("total_contract_years").cast("decimal(10,0)")
                               * F.col("baseprice").cast(N.PRICE), 2).cast("decimal(18,2)"))
           .withColumn("inserted_at", (run_ts if isinstance(run_ts, Column) else F.lit(run_ts))
                       .cast("timestamp_ntz")))
    return out.select(*MART_COLUMNS)


def contract_revenue(history: DataFrame, periods_table: DataFrame, as_of: _dt.date | Column,
                     run_ts: _dt.datetime | Column | None = None,
                     yearly_pieces: bool = True, overlap: str = "latest") -> DataFrame:
    """History + price periods -> ``contract_price_enriched``."""
    ci = contract_input(history)
    cpp = contract_price_periods(ci, periods_table, as_of, yearly_pieces=yearly_pieces, overlap=overlap)
    return prorate(cpp, as_of, run_ts)
