"""Price validity cut into yearly pieces, price periods, contract breakpoints
and contract periods (I4, I5, I7, I8, C5, C6, C9, C10, G2).

Scale notes
-----------
* The price side (prices, price periods) grows with the product catalogue,
  not with contracts.  Lookups built from it are broadcast only after a
  bounded row count of the price periods; beyond the bound the same
  equi-joins run as shuffle joins.
* Price pieces never cross 31 December, so the broadcast range join also
  matches on the year of the period start; beyond the bound the join is by
  product and month, with hot months of a product split into shares.
* Overlapping price periods are resolved on the price side
  (:func:`effective_prices`), so each contract period meets at most one.
* Windows on contracts run on rows unique per (contract, product, date):
  a contract's group is bounded by the calendar, not by copies.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import year_end, yearly_step
from ..schema import BASE_COMPONENT, WORKING_COMPONENT
from ..session import written
from .dedup import latest_per_key
from .joins import maybe_broadcast, rows_at_most
from .sweep import swept


def _date_value(d: _dt.date | Column | None) -> Column | None:
    if d is None:
        return None
    return d if isinstance(d, Column) else F.lit(d)


def newest_extract_date(prices: DataFrame) -> DataFrame:
    """One-row frame ``(max_date)``: the newest extraction date."""
    return prices.agg(F.max(F.to_date("extracted_at")).alias("max_date"))


def pick_prices(prices: DataFrame, pick: str = "longest") -> DataFrame:
    """Price versions that define periods, one per price_id.

    ``longest`` (as coded): the version with the latest valid_until, ties by
    newest modificationdate then lineage.  ``current``: the current version.
    """
    p = prices.where(F.col("pricecomponentid").isin(BASE_COMPONENT, WORKING_COMPONENT))
    if pick == "longest":
        order = ["valid_until", "modificationdate", "source_table"]
    elif pick == "current":
        p = p.where(F.col("is_current"))
        order = ["modificationdate", "source_table"]
    else:
        raise ValueError(f"pick must be 'longest' or 'current', not {pick!r}")
    cols = ["price_id", "product_id", "pricecomponentid", "pricecomponent", "price", "unit",
            "valid_from", "valid_until", "modificationdate", "source_table"]
    return latest_per_key(p.select(*cols), ["price_id"], order)


def with_max_date(df: DataFrame, prices: DataFrame,
                  max_date: _dt.date | Column | None) -> DataFrame:
    """Attach the snapshot date as column ``__max_date``.

    A given date becomes a literal; otherwise the newest extract date is a
    one-row aggregate cross-joined in (C7) - broadcasting one row is bounded.
    """
    if max_date is not None:
        return df.withColumn("__max_date", _date_value(max_date))
    one = newest_extract_date(prices).select(F.col("max_date").alias("__max_date"))
    return df.crossJoin(F.broadcast(one))


def split_yearly(df: DataFrame, start: str = "valid_from", until: str = "valid_until",
                 drift: bool = True, calendar_year: bool = False) -> DataFrame:
    """Cut ``[start, until]`` into pieces that never cross 31 December.

    Piece k starts one year after piece k-1 (``generate_series`` with a
    one-year step; ``drift`` keeps its 29 Feb -> 28 Feb behaviour) and ends
    at ``min(until, 31 Dec of its year)``.  ``calendar_year=True`` starts
    pieces after the first on 1 January instead, leaving no gaps.
    Empty intervals (start > until) yield nothing.  Adds ``period_start``,
    ``period_end``.
    """
    s, u = F.col(start), F.col(until)
    valid = df.where(s.isNotNull() & u.isNotNull() & (s <= u))
    n = F.year(u) - F.year(s)
    exploded = valid.withColumn("__k", F.explode(F.sequence(F.lit(0), n)))
    k = F.col("__k")
    if calendar_year:
        piece = F.when(k == 0, s).otherwise(F.make_date(F.year(s) + k, F.lit(1), F.lit(1)))
    else:
        piece = yearly_step(s, k, drift=drift)
    return (exploded.withColumn("period_start", piece)
            .where(F.col("period_start") <= u)
            .withColumn("period_end", F.least(u, year_end("period_start")))
            .drop("__k"))


def price_period_split(prices: DataFrame, max_date: _dt.date | Column | None = None,
                       pick: str = "longest", drift: bool = True,
                       calendar_year: bool = False) -> DataFrame:
    """Base and working price versions cut into yearly pieces (I4).

    Output: product_id, pricecomponentid, price_id, price, period_start,
    period_end, snapshot_date.
    """
    picked = pick_prices(prices, pick)
    clipped = (with_max_date(picked, prices, max_date)
               .select("product_id", "pricecomponentid", "price_id", "price", "valid_from",
                       F.least(F.col("valid_until"), F.col("__max_date")).alias("valid_until"),
                       F.col("__max_date").alias("snapshot_date")))
    pieces = split_yearly(clipped, drift=drift, calendar_year=calendar_year)
    return pieces.select("product_id", "pricecomponentid", "price_id", "price", "period_start",
                         "period_end", "snapshot_date")


def price_periods(pieces: DataFrame, run_ts: _dt.datetime | Column | None = None) -> DataFrame:
    """Distinct product periods with their base and working price.

    A period is a (product, start, end) that a base or a working piece has.
    Base and working meet only on identical bounds.  Where several prices of
    one component share a period, the largest price_id is kept (the
    deterministic form of ``ON CONFLICT DO NOTHING``).  One grouped pass
    replaces the union + two left joins + conflict filter, and never forms
    base x working pairs.
    """
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    comp = F.col("pricecomponentid")

    def best(component: int) -> Column:
        hit = comp == component
        row = F.struct(F.col("price_id").alias("id"), comp.alias("cid"), F.col("price").alias("p"))
        return F.max_by(F.when(hit, row), F.when(hit, F.col("price_id")))

    g = (pieces.groupBy("snapshot_date", "product_id",
                        F.col("period_start").alias("valid_from"),
                        F.col("period_end").alias("valid_until"))
         .agg(best(BASE_COMPONENT).alias("__b"), best(WORKING_COMPONENT).alias("__w")))
    return g.select(
        "snapshot_date", F.col("product_id").cast("int").alias("product_id"),
        F.col("__b.cid").alias("base_pricecomponentid"),
        F.col("__w.cid").alias("working_pricecomponentid"),
        F.col("__b.id").alias("base_id"), F.col("__w.id").alias("working_id"),
        "valid_from", "valid_until",
        F.col("__b.p").alias("baseprice"), F.col("__w.p").alias("workingprice"),
        ts.cast("timestamp_ntz").alias("inserted_at"))


def price_periods_aligned(pieces: DataFrame, run_ts: _dt.datetime | Column | None = None,
                          yearly_pieces: bool = False) -> DataFrame:
    """``align=True`` (Q12): base and working pieces intersected.

    Per product the bounds of all pieces cut the timeline into elementary
    segments [b_i, b_{i+1} - 1]; each segment covered by any piece gets the
    base and the working price valid on it (largest price_id if several).  One
    sweep over each product's distinct pieces, each year by itself with
    ``yearly_pieces`` (no piece crosses a year's end).  Works on the
    catalogue-sized price side only.
    """
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    comp = F.col("pricecomponentid")
    best = (pieces.where(comp.isin(BASE_COMPONENT, WORKING_COMPONENT))
            .groupBy("snapshot_date", "product_id", "pricecomponentid", "period_start", "period_end")
            .agg(F.max("price_id").alias("price_id"), F.max_by("price", "price_id").alias("price")))
    keys = {"snapshot_date": F.col("snapshot_date"), "product_id": F.col("product_id")}
    if yearly_pieces:
        keys["year"] = F.year("period_start")
    g = swept(best, keys, "period_start", "period_end", [F.col("price_id")],
              ["price_id", "pricecomponentid", "price"], channel=(comp == WORKING_COMPONENT).cast("int"), channels=2)
    return g.select(
        "snapshot_date", F.col("product_id").cast("int").alias("product_id"),
        F.col("pricecomponentid_0").alias("base_pricecomponentid"),
        F.col("pricecomponentid_1").alias("working_pricecomponentid"),
        F.col("price_id_0").alias("base_id"), F.col("price_id_1").alias("working_id"),
        F.col("seg_from").alias("valid_from"), F.col("seg_until").alias("valid_until"),
        F.col("price_0").alias("baseprice"), F.col("price_1").alias("workingprice"),
        ts.cast("timestamp_ntz").alias("inserted_at"))


def latest_snapshot(periods: DataFrame) -> DataFrame:
    """Rows of the newest ``snapshot_date`` (scalar subquery, C8).

    The maximum is a one-row aggregate; Spark plans it as a scalar subquery
    evaluated once and reused.
    """
    newest = periods.agg(F.max("snapshot_date")).scalar()
    return periods.where(F.col("snapshot_date") == newest)


def price_dedup(periods: DataFrame) -> DataFrame:
    """MAX(baseprice), MAX(workingprice) per product period (D3)."""
    return (latest_snapshot(periods)
            .groupBy("product_id", "valid_from", "valid_until")
            .agg(F.max("baseprice").alias("baseprice"),
                 F.max("workingprice").alias("workingprice")))


def effective_prices(dedup: DataFrame, yearly_pieces: bool = True) -> DataFrame:
    """Non-overlapping price segments with the overlap rule applied (Q19).

    Each product's timeline is cut at every period bound; a segment lies
    wholly inside or outside each period, and takes the prices of the
    covering period with the latest valid_from, then valid_until - the
    row the mart keeps when several periods match one start.  One sweep on the
    catalogue-sized price side (:mod:`sweep`), so the contract side's range
    join matches at most one row and needs no dedup.  ``yearly_pieces``: no
    period crosses a year's end, so each year is swept by itself.  Keeps
    ``__pf``/``__pu``, the chosen period's bounds, and ``__open``, the number of
    periods that cover the segment.  ``dedup`` has one row per product and bounds.
    """
    keys = {"product_id": F.col("product_id")}
    if yearly_pieces:
        keys["year"] = F.year("valid_from")
    best = swept(dedup, keys, "valid_from", "valid_until", [F.unix_date("valid_from"), F.unix_date("valid_until")],
                 ["baseprice", "workingprice", "valid_from", "valid_until"])
    return best.select("product_id", F.col("seg_from").alias("valid_from"),
                       F.col("seg_until").alias("valid_until"),
                       F.col("baseprice_0").alias("baseprice"),
                       F.col("workingprice_0").alias("workingprice"),
                       F.col("valid_from_0").alias("__pf"), F.col("valid_until_0").alias("__pu"),
                       F.col("n_open").alias("__open"))


def product_price_dates(periods: DataFrame) -> DataFrame:
    """Per product, the distinct bounds of its newest price periods.

    (product, date) pairs are made distinct first (a partial aggregate), so
    the array collected per product holds distinct days only: bounded by the
    calendar even for a product owning a large share of the price table.
    """
    bounds = (latest_snapshot(periods)
              .select(F.col("product_id").alias("productid"),
                      F.explode(F.array("valid_from", "valid_until")).alias("d"))
              .distinct())
    return bounds.groupBy("productid").agg(F.collect_list("d").alias("price_dates"))


def contract_breakpoints(contract_input: DataFrame, periods: DataFrame,
                         extra: Sequence[str] = (), small_prices: bool | None = None,
                         within: tuple[str, str] | None = None) -> DataFrame:
    """Distinct breakpoint dates per (contract, product).

    The correlated LATERAL union is decorrelated into one pass.  Each
    (contract, product) first gathers its own dates (start, created, end of
    every version: bounded by its versions, and grouped under the contract
    distribution, so no shuffle), then meets its product's price-date array
    (one row per product; broadcast when the price periods pass a bounded
    row count, which bounds the lookup too, else a shuffle join).  The union
    of the two arrays is exploded once per pair and is already distinct.

    ``within`` names two of ``extra``: only dates from the first to the second
    (null: open) are kept, before the explode.  Both bounds being breakpoints
    of the contract themselves, the periods between them stay the same.
    """
    own = (contract_input
           .groupBy("contract_id", "productid", *extra)
           .agg(F.array_distinct(F.flatten(F.collect_list(
               F.array("startdate", "createdat", "enddate")))).alias("__own")))
    if small_prices is None:
        small_prices = rows_at_most(periods)
    lookup = maybe_broadcast(product_price_dates(periods), small_prices)
    x = own.join(lookup, "productid", "left")
    dates = F.array_union(F.col("__own"),
                          F.coalesce(F.col("price_dates"), F.array().cast("array<date>")))
    if within is not None:
        low, high = F.col(within[0]), F.col(within[1])
        dates = F.filter(dates, lambda d: (d >= low) & (high.isNull() | (d <= high)))
    return (x.select("contract_id", "productid", *extra, F.explode(dates).alias("date_value"))
             .where(F.col("date_value").isNotNull()))


def contract_periods(breakpoints: DataFrame, extra: Sequence[str] = (),
                     constant_per_contract: Sequence[Column] = ()) -> DataFrame:
    """Consecutive breakpoints of a contract -> [period_start, period_end).

    The lead runs per contract only, so products of one contract interleave
    (as coded); ties on a date are ordered by product.  Open-ended and
    zero-length periods are dropped.  ``constant_per_contract`` may name
    expressions that are functions of the contract (e.g. its newest
    version's creation date).
    """
    kept, _ = _successive(breakpoints, extra, constant_per_contract)
    return kept


def removed_periods(breakpoints: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The intervals that :func:`contract_periods` deletes: open-ended or of no length."""
    _, removed = _successive(breakpoints, extra)
    return removed


def _successive(breakpoints: DataFrame, extra: Sequence[str], constant_per_contract: Sequence[Column] = ()
                ) -> tuple[DataFrame, DataFrame]:
    """Breakpoints paired with the next one of their contract: intervals kept, and the others."""
    # Columns constant within a contract may join the partition key: the
    # groups stay the same, and filters on them can be pushed below the lead.
    w = (Window.partitionBy(F.col("contract_id"), *constant_per_contract)
         .orderBy("date_value", "productid"))
    pairs = breakpoints.select("contract_id", "productid", *extra, F.col("date_value").alias("period_start"),
                               F.lead("date_value").over(w).alias("period_end"))
    keep = F.col("period_end").isNotNull() & (F.col("period_start") != F.col("period_end"))
    return pairs.where(keep), pairs.where(~keep)


# A (product, month) with more than 1/HOT_BINS of the starts is split into shares of that size.
HOT_BINS = 256


def _binned(periods: DataFrame, start_col: str) -> tuple[DataFrame, DataFrame, tuple]:
    """``periods`` written with the month of the start, its hot months, and (rows, first and last month).

    ``hot`` has (product, month, shares) of each that holds more than 1/HOT_BINS of the starts.
    """
    periods = written(periods.withColumn("__bin", F.trunc(start_col, "MM")), "range-join")
    total, first, last = periods.agg(F.count(F.lit(1)), F.min("__bin"), F.max("__bin")).first()
    share = max(1, -(-total // HOT_BINS))
    n = periods.groupBy("productid", "__bin").agg(F.count(F.lit(1)).alias("__n"))
    hot = (n.where((F.col("__n") > share) & F.col("productid").isNotNull() & F.col("__bin").isNotNull())
           .select(F.col("productid").alias("__hp"), F.col("__bin").alias("__hb"),
                   F.ceil(F.col("__n") / share).cast("int").alias("__shares")))
    return periods, hot, (total, first, last)


def _split_starts(periods: DataFrame, hot: DataFrame) -> DataFrame:
    """``periods`` with their join keys ``__jp`` and ``__share`` beside ``__bin``."""
    spread = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in periods.columns])
    alone = F.col("productid").isNull() | F.col("__bin").isNull()
    left = (periods.join(F.broadcast(hot), (F.col("productid") == F.col("__hp")) & (F.col("__bin") == F.col("__hb")), "left")
            .withColumn("__share", F.when(alone, F.pmod(spread, F.lit(HOT_BINS)))
                        .otherwise(F.pmod(spread, F.coalesce("__shares", F.lit(1)))).cast("int"))
            .drop("__hp", "__hb", "__shares"))
    # Starts that match nothing get keys of their own, so they do not meet in one task.
    return left.withColumn("__jp", F.when(alone, F.concat(F.lit("-"), F.col("__share").cast("string")))
                           .otherwise(F.col("productid").cast("string")))


def _binned_join(periods: DataFrame, p: DataFrame, cond: Column, start_col: str) -> DataFrame:
    """Left range join by shuffle: equal product and month, then the range itself.

    A price is repeated for every month it covers that has starts.  The starts of
    each (product, month) are counted in two phases; one with more than
    1/HOT_BINS of all (fewer than HOT_BINS of them, broadcast whatever the size of
    the table) is cut into shares of about that many rows, and its prices are
    repeated for every share.  So no task holds a hot product, nor 1 January of it.
    ``periods`` is written once, as the counts and the join both read it; starts
    without a product or date match nothing and are spread likewise.
    """
    periods, hot, (total, first, last) = _binned(periods, start_col)
    left = _split_starts(periods, hot)
    low = F.greatest(F.trunc("__vf", "MM"), F.lit(first).cast("date"))
    high = F.least(F.trunc("__vu", "MM"), F.lit(last).cast("date"))
    months = F.sequence("__low", "__high", F.expr("interval 1 month"))
    right = (p.where(F.lit(total > 0) & (F.col("__vf") <= F.col("__vu")))
             .withColumns({"__low": low, "__high": high}).where(F.col("__low") <= F.col("__high"))
             .withColumn("__pb", F.explode(months)).drop("__low", "__high")
             .join(F.broadcast(hot), (F.col("__pid") == F.col("__hp")) & (F.col("__pb") == F.col("__hb")), "left")
             .withColumn("__ps", F.explode(F.sequence(F.lit(0), F.coalesce("__shares", F.lit(1)) - 1)))
             .drop("__hp", "__hb", "__shares").withColumn("__pj", F.col("__pid").cast("string")))
    on = ((F.col("__jp") == F.col("__pj")) & (F.col("__bin") == F.col("__pb")) & (F.col("__share") == F.col("__ps")))
    return left.join(right, on & cond, "left").drop("__jp", "__bin", "__share", "__pj", "__pb", "__ps")


def range_join_prices(periods: DataFrame, prices: DataFrame, yearly_pieces: bool = True,
                      start_col: str = "period_start", small_prices: bool | None = None,
                      strict: bool = False) -> DataFrame:
    """Left join each period to the price valid at its start.

    ``product = product AND start BETWEEN valid_from AND valid_until``.  With
    ``yearly_pieces`` the year of the start must equal the year of
    valid_from, which holds for pieces from :func:`split_yearly` and turns the
    range into an equi key plus a small residual.  Prices beyond the bound are
    joined by month, hot months of a product in shares (:func:`_binned_join`).  With non-overlapping
    prices (:func:`effective_prices`) each period matches at most one row.
    ``strict`` fails the job where a start lies in several of the periods that
    such a segment (its ``__open``) stands for: they would be rows of one key.
    """
    base = F.col("baseprice")
    if strict:
        clash = F.concat(F.lit("several price periods of product "), F.col("product_id").cast("string"),
                         F.lit(" cover "), F.col("valid_from").cast("string"),
                         F.lit(": the key (contract_id, productid, period_start) is not unique"))
        broken = F.when(F.col("__open") > 1, clash)
    else:
        broken = F.lit(None).cast("string")
    p = prices.select(F.col("product_id").alias("__pid"), F.col("valid_from").alias("__vf"),
                      F.col("valid_until").alias("__vu"), base, "workingprice", broken.alias("__clash"))
    cond = ((F.col("productid") == F.col("__pid"))
            & F.col(start_col).between(F.col("__vf"), F.col("__vu")))
    small = rows_at_most(prices) if small_prices is None else small_prices
    if not small:
        joined = _binned_join(periods, p, cond, start_col)
    else:
        if yearly_pieces:
            p = p.withColumn("__py", F.year("__vf"))
            periods = periods.withColumn("__sy", F.year(start_col))
            cond = cond & (F.col("__sy") == F.col("__py"))
        joined = periods.join(F.broadcast(p), cond, "left")
    if strict:
        joined = joined.withColumn("baseprice", F.when(F.col("__clash").isNotNull(), F.raise_error(
            F.col("__clash")).cast(joined.schema["baseprice"].dataType)).otherwise(F.col("baseprice")))
    return joined.drop("__clash", "__pid", "__py", "__sy", "__vf", "__vu")
