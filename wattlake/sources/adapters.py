"""Adapters: shape the driver's test tables into landing-like feeds.

The warehouse's own inputs (contract CSVs) are not shipped, so the
registered queries run on feeds derived from ``orders`` and ``part``.  Each
adapter is a pure projection of one table (plus, for ``x_prices_clean``, a
three-way unnest), so its size grows with the scale factor.  The same feeds
are written in SQL for the DuckDB oracle (``plans.oracle``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(base: _dt.date, offset: Column) -> Column:
    return F.date_add(F.lit(base), offset.cast("int"))


def x_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing file names ``YYYYMMDDHHMMSS_<entity>.csv`` built from orders."""
    o = _table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    entity = (F.when(k % 4 == 0, "products").when(k % 4 == 1, "prices")
              .when(k % 4 == 2, "contracts").otherwise("misc"))
    name = F.concat(
        F.regexp_replace(F.substring(F.col("o_orderdate").cast("string"), 1, 7), "-", ""),
        F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("220037_"), entity, F.lit(".csv"))
    return o.select(name.alias("file_name"))


def x_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several versions per product: ``id = p_partkey % 200``."""
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        (k % 200).alias("id"),
        F.col("p_name").alias("productname"),
        F.col("p_type").alias("energy"),
        F.col("p_brand").alias("consumptiontype"),
        (F.col("p_size") % 2).cast("int").alias("deleted"),
        F.when(F.col("p_size") % 5 == 0, F.lit("no_data"))
         .otherwise(F.col("p_size").cast("string")).alias("releasedversion"),
        _day(_dt.date(1995, 1, 1), k % 2000).alias("modificationdate"),
        F.concat((F.lit(20010401) + (k % 5) * 100).cast("string"),
                 F.lit("220037_products_staging_20260101_220057123")).alias("source_table"),
        k.alias("seq"),
    )


def x_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping validity, a quarter open-ended, a third not component 1 or 2."""
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    shift = (k * 37) % 2000
    return p.select(
        k.alias("id"),
        (k % 50).alias("productid"),
        (1 + F.col("p_size") % 3).cast("int").alias("pricecomponentid"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("price"),
        _day(_dt.date(1995, 1, 1), shift).alias("valid_from"),
        F.when(k % 4 == 0, F.lit(_dt.date(9999, 12, 31)))
         .otherwise(_day(_dt.date(1995, 1, 1), shift + F.col("p_size") * 30)).alias("valid_until"),
        _day(_dt.date(1994, 12, 1), k % 28).alias("modificationdate"),
    )


def x_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About ten versions per contract, same-day duplicates, outliers, null usagenet."""
    o = _table(spark, sf_dir, "orders")
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", "active")
              .when(F.col("o_orderstatus") == "O", "indelivery").otherwise("terminated"))
    odate = F.col("o_orderdate").cast("date")
    return o.select(
        c.alias("id"),
        (c % 50).alias("productid"),
        status.alias("status"),
        F.floor(F.col("o_totalprice") / 25).cast("int").alias("usage"),
        F.when(k % 3 == 0, F.lit(None).cast("int"))
         .otherwise(F.floor(F.col("o_totalprice") / 26).cast("int")).alias("usagenet"),
        _day(_dt.date(1995, 1, 1), c % 365).alias("createdat"),
        _day(_dt.date(1995, 1, 31), c % 365).alias("startdate"),
        F.when(k % 4 == 0, F.date_add(odate, 365)).alias("enddate"),
        F.col("o_orderpriority").alias("type"),
        odate.alias("modificationdate"),
        F.concat((F.lit(20010401) + (k % 5) * 100).cast("string"),
                 F.lit("220037_contracts_staging_20260101_220057123")).alias("source_table"),
        k.alias("seq"),
    )


def x_prices_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per product, component and year; base and working aligned.

    Every part row is a version of the price ``(p_partkey % 350, k)``: the
    validity depends on that id only, later parts carry later modification
    dates, so the feed grows with the table while the periods stay one per
    product and year (every fifth product starts in July).
    """
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    slot = k % 350
    comp = F.col("k")
    year = F.floor(slot / 50)
    july = k % 5 == 0
    return (p.select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k"))
            .select(
                (slot * 3 + comp).cast("bigint").alias("id"),
                (k % 50).alias("productid"),
                comp.alias("pricecomponentid"),
                F.when(comp == 2, F.col("p_size") + 4)
                 .otherwise(F.col("p_retailprice") / 100).cast("decimal(18,4)").alias("price"),
                F.make_date((1995 + year).cast("int"), F.when(july, 7).otherwise(1), F.lit(1))
                 .alias("valid_from"),
                F.when(year == 6, F.lit(_dt.date(9999, 12, 31)))
                 .when(july, F.make_date((1996 + year).cast("int"), F.lit(6), F.lit(30)))
                 .otherwise(F.make_date((1995 + year).cast("int"), F.lit(12), F.lit(31)))
                 .alias("valid_until"),
                _day(_dt.date(1994, 12, 1), F.floor(k / 350)).alias("modificationdate"),
            ))
