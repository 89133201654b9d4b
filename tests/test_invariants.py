"""Invariants on the mart and order independence."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wattlake.plans.common import mart


def test_mart_key_unique_and_shares_sum_to_one(spark):
    m = mart(spark, SF_SMALL).persist()
    n = m.count()
    assert n > 0
    assert m.select("contract_id", "productid", "period_start").distinct().count() == n
    bad = (m.groupBy("contract_id", "contract_year")
            .agg(F.sum("period_share").alias("s"), F.count(F.lit(1)).alias("k"))
            .where(F.abs(F.col("s") - 1) > F.col("k") * 0.000001).count())
    assert bad == 0
    assert m.where(F.col("period_end") <= F.col("period_start")).count() == 0


def test_same_result_with_1_or_7_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows = mart(spark, SF_SMALL).drop("inserted_at").collect()
            results.append(sorted(tuple(r) for r in rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]


def test_mart_with_a_hot_contract_and_a_hot_product(spark):
    import datetime as dt

    from samples import contract_staging, price_staging
    from wattlake.operators import intervals, revenue, scd2
    rows = []
    for i in range(1500):
        hot = i % 3 == 0
        cid = 1 if hot else 100 + i
        day = dt.date(2020, 1, 1) + dt.timedelta(days=(i * 7) % 360)
        rows.append(dict(id=cid, productid=410 if i % 10 else 420, status="active",
                         usage=100 + i % 50, usagenet=None, createdat="2020-01-01",
                         startdate=(dt.date(2020, 1, 1) + dt.timedelta(days=i % 30)).isoformat(),
                         modificationdate=day.isoformat(), type="t",
                         source_table=f"2023020{1 + i % 3}220104_contracts_staging_x"))
    hist = scd2.scd2_contracts(contract_staging(spark, rows))
    periods = intervals.price_periods(intervals.price_period_split(scd2.scd2_prices(price_staging(spark))))
    mart = revenue.contract_revenue(hist, periods, dt.date(2023, 6, 1)).persist()
    n = mart.count()
    assert n > 0
    assert mart.select("contract_id", "productid", "period_start").distinct().count() == n
    bad = (mart.groupBy("contract_id", "contract_year")
               .agg(F.sum("period_share").alias("s"), F.count(F.lit(1)).alias("k"))
               .where(F.abs(F.col("s") - 1) > F.col("k") * 0.000001).count())
    assert bad == 0
    assert mart.where("contract_id = 1").count() > 0
