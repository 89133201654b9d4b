"""The range join by product and month against the broadcast form; hot products split."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from wattlake.operators import intervals, scd2
from wattlake.schema import EXPECTED_COLUMNS

D = dt.date


def _inputs(spark, n=4000):
    rnd = random.Random(5)
    prices = []
    for product in (1, 2, 3, -1):
        for year in (2019, 2020, 2021):
            cuts = sorted({D(year, 1, 1), *[D(year, 1, 1) + dt.timedelta(days=rnd.randrange(360)) for _ in range(3)]})
            ends = [c - dt.timedelta(days=1) for c in cuts[1:]] + [D(year, 12, 31)]
            prices += [(product, a, b, Decimal(len(prices)), None, 1) for a, b in zip(cuts, ends)]
    p = spark.createDataFrame(prices, "product_id int, valid_from date, valid_until date, baseprice decimal(38,10), "
                                      "workingprice decimal(38,10), __open int")
    starts = []
    for i in range(n):
        product = rnd.choice([1, 1, 1, 1, 2, 3, 9, -1, None])
        day = D(2020, 1, 1) if rnd.random() < 0.5 else D(2018, 6, 1) + dt.timedelta(days=rnd.randrange(1400))
        starts.append((i, product, None if i % 50 == 0 else day))
    return spark.createDataFrame(starts, "contract_id long, productid int, period_start date"), p


def test_binned_join_equals_broadcast(spark):
    starts, p = _inputs(spark)
    for strict in (False, True):
        small = intervals.range_join_prices(starts, p, small_prices=True, strict=strict)
        binned = intervals.range_join_prices(starts, p, small_prices=False, strict=strict)
        assert binned.columns == small.columns
        assert sorted(map(str, binned.collect())) == sorted(map(str, small.collect()))
    open_ended = p.withColumn("valid_until", F.when(F.col("valid_until") == F.lit(D(2021, 12, 31)), F.lit(D(9999, 12, 31)))
                              .otherwise(F.col("valid_until")))
    a, b = [sorted(map(str, intervals.range_join_prices(starts, open_ended, yearly_pieces=False, small_prices=x).collect()))
            for x in (True, False)]
    assert a == b and len(a) == 4000


def test_binned_join_of_nothing(spark):
    starts, p = _inputs(spark, 20)
    assert intervals.range_join_prices(starts.limit(0), p, small_prices=False).count() == 0
    got = intervals.range_join_prices(starts, p.limit(0), small_prices=False)
    assert got.count() == 20 and got.where("baseprice is not null").count() == 0


def test_no_join_key_holds_a_hot_product(spark):
    starts, p = _inputs(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = intervals.range_join_prices(starts, p, small_prices=False)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "hashpartitioning(__jp" in text and "NestedLoop" not in text
    keyed = intervals._split_starts(*intervals._binned(starts, "period_start")[:2])
    largest = keyed.groupBy("__jp", "__bin", "__share").count().agg(F.max("count")).first()[0]
    assert largest < 5 * 4000 / intervals.HOT_BINS


def test_merge_reads_history_once(spark, tmp_path):
    names = EXPECTED_COLUMNS["products"]
    row = {"id": "1", "deleted": "0", "releasedversion": "1", "modificationdate": "2020-01-01"}
    feed = spark.createDataFrame([(*[row.get(n, "x") for n in names], "20200101_120000_202001_products")],
                                 ", ".join(f"{n} string" for n in [*names, "source_table"]))
    scd2.scd2_products(feed).write.parquet(str(tmp_path / "h"))
    feed.withColumn("productname", F.lit("y")).withColumn("modificationdate", F.lit("2021-01-01")) \
        .write.parquet(str(tmp_path / "s"))
    out = scd2.scd2_products(spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "h")),
                             on_change="close_and_open")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Join" not in plan
    got = sorted((r.productname, r.is_current, r.valid_until) for r in out.collect())
    assert got == [("x", False, D(2020, 12, 31)), ("y", True, D(9999, 12, 31))]
