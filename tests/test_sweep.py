"""The sweep against every covering pair, its work, and the strict overlap rule."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wattlake.operators import intervals, sweep

D = dt.date


def _brute(rows, channels):
    cuts = sorted({r[0] for r in rows} | {r[1] + 1 for r in rows})
    for cut, after in zip(cuts, cuts[1:]):
        cover = [i for i, r in enumerate(rows) if r[0] <= cut <= r[1]]
        if cover:
            yield cut, after - 1, len(cover), [
                max((i for i in cover if rows[i][2] == c), key=lambda i: (rows[i][3], -i), default=None)
                for c in range(channels)]


@pytest.mark.parametrize("seed", range(20))
def test_segments_equal_all_pairs(seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(rnd.randrange(1, 60)):
        a = rnd.randrange(100)
        rows.append((a, a + rnd.randrange(30), rnd.randrange(2), (rnd.randrange(9), rnd.randrange(3))))
    assert list(sweep.segments(rows, 2)) == list(_brute(rows, 2))


def test_deep_overlap_is_not_quadratic():
    rows = [(i, 200_000 - i, 0, (i,)) for i in range(50_000)]
    assert sum(1 for _ in sweep.segments(rows, 1)) == 99_999


def test_rows_with_nulls_and_empty_intervals(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1), D(2020, 1, 5), "a"), (1, D(2020, 1, 3), None, "b"),
                                (1, D(2020, 1, 4), D(2020, 1, 2), "c"), (None, D(2020, 1, 1), D(2020, 1, 2), "d"),
                                (2, D(2020, 1, 1), D(2020, 1, 1), None)], "k int, s date, e date, v string")
    got = sweep.swept(df, {"k": F.col("k")}, "s", "e", [F.unix_date("s")], ["v"]).collect()
    assert sorted(map(tuple, got)) == [(1, D(2020, 1, 1), D(2020, 1, 5), 1, "a"), (2, D(2020, 1, 1), D(2020, 1, 1), 1, None)]
    assert sweep.swept(df.limit(0), {"k": F.col("k")}, "s", "e", [F.unix_date("s")], ["v"]).count() == 0


def _prices(spark):
    return spark.createDataFrame(
        [(1, D(2020, 1, 1), D(2020, 12, 31), Decimal(1), Decimal(10)), (1, D(2020, 4, 1), D(2020, 6, 30), Decimal(2), None),
         (2, D(2020, 1, 1), D(2020, 12, 31), Decimal(5), Decimal(50))],
        "product_id int, valid_from date, valid_until date, baseprice decimal(38,10), workingprice decimal(38,10)")


def _starts(spark, *rows):
    return spark.createDataFrame(rows, "contract_id long, productid int, period_start date")


def test_strict_overlap_fails_only_where_a_period_starts_in_two(spark):
    prices = intervals.effective_prices(_prices(spark))
    good = _starts(spark, (1, 1, D(2020, 2, 1)), (2, 2, D(2020, 5, 1)), (3, 3, D(2020, 5, 1)))
    got = {r.contract_id: r.baseprice for r in intervals.range_join_prices(good, prices, strict=True).collect()}
    assert {k: v and int(v) for k, v in got.items()} == {1: 1, 2: 5, 3: None}
    both = good.union(_starts(spark, (4, 1, D(2020, 5, 1))))
    assert {r.contract_id: r.baseprice and int(r.baseprice)
            for r in intervals.range_join_prices(both, prices).collect()} == {1: 1, 2: 5, 3: None, 4: 2}
    with pytest.raises(Exception, match="several price periods of product 1"):
        intervals.range_join_prices(both, prices, strict=True).collect()


def test_sweep_by_year_equals_sweep_by_product(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        start = D(2018, 1, 1) + dt.timedelta(days=rnd.randrange(1000))
        end = min(start + dt.timedelta(days=rnd.randrange(90)), D(start.year, 12, 31))
        rows.append((rnd.randrange(4), rnd.choice([1, 2]), i, Decimal(i), start, end, D(2021, 1, 1)))
    pieces = spark.createDataFrame(rows, "product_id int, pricecomponentid int, price_id long, price decimal(38,10), "
                                         "period_start date, period_end date, snapshot_date date")
    whole = sorted(map(str, intervals.price_periods_aligned(pieces).collect()))
    years = sorted(map(str, intervals.price_periods_aligned(pieces, yearly_pieces=True).collect()))
    cut = [r for r in whole if r not in set(years)]
    assert len(years) > 300 and not cut
