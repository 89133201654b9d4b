"""Goldens on the invented snapshots of samples.py, worked out by hand."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from samples import LOAD, MONTHS, RENAMED, contract_staging, price_staging, product_staging
from wattlake.operators import intervals, revenue, scd2

D = dt.date


def test_prices_history_all_months(spark):
    h = scd2.scd2_prices(price_staging(spark)).collect()
    assert len(h) == 13
    stale = sorted((r.price_id, r.modificationdate) for r in h if not r.is_current)
    assert stale == [(108, D(2017, 11, 20)), (109, D(2017, 11, 20))]
    assert {r.extracted_at.date() for r in h} <= {D(int(m[:4]), int(m[4:]), 1) for m in MONTHS}


def test_products_history_as_coded(spark):
    h = scd2.scd2_products(product_staging(spark)).collect()
    assert len(h) == 4
    assert all(r.is_current and r.releasedversion == -1 for r in h)
    by_id = {r.product_id: r for r in h}
    assert all(by_id[i].valid_from == D(2023, 1, 25) for i in RENAMED)
    assert by_id[7700].valid_from == D(2022, 12, 20) and by_id[7700].deleted == 1


def _periods(spark, pick="longest"):
    prices = scd2.scd2_prices(price_staging(spark))
    return intervals.price_periods(intervals.price_period_split(prices, pick=pick))


def _years(product, first, last, base, working):
    return {(product, D(y, 1, 1), D(y, 12, 31)): (base, working) for y in range(first, last + 1)}


def test_price_periods_golden(spark):
    rows = {(r.product_id, r.valid_from, r.valid_until): (r.baseprice, r.workingprice, r.snapshot_date)
            for r in _periods(spark).collect()}
    assert {v[2] for v in rows.values()} == {D(2023, 2, 1)}
    expected = {
        **_years(410, 2018, 2019, "7.2", "26.5"),
        (410, D(2020, 1, 1), D(2020, 9, 30)): ("7.2", "26.5"),
        # A price that starts in October starts each of its years in October.
        **{(410, D(y, 10, 1), D(y, 12, 31)): ("8.4", "27.25") for y in (2020, 2021, 2022)},
        **_years(420, 2018, 2021, "6.6", "21.9"),
        **_years(420, 2022, 2022, "6.6", "23.15"),
        (420, D(2023, 1, 1), D(2023, 2, 1)): ("6.6", "23.15"),  # open end: the newest snapshot
        **_years(530, 2018, 2022, "11", "6.35"),
        # The longest version of working price 109 is the stale, open one.
        (530, D(2023, 1, 1), D(2023, 2, 1)): ("12.5", "6.35"),
    }
    assert {k: v[:2] for k, v in rows.items()} == {
        k: (Decimal(b), Decimal(w)) for k, (b, w) in expected.items()}


def test_price_periods_pick_current(spark):
    rows = {(r.product_id, r.valid_from): (r.baseprice, r.workingprice)
            for r in _periods(spark, pick="current").collect()}
    assert len(rows) == 18
    assert rows[(530, D(2022, 1, 1))] == (Decimal(11), Decimal("6.35"))
    assert rows[(530, D(2023, 1, 1))] == (Decimal("12.5"), None)


def test_contract_revenue_worked_example(spark):
    staging = contract_staging(spark, [dict(
        id=1, productid=410, status="active", usage=3650, usagenet=3650, createdat="2020-03-01",
        startdate="2020-03-01", modificationdate="2020-03-01", type="household",
        source_table=f"20230201220104_contracts_staging_{LOAD}")])
    hist = scd2.scd2_contracts(staging)
    mart = revenue.contract_revenue(hist, _periods(spark), as_of=D(2023, 6, 1))
    rows = sorted(mart.collect(), key=lambda r: r.period_start)
    # Cut points: starts and ends of 410's periods, then the newest snapshot.
    cuts = [D(2020, 3, 1), D(2020, 9, 30), D(2020, 10, 1), D(2020, 12, 31), D(2021, 10, 1), D(2021, 12, 31),
            D(2022, 10, 1), D(2022, 12, 31), D(2023, 2, 1)]
    assert [(r.period_start, r.period_end) for r in rows] == list(zip(cuts, cuts[1:]))
    year = [0, 0, 0, 0, 1, 1, 2, 2]  # contract years of the period starts
    assert [r.contract_year for r in rows] == year
    days = [(b - a).days for a, b in zip(cuts, cuts[1:])]
    of_year = [sum(d for d, y in zip(days, year) if y == k) for k in year]

    def six(x):
        return str(x.quantize(Decimal("0.000001"), ROUND_HALF_UP))
    for k, (r, d, total) in enumerate(zip(rows, days, of_year)):
        working = Decimal("26.5") if k < 2 else Decimal("27.25")
        base = Decimal("8.4") * d / total  # the year's highest base price, by its share of the year's days
        variable = working / 100 * 3650 * d / 365
        got = (r.days_in_period, str(r.period_share), str(r.base_cost), str(r.variable_cost),
               str(r.weighted_consumption), str(r.consumption_share), str(r.revenue))
        assert got == (d, six(Decimal(d) / total), six(base), six(variable), six(Decimal(10 * d)),
                       six(Decimal(d) / 365), six(base + variable)), k
        assert (r.total_contract_years, r.total_days_in_year) == (3, total)
        assert r.final_end == D(2023, 2, 1) and r.terminated_mid_year is True
    assert [str(r.baseprice_total_due) for r in rows] == ["21.60"] * 2 + ["25.20"] * 6  # three years' base price


def test_published_change_report_line(spark, tmp_path):
    """BASELINE: first/last 7682.82 / 1255.77 over 92 days -> a decline of 84 %."""
    import glob

    from wattlake.sources import sinks
    days = [dt.date(2020, 10, 1) + dt.timedelta(days=i) for i in range(92)]
    vals = {days[0]: "7682.82", days[1]: "7139.76", days[-1]: "1255.77"}
    rows = [(d, Decimal(vals.get(d, "1000.00")), 1) for d in days]
    series = spark.createDataFrame(rows, "createdat date, sum_revenue decimal(28,6), sum_consumption long")
    sinks.write_report_csv(series, str(tmp_path / "r"))
    lines = [ln for p in sorted(glob.glob(str(tmp_path / "r" / "part-*")))
             for ln in open(p, encoding="utf-8").read().splitlines()]
    assert lines[:3] == ["createdat;sum_revenue;;", "01.10.2020;7682,82;1255,77;84%",
                         "02.10.2020;7139,76;;"]
    assert lines[-1] == "31.12.2020;1255,77;;" and len(lines) == 93
