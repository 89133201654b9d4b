"""Small semantic cases of FIXTURES §4 and the ledger of SURVEY §8."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from samples import MONTHS, RENAMED, contract_staging, price_staging, product_staging
from wattlake.functions.hashing import row_hash
from wattlake.operators import intervals, revenue, scd2
from wattlake.sources import staging

D = dt.date
SRC = "20230201220104_contracts_staging_20250101_120000123"


def _split(spark, start, until, **kw):
    df = spark.createDataFrame([(start, until)], "valid_from date, valid_until date")
    out = intervals.split_yearly(df, **kw).orderBy("period_start").collect()
    return [(r.period_start, r.period_end) for r in out]


def test_leap_day_series_drifts_like_the_warehouse(spark):
    got = _split(spark, D(2020, 2, 29), D(2024, 12, 31))
    assert [s for s, _ in got] == [D(2020, 2, 29), D(2021, 2, 28), D(2022, 2, 28), D(2023, 2, 28),
                                   D(2024, 2, 28)]
    assert all(e == D(s.year, 12, 31) for s, e in got)
    plain = _split(spark, D(2020, 2, 29), D(2024, 12, 31), drift=False)
    assert plain[-1][0] == D(2024, 2, 29)
    cal = _split(spark, D(2020, 2, 29), D(2022, 6, 30), calendar_year=True)
    assert cal == [(D(2020, 2, 29), D(2020, 12, 31)), (D(2021, 1, 1), D(2021, 12, 31)),
                   (D(2022, 1, 1), D(2022, 6, 30))]


def test_empty_and_reversed_intervals_yield_nothing(spark):
    assert _split(spark, D(2021, 10, 1), D(2021, 1, 1)) == []
    assert _split(spark, D(2021, 1, 1), D(2021, 1, 1)) == [(D(2021, 1, 1), D(2021, 1, 1))]


def test_price_from_the_future_has_no_period(spark):
    pieces = intervals.price_period_split(scd2.scd2_prices(price_staging(spark)))
    assert pieces.where(F.col("price_id") == 111).count() == 0


def test_product_changed_then_reloaded(spark):
    first = scd2.scd2_products(product_staging(spark, set(MONTHS[:3])))
    jan = product_staging(spark, {MONTHS[3]})
    second = scd2.scd2_products(jan, history=first).persist()
    rows = {(r.product_id, r.valid_from): r for r in second.collect()}
    closed = [r for r in rows.values() if not r.is_current]
    assert sorted(r.product_id for r in closed) == RENAMED
    assert all(r.valid_until == D(2023, 1, 24) for r in closed)
    assert not any(r.valid_from == D(2023, 1, 25) for r in rows.values())  # not opened yet
    third = scd2.scd2_products(jan, history=second).collect()
    opened = [r for r in third if r.valid_from == D(2023, 1, 25)]
    assert sorted(r.product_id for r in opened) == RENAMED
    assert all(r.is_current for r in opened)
    both = scd2.scd2_products(jan, history=first, on_change="close_and_open").collect()
    assert len([r for r in both if r.is_current]) == 4


def _contract(mod, **kw):
    base = dict(id=7, productid=410, status="active", usage=100, usagenet=100,
                createdat="2020-01-01", startdate="2020-01-01", modificationdate=mod,
                source_table=SRC)
    base.update(kw)
    return base


def test_late_old_contract_version(spark):
    hist = scd2.scd2_contracts(contract_staging(spark, [_contract("2020-01-01"),
                                                        _contract("2020-06-01")]))
    late = contract_staging(spark, [_contract("2020-03-01")])
    as_coded = {r.modificationdate: (r.valid_until, r.is_current)
                for r in scd2.scd2_contracts(late, history=hist).collect()}
    assert as_coded == {D(2020, 1, 1): (D(2020, 5, 31), False),
                        D(2020, 3, 1): (D(2020, 5, 31), False),
                        D(2020, 6, 1): (D(9999, 12, 31), True)}
    fixed = {r.modificationdate: r.valid_until
             for r in scd2.scd2_contracts(late, history=hist, recompute=True).collect()}
    assert fixed[D(2020, 1, 1)] == D(2020, 2, 29)


def test_null_in_the_middle_hashes_like_a_null_at_the_end(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r[0] for r in df.select(row_hash("x", "y", "z")).collect()]
    assert h[0] == h[1]


def _one_contract_mart(spark, prices, **kw):
    st = contract_staging(spark, [_contract("2020-03-01", createdat="2020-03-01",
                                            startdate="2020-03-01", **kw)])
    periods = intervals.price_periods(intervals.price_period_split(scd2.scd2_prices(prices)))
    return revenue.contract_revenue(scd2.scd2_contracts(st), periods, as_of=D(2023, 6, 1)).collect()


def test_zero_consumption_gives_null_share(spark):
    rows = _one_contract_mart(spark, price_staging(spark), usage=0, usagenet=0)
    assert rows and all(r.consumption_share is None and r.variable_cost == 0 for r in rows)


def test_missing_base_price_nulls_revenue_missing_working_counts_zero(spark):
    p = price_staging(spark)
    no_base = p.where(~((F.col("productid") == "410") & (F.col("pricecomponentid") == "1")))
    rows = _one_contract_mart(spark, no_base)
    assert rows and all(r.base_cost is None and r.revenue is None for r in rows)
    no_work = p.where(~((F.col("productid") == "410") & (F.col("pricecomponentid") == "2")))
    rows = _one_contract_mart(spark, no_work)
    assert rows and all(r.variable_cost == 0 and r.revenue == r.base_cost for r in rows)


def test_empty_load(spark, tmp_path):
    empty = contract_staging(spark, [])
    assert scd2.scd2_contracts(empty).count() == 0
    view = staging.staging_view(spark, str(tmp_path / "nothing"), "contracts", "x")
    assert view.count() == 0 and "productid" in view.columns


def test_load_run_twice_adds_nothing(spark):
    p = price_staging(spark)
    once = scd2.scd2_prices(p)
    twice = scd2.scd2_prices(p, history=once)
    cols = ["price_id", "modificationdate", "is_current", "valid_until"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())
    c = contract_staging(spark, [_contract("2020-01-01"), _contract("2020-06-01")])
    h1 = scd2.scd2_contracts(c)
    h2 = scd2.scd2_contracts(c, history=h1)
    keep = ["contract_id", "modificationdate", "valid_until", "is_current"]
    assert sorted(h1.select(keep).collect()) == sorted(h2.select(keep).collect())


def test_text_dates_are_month_first(spark):
    from wattlake.plans import reports
    df = spark.createDataFrame([(dt.date(2020, 10, 1), 1), (dt.date(2020, 1, 10), 2)],
                               "createdat date, revenue int")
    df = df.withColumn("consumption", F.lit(1))
    got = [r.createdat for r in reports.revenue_by_created(df, "10.01.2020", "01.01.2021").collect()]
    assert got == [dt.date(2020, 10, 1)]


def test_extracted_at_reads_the_file_stamp_unless_the_tail_has_six_digits(spark):
    from wattlake.functions.lineage import extracted_at, snapshot_date
    df = spark.createDataFrame([("20201001220039_prices_staging_20250101_120000123",),
                                ("20201001220039_prices_staging_20250101_120000",)], "s string")
    got = [(r.ts, r.d) for r in df.select(extracted_at("s").alias("ts"),
                                          snapshot_date("s").alias("d")).collect()]
    assert got == [(dt.datetime(2020, 10, 1, 22, 0, 39), D(2020, 10, 1)),
                   (dt.datetime(2025, 1, 1, 12, 0, 0), D(2020, 10, 1))]


def test_suggestions_can_skip_expected_names(spark):
    from wattlake.sources import landing
    header = "id;productid;pricecomponentid;productcomponent;price;valid_from;valid_until;modificationdate"
    units = spark.createDataFrame([("u.csv", "prices", header)],
                                  "file_name string, entity string, header string")
    det = landing.detect_delimiter(units)
    as_coded = {r.target: r.suggested for r in landing.suggest_columns(det).collect()}
    skipped = {r.target: r.suggested
               for r in landing.suggest_columns(det, exclude_expected=True).collect()}
    assert as_coded["pricecomponent"] == "pricecomponentid"
    assert skipped["pricecomponent"] == "productcomponent"


def test_aligned_periods_intersect_base_and_working(spark):
    rows = [(1000, 1, 11, Decimal("9.00"), D(2020, 1, 1), D(2020, 6, 30), D(2020, 12, 31)),
            (1000, 2, 12, Decimal("30.00"), D(2020, 3, 1), D(2020, 12, 31), D(2020, 12, 31))]
    pieces = spark.createDataFrame(rows, "product_id int, pricecomponentid int, price_id long, "
                                         "price decimal(38,10), period_start date, period_end date, "
                                         "snapshot_date date")
    got = sorted((r.valid_from, r.valid_until, r.base_id, r.working_id)
                 for r in intervals.price_periods_aligned(pieces).collect())
    assert got == [(D(2020, 1, 1), D(2020, 2, 29), 11, None),
                   (D(2020, 3, 1), D(2020, 6, 30), 11, 12),
                   (D(2020, 7, 1), D(2020, 12, 31), None, 12)]


def test_overlapping_prices_keep_the_latest_start_then_end(spark):
    rows = [(1000, D(2020, 1, 1), D(2020, 12, 31), Decimal("1"), Decimal("10")),
            (1000, D(2020, 4, 1), D(2020, 6, 30), Decimal("2"), Decimal("20")),
            (1000, D(2020, 4, 1), D(2020, 5, 31), Decimal("3"), Decimal("30"))]
    dedup = spark.createDataFrame(rows, "product_id int, valid_from date, valid_until date, "
                                        "baseprice decimal(38,10), workingprice decimal(38,10)")
    segs = sorted((r.valid_from, r.valid_until, int(r.baseprice))
                  for r in intervals.effective_prices(dedup).collect())
    assert segs == [(D(2020, 1, 1), D(2020, 3, 31), 1), (D(2020, 4, 1), D(2020, 5, 31), 2),
                    (D(2020, 6, 1), D(2020, 6, 30), 2), (D(2020, 7, 1), D(2020, 12, 31), 1)]


def test_touched_key_path_equals_the_whole_history_path(spark, monkeypatch):
    early = price_staging(spark, set(MONTHS[:3]))
    jan = price_staging(spark, {MONTHS[3]})
    hist = scd2.scd2_prices(early)
    cols = ["price_id", "modificationdate", "is_current", "valid_until", "price"]
    touched = sorted(scd2.scd2_prices(jan, history=hist).select(cols).collect())
    monkeypatch.setattr(scd2, "DEFAULT_MAX_ROWS", 0)  # no broadcast: shuffled joins, same scope
    whole = sorted(scd2.scd2_prices(jan, history=hist).select(cols).collect())
    assert touched == whole
    assert len(touched) == 13 and sum(1 for r in touched if not r.is_current) == 2
