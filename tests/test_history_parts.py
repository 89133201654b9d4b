"""Histories in parts against the whole-table loads; what a load writes."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from wattlake.operators import checks, scd2
from wattlake.plans import sql_views
from wattlake.schema import EXPECTED_COLUMNS
from wattlake.sources import history_parts as hp

TS = dt.datetime(2024, 1, 1)


def _contracts(spark, rows, month):
    """(id, day) versions as staged text rows; every other column by a rule."""
    names = list(EXPECTED_COLUMNS["contracts"])
    data = []
    for i, day, status in rows:
        cell = {"id": str(i), "productid": str(i % 3), "usage": "100", "usagenet": "90", "createdat": "2020-01-01",
                "startdate": "2020-01-01", "enddate": None, "filingdatecancellation": None, "status": status,
                "modificationdate": str(dt.date(2020, 1, 1) + dt.timedelta(days=day))}
        data.append((*[cell.get(n, "x") for n in names], f"20200101_120000_{month}_contracts"))
    return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in [*names, "source_table"]))


def _prices(spark, rows, month):
    names = list(EXPECTED_COLUMNS["prices"])
    data = []
    for i, day, price in rows:
        cell = {"id": str(i), "productid": str(i % 3), "pricecomponentid": "1", "price": str(price),
                "valid_from": "2020-01-01", "valid_until": "2020-12-31",
                "modificationdate": str(dt.date(2020, 1, 1) + dt.timedelta(days=day))}
        data.append((*[cell.get(n, "x") for n in names], f"20200101_120000_{month}_prices"))
    return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in [*names, "source_table"]))


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_contract_loads_equal_whole_history(spark, tmp_path, seed):
    rnd, base = random.Random(seed), str(tmp_path / "parts")
    whole, previous = None, None
    for n in range(3):
        rows = [(rnd.randrange(12), rnd.randrange(40), rnd.choice(["active", "cancelled"])) for _ in range(15)]
        feed = _contracts(spark, rows, f"2020{n + 1:02d}")
        whole = _kept(scd2.scd2_contracts(feed, whole, TS), tmp_path / f"w{n}")
        got = hp.apply_load(feed, hp.CONTRACTS, base, f"l{n}", previous, TS, buckets=5)
        assert _rows(got.select(*whole.columns)) == _rows(whole)
        assert _rows(hp.read_current(spark, base, f"l{n}").select(*whole.columns)) == _rows(whole.where("is_current"))
        previous = f"l{n}"
    checks.assert_constraints(got, ["contract_id", "modificationdate"], [])


def _kept(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_price_loads_equal_whole_history(spark, tmp_path):
    rnd, base = random.Random(3), str(tmp_path / "parts")
    whole, previous = None, None
    for n in range(3):
        feed = _prices(spark, [(rnd.randrange(8), rnd.randrange(30), n + 1) for _ in range(12)], f"2020{n + 1:02d}")
        whole = _kept(scd2.scd2_prices(feed, whole, TS), tmp_path / f"w{n}")
        got = hp.apply_load(feed, hp.PRICES, base, f"l{n}", previous, TS, buckets=4)
        assert _rows(got.select(*whole.columns)) == _rows(whole)
        previous = f"l{n}"


def test_a_load_writes_what_it_changes(spark, tmp_path):
    base = str(tmp_path / "parts")
    first = [(i, day, "active") for i in range(200) for day in range(10)]
    hp.apply_load(_contracts(spark, first, "202001"), hp.CONTRACTS, base, "a", None, TS, buckets=64)
    got = hp.apply_load(_contracts(spark, [(7, 50, "active"), (7, 3, "active")], "202002"), hp.CONTRACTS, base, "b",
                        "a", TS)
    wrote = spark.read.parquet(f"{base}/load=b")
    assert wrote.where("part = 'closed'").count() == 1  # the version that was current
    assert wrote.where("part = 'current'").count() < 20 < 2000 < got.count()
    assert wrote.select("b").distinct().count() == 1
    assert hp.read_table(spark, base, "a").count() == 2000  # the earlier load as it was
    # Only the current folders of its load and bucket are opened.
    names = {os.path.basename(os.path.dirname(f)) for f in
             hp._scan(spark, base, hp.read_manifest(spark, base, "b"), "current", [wrote.first().b]).inputFiles()}
    assert names == {f"b={wrote.first().b}"}


def test_unfinished_and_repeated_loads(spark, tmp_path):
    base = str(tmp_path / "parts")
    feed = _contracts(spark, [(1, 1, "active"), (2, 1, "active")], "202001")
    hp.apply_load(feed, hp.CONTRACTS, base, "a", None, TS, buckets=3)
    bad = feed.withColumn("productid", F.lit(None).cast("string")).withColumn("modificationdate", F.lit("2021-01-01"))
    with pytest.raises(checks.ConstraintViolation):
        hp.apply_load(bad, hp.CONTRACTS, base, "b", "a", TS)
    assert hp.read_manifest(spark, base, "b") is None and hp.read_table(spark, base, "a").count() == 2
    with pytest.raises(ValueError, match="no finished load"):
        hp.apply_load(feed, hp.CONTRACTS, base, "c", "b", TS)
    with pytest.raises(ValueError, match="is part of"):
        hp.apply_load(feed, hp.CONTRACTS, base, "a", "a", TS)
    # The failed id again, with good rows; then a load of nothing and one of known rows.
    good = _contracts(spark, [(1, 9, "active")], "202002")
    assert hp.apply_load(good, hp.CONTRACTS, base, "b", "a", TS).count() == 3
    assert hp.apply_load(feed.limit(0), hp.CONTRACTS, base, "d", "b", TS).count() == 3
    assert hp.apply_load(good, hp.CONTRACTS, base, "e", "d", TS).where("is_current").count() == 2


def test_published_reader_finds_parts(spark, tmp_path):
    from wattlake.plans.warehouse_job import parts_folder
    base = parts_folder(str(tmp_path), "contracts")
    hp.apply_load(_contracts(spark, [(1, 1, "active")], "202001"), hp.CONTRACTS, base, "v1", None, TS, buckets=3)
    assert set(sql_views.read_published(spark, str(tmp_path), "v1")) == {"contracts"}
    assert sql_views.read_published(spark, str(tmp_path), "v2") == {}
