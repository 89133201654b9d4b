"""Options of the semantics ledger: Q28 missing_as_null, Q32 keep_snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import MONTHS, contract_staging, price_staging
from wattlake.plans import warehouse_job
from wattlake.schema import typed_projection


def test_no_data_in_a_number_column(spark):
    df = spark.createDataFrame([("1", "no_data", "0")], "id string, releasedversion string, deleted string")
    as_null = typed_projection(df.withColumnRenamed("releasedversion", "usage"), "contracts",
                               missing_as_null=True).first()
    assert as_null.usage is None
    with pytest.raises(Exception):
        typed_projection(df.withColumnRenamed("releasedversion", "usage"), "contracts").collect()


def test_keep_snapshots_keeps_earlier_runs(spark, tmp_path):
    base = str(tmp_path / "wh")
    contracts = contract_staging(spark, [dict(
        id=1, productid=410, status="active", usage=10, usagenet=10, createdat="2020-03-01",
        startdate="2020-03-01", modificationdate="2020-03-01",
        source_table="20230201220104_contracts_staging_20250101_120000123")])
    ts = dt.datetime(2026, 1, 1)
    for months, as_of in ((set(MONTHS[:3]), dt.date(2023, 1, 20)),
                          (None, dt.date(2023, 6, 1))):
        warehouse_job.run(spark, {"prices": price_staging(spark, months), "contracts": contracts},
                          base, "v1", as_of, ts, keep_snapshots=True)
    pp = spark.read.parquet(f"{base}/price_periods/v=all")
    assert sorted(r[0] for r in pp.select("snapshot_date").distinct().collect()) == [
        dt.date(2023, 1, 1), dt.date(2023, 2, 1)]
    mart = spark.read.parquet(f"{base}/contract_price_enriched/v=all")
    assert mart.select("as_of_date").distinct().count() == 2


def test_report_files_are_ordered_with_header_first(spark, tmp_path):
    import glob

    from wattlake.sources import sinks
    df = spark.createDataFrame(
        [(dt.date(2020, 10, 2), 2, 5.5, 7), (dt.date(2020, 10, 1), 9, 1.005, 3),
         (dt.date(2020, 10, 1), 1, None, None)],
        "createdat date, productid int, sum_revenue double, sum_consumption long")
    sinks.write_table_csv(df, str(tmp_path / "r"), ["createdat", "productid"])
    lines = []
    for part in sorted(glob.glob(str(tmp_path / "r" / "part-*"))):  # parts concatenate in order
        lines += open(part, encoding="utf-8").read().splitlines()
    assert lines == ["createdat;productid;sum_revenue;sum_consumption",
                     "01.10.2020;1;;", "01.10.2020;9;1,01;3", "02.10.2020;2;5,50;7"]


def test_publish_refuses_a_table_breaking_its_key(spark, tmp_path):
    from wattlake.operators.checks import ConstraintViolation
    from wattlake.plans import sql_views
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (1, dt.date(2020, 1, 1))],
                               "price_id long, modificationdate date")
    df = df.selectExpr("price_id", "1L AS product_id", "1 AS pricecomponentid", "modificationdate",
                       "modificationdate AS valid_from", "modificationdate AS valid_until")
    with pytest.raises(ConstraintViolation):
        warehouse_job.publish(df, str(tmp_path), "prices", "v1")
    assert "prices" not in sql_views.read_published(spark, str(tmp_path), "v1")
    warehouse_job.publish(df.limit(1), str(tmp_path), "prices", "v2")
    assert sql_views.read_published(spark, str(tmp_path), "v2")["prices"].count() == 1


def test_report_parts_concatenate_in_order(spark, tmp_path):
    import glob

    from wattlake.sources import sinks
    rows = [(dt.date(2000, 1, 1) + dt.timedelta(days=i % 500), i, float(i), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "createdat date, productid int, sum_revenue double, "
                                     "sum_consumption long").repartition(7)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # small data: keep several parts to check their order
    try:
        sinks.write_table_csv(df, str(tmp_path / "r"), ["createdat", "productid"])
    finally:
        spark.conf.set(key, old)
    parts = sorted(glob.glob(str(tmp_path / "r" / "part-*")))
    lines = [ln for p in parts for ln in open(p, encoding="utf-8").read().splitlines()]
    assert len(parts) > 1 and lines[0].startswith("createdat;") and len(lines) == 5001
    keys = [(dt.datetime.strptime(ln.split(";")[0], "%d.%m.%Y"), int(ln.split(";")[1]))
            for ln in lines[1:]]
    assert keys == sorted(keys)


def test_publish_check_levels(spark, tmp_path):
    from wattlake.operators.checks import ConstraintViolation
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (1, dt.date(2020, 1, 1))],
                               "price_id long, modificationdate date")
    df = df.selectExpr("price_id", "1L AS product_id", "1 AS pricecomponentid", "modificationdate",
                       "modificationdate AS valid_from", "modificationdate AS valid_until")
    warehouse_job.publish(df, str(tmp_path), "prices", "n", check="nulls")  # duplicates not looked at
    nulls = df.selectExpr("CAST(NULL AS BIGINT) AS price_id", "product_id", "pricecomponentid",
                          "modificationdate", "valid_from", "valid_until")
    with pytest.raises(ConstraintViolation):
        warehouse_job.publish(nulls, str(tmp_path), "prices", "m", check="nulls")
    with pytest.raises(ValueError):
        warehouse_job.publish(df, str(tmp_path), "prices", "x", check="some")
