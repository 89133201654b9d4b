"""No cap, prefix or size may lose data or change a result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.operators import intervals, scd2
from wattlake.schema import EXPECTED_COLUMNS, typed_projection
from wattlake.sources import landing

D = dt.date


def _contracts(spark, rows):
    base = {c: None for c in EXPECTED_COLUMNS["contracts"]}
    made = []
    for contract, version in rows:
        made.append({**base, "id": str(contract), "productid": "7", "status": "indelivery", "type": "x",
                     "startdate": "2020-01-01", "createdat": "2020-01-01", "usage": "100.0", "usagenet": "100",
                     "modificationdate": version, "source_table": "20201001000000_contracts_staging_1"})
    fields = ", ".join(f"`{c}` string" for c in made[0])
    return spark.createDataFrame([tuple(m.values()) for m in made], fields)


@pytest.mark.parametrize("recompute", [False, True])
def test_load_size_chooses_the_join_and_not_the_scope(spark, recompute):
    history = scd2.scd2_contracts(_contracts(spark, [(1, "2020-01-01"), (1, "2020-06-01"), (2, "2020-01-01")]))
    # A late version closed against the next current one leaves an overlap in the history.
    history = scd2.scd2_contracts(_contracts(spark, [(1, "2020-03-01")]), history=history)
    load = _contracts(spark, [(2, "2020-04-01")])

    def run(bound):
        out = scd2.scd2_contracts(load, history=history, recompute=recompute, max_broadcast_rows=bound)
        return sorted(map(str, out.select("contract_id", "valid_from", "valid_until", "is_current").collect()))
    assert run(10) == run(0)
    if recompute:
        first = [r for r in run(10) if "contract_id=1" in r and "2020, 1, 1" in r]
        assert "valid_until=datetime.date(2020, 2, 29)" in first[0]


def test_header_longer_than_any_buffer(spark, tmp_path):
    extra = [f"extra_column_number_{i}" for i in range(5000)]
    names = extra + EXPECTED_COLUMNS["prices"]
    assert len(";".join(names)) > 65536
    path = tmp_path / "20201001220039_prices.csv"
    path.write_text(";".join(names) + "\n" + ";".join(["1"] * len(names)) + "\n")
    files = landing.select_files(landing.list_landing(spark, str(tmp_path)), "prices", "202010")
    found = landing.detect_delimiter(landing.unit_headers(files)).first()
    assert list(found["columns"]) == names and found["missing"] == []


def test_price_across_the_year_end_without_yearly_pieces(spark):
    rows = [("p", D(2019, 6, 1), D(2020, 5, 31), 8.99, 1.0), ("p", D(2020, 3, 1), D(2020, 3, 31), 5.0, 2.0)]
    dedup = spark.createDataFrame(rows, "product_id string, valid_from date, valid_until date, "
                                        "baseprice double, workingprice double")
    got = {r["valid_from"]: r["baseprice"] for r in intervals.effective_prices(dedup, yearly_pieces=False).collect()}
    assert got == {D(2019, 6, 1): 8.99, D(2020, 3, 1): 5.0, D(2020, 4, 1): 8.99}


def test_breakpoints_within_bounds_give_the_same_periods(spark):
    ci = spark.createDataFrame([(1, 7, D(2020, 1, 1), D(2020, 1, 5), D(2020, 9, 1)), (2, 7, D(2020, 2, 1), D(2020, 1, 1), None)],
                               "contract_id int, productid int, startdate date, createdat date, enddate date")
    ci = ci.withColumn("low", F.col("startdate")).withColumn("high", F.col("enddate"))
    days = [D(2019 + k // 12, k % 12 + 1, 1) for k in range(30)]
    table = spark.createDataFrame([(D(2021, 1, 1), 7, d, d + dt.timedelta(9)) for d in days],
                                  "snapshot_date date, product_id int, valid_from date, valid_until date")

    def periods(within):
        bp = intervals.contract_breakpoints(ci, table, extra=["low", "high"], within=within)
        p = intervals.contract_periods(bp, extra=["low", "high"]).where(
            "period_start >= low and (high is null or period_start < high)")
        return bp.count(), sorted(map(tuple, p.collect()), key=str)
    (many, want), (few, got) = periods(None), periods(("low", "high"))
    assert got == want and few < many


def test_typed_cells(spark):
    names = EXPECTED_COLUMNS["products"]
    row = {c: "x" for c in names} | {"id": "1000.0", "deleted": "NaN", "releasedversion": "3", "productname": "NULL",
                                     "modificationdate": "2020-08-27 00:00:00"}

    def typed(**changed):
        made = {**row, **changed}
        df = spark.createDataFrame([tuple(made[c] for c in names)], ", ".join(f"`{c}` string" for c in names))
        return typed_projection(df, "products").first()
    r = typed()
    assert r["id"] == 1000 and r["deleted"] is None and r["productname"] is None
    assert str(r["modificationdate"]).startswith("2020-08-27")
    with pytest.raises(Exception):
        typed(modificationdate="2020-08-27garbage")
