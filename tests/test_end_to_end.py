"""Reference-format landing files -> staging -> history -> price periods."""

import datetime as dt
import json

from pyspark.sql import functions as F

from samples import MONTHS, PRICE_FILES, PRODUCT_FILES, contract_staging
from wattlake.operators import intervals, scd2
from wattlake.sources import staging

LOAD = "20250101_120000123"


def _q(v):
    return v if isinstance(v, int) else f'"{v}"'


def _write_landing(root, months=None):
    root.mkdir(exist_ok=True)
    for stamp, rows in PRICE_FILES.items():
        if months and stamp[:6] not in months:
            continue
        lines = ['"id";"productid";"pricecomponentid";"productcomponent";"price";"unit";'
                 '"valid_from";"valid_until";"modificationdate"']
        for r in rows:
            vals = [r[0], r[1], r[2], _q(r[3]), r[4], _q(r[5]), _q(r[6]), _q(r[7]), _q(r[8])]
            lines.append(";".join(str(v) for v in vals))
        (root / f"{stamp}_prices.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    for stamp, rows in PRODUCT_FILES.items():
        if months and stamp[:6] not in months:
            continue
        lines = ['\ufeff"id";"productcode";"productname";"energy";"consumptiontype";"deleted";'
                 '"modificationdate"']
        for r in rows:
            vals = [r[0], _q(r[1]), _q(r[2]), _q(r[3]), _q(r[4]), r[5], _q(r[6])]
            lines.append(";".join(str(v) for v in vals))
        (root / f"{stamp}_products.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


def _write_rules(rules):
    rules.mkdir()
    for stamp in PRICE_FILES:
        doc = {"__delimiter__": ";", "pricecomponent": {"suggested": "productcomponent",
                                                        "user_submitted": 1, "pass_as_null": 0}}
        (rules / f"matching_{stamp}_prices.json").write_text(json.dumps(doc, indent=2))
    for stamp in PRODUCT_FILES:
        doc = {"__delimiter__": ";", "releasedversion": {"suggested": None, "user_submitted": 0,
                                                         "pass_as_null": 1}}
        (rules / f"matching_{stamp}_products.json").write_text(json.dumps(doc, indent=2))


def test_reference_format_files_to_price_periods(spark, tmp_path):
    _write_landing(tmp_path / "landing")
    _write_rules(tmp_path / "rules")
    res = staging.run_landing(spark, str(tmp_path / "landing"), str(tmp_path / "staging"), LOAD,
                              start=MONTHS[0], end=MONTHS[3], rules_dir=str(tmp_path / "rules"),
                              log_dir=str(tmp_path / "log"))
    log = {r.file: (r.status, r.rows_loaded) for r in res.log.collect()}
    assert len(log) == 8 and all(s == "SUCCESS" for s, _ in log.values())
    assert sorted(n for f, (_, n) in log.items() if f.endswith("_prices.csv")) == [9, 9, 9, 11]
    assert sorted(n for f, (_, n) in log.items() if f.endswith("_products.csv")) == [3, 4, 4, 4]

    prices = staging.staging_view(spark, str(tmp_path / "staging"), "prices", LOAD)
    products = staging.staging_view(spark, str(tmp_path / "staging"), "products", LOAD)
    assert prices.where(F.col("pricecomponent").isNull()).count() == 0
    assert {r.productname for r in products.select("productname").collect()} >= {"Hafenstrom Fix"}

    hist = scd2.scd2_prices(prices)
    assert hist.count() == 13
    periods = intervals.price_periods(intervals.price_period_split(hist)).collect()
    assert len(periods) == 18 and {r.snapshot_date for r in periods} == {dt.date(2023, 2, 1)}
    prod = scd2.scd2_products(products).collect()
    assert len(prod) == 4 and all(r.releasedversion == -1 for r in prod)


def test_hot_contract_with_a_third_of_all_copies(spark):
    rows = []
    for i in range(900):
        # contract 1 owns a third of the rows: copies across loads and many dates
        cid = 1 if i % 3 == 0 else i
        day = dt.date(2020, 1, 1) + dt.timedelta(days=(i // 3) % 40)
        load = f"202{i % 2}0101220104_contracts_staging_{LOAD}"
        rows.append(dict(id=cid, productid=410, status="active", usage=10, usagenet=10,
                         createdat="2020-01-01", startdate="2020-01-01",
                         modificationdate=day.isoformat(), source_table=load, type=str(i)))
    hist = scd2.scd2_contracts(contract_staging(spark, rows)).where("contract_id = 1").collect()
    assert len(hist) == 40  # one version per distinct date
    current = [r for r in hist if r.is_current]
    assert len(current) == 1 and current[0].modificationdate == dt.date(2020, 2, 9)
    newest = {}
    for r in rows:
        if r["id"] == 1:
            d = dt.date.fromisoformat(r["modificationdate"])
            newest[d] = max(newest.get(d, ""), r["source_table"])
    assert {r.modificationdate: r.source_table for r in hist} == newest  # newest copy wins
