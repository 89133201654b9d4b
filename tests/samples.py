"""A small invented supplier: four monthly product and price snapshots, staged
as text with their staging table names.

Three tariffs with a base and a working price each.  The last snapshot ends
the gas prices with the year, opens new ones (one of them after the snapshot)
and renames every product; a trial product appears, then is marked deleted.
"""

from __future__ import annotations

LOAD = "20250101_120000123"

MONTHS = ("202211", "202212", "202301", "202302")
OPEN = "9999-12-31"
COMPONENTS = {1: ("baseprice", "€/year"), 2: ("workingprice", "ct/kwh")}


def _price(id, product, component, price, start, until, modified):
    name, unit = COMPONENTS[component]
    return (id, product, component, name, price, unit, start, until, modified)


_POWER = [
    _price(101, 410, 1, "7.2", "2018-01-01", "2020-09-30", "2020-09-12"),
    _price(102, 410, 2, "26.5", "2018-01-01", "2020-09-30", "2020-09-12"),
    _price(103, 410, 1, "8.4", "2020-10-01", OPEN, "2020-09-12"),
    _price(104, 410, 2, "27.25", "2020-10-01", OPEN, "2020-09-12"),
    _price(105, 420, 1, "6.6", "2018-01-01", OPEN, "2017-11-20"),
    _price(106, 420, 2, "21.9", "2018-01-01", "2021-12-31", "2021-12-06"),
    _price(107, 420, 2, "23.15", "2022-01-01", OPEN, "2021-12-06"),
]
_GAS = [
    _price(108, 530, 1, "11.0", "2018-01-01", OPEN, "2017-11-20"),
    _price(109, 530, 2, "6.35", "2018-01-01", OPEN, "2017-11-20"),
]
_GAS_RAISED = [
    _price(108, 530, 1, "11.0", "2018-01-01", "2022-12-31", "2023-01-17"),
    _price(109, 530, 2, "6.35", "2018-01-01", "2022-12-31", "2023-01-17"),
    _price(110, 530, 1, "12.5", "2023-01-01", OPEN, "2023-01-17"),
    _price(111, 530, 2, "7.05", "2023-03-01", OPEN, "2023-01-17"),
]
PRICE_FILES = {f"{m}01061500": _POWER + (_GAS_RAISED if m == MONTHS[-1] else _GAS) for m in MONTHS}


def _product(id, name, energy, modified, deleted=0):
    return (id, "tariff", name, energy, "small_user", deleted, modified)


def _products(night, trial):
    return [_product(410, "Hafenstrom Fix", "electricity", "2022-02-03"),
            _product(420, "Hafenstrom Nacht", "electricity", night),
            _product(530, "Hafengas", "gas", "2021-07-09"), *trial]


# The night tariff's date goes back in the second snapshot; the last renames all.
_TRIAL_GONE = _product(7700, "Probetarif", "electricity", "2022-12-20", deleted=1)
PRODUCT_FILES = dict(zip((f"{m}01061200" for m in MONTHS), (
    _products("2022-08-15", []),
    _products("2022-01-31", [_product(7700, "Probetarif", "electricity", "2022-11-30")]),
    _products("2022-01-31", [_TRIAL_GONE]),
    [_product(i, f"{n} 2023", e, "2023-01-25") for i, _, n, e, *_ in _products("", [])] + [_TRIAL_GONE])))
RENAMED = [410, 420, 530]


def price_staging(spark, months=None):
    rows = []
    for stamp, data in PRICE_FILES.items():
        if months and stamp[:6] not in months:
            continue
        for r in data:
            rows.append(tuple(str(x) for x in r) + (f"{stamp}_prices_staging_{LOAD}",))
    cols = ["id", "productid", "pricecomponentid", "pricecomponent", "price", "unit",
            "valid_from", "valid_until", "modificationdate", "source_table"]
    return spark.createDataFrame(rows, cols)


def product_staging(spark, months=None):
    rows = []
    for stamp, data in PRODUCT_FILES.items():
        if months and stamp[:6] not in months:
            continue
        for r in data:
            rows.append(tuple(str(x) for x in r) + ("no_data", f"{stamp}_products_staging_{LOAD}"))
    cols = ["id", "productcode", "productname", "energy", "consumptiontype", "deleted",
            "modificationdate", "releasedversion", "source_table"]
    return spark.createDataFrame(rows, cols)


CONTRACT_COLUMNS = ["id", "type", "energy", "usage", "usagenet", "createdat", "startdate", "enddate",
                    "filingdatecancellation", "cancellationreason", "city", "status", "productid",
                    "modificationdate", "source_table"]


def contract_staging(spark, rows):
    """rows: dicts with any of CONTRACT_COLUMNS; others become null."""
    data = [tuple(None if r.get(c) is None else str(r[c]) for c in CONTRACT_COLUMNS) for r in rows]
    schema = ", ".join(f"{c} string" for c in CONTRACT_COLUMNS)
    return spark.createDataFrame(data, schema)
