"""Cells that do not fit their type: kept aside on request, the default still fails; job options."""

import datetime as dt

import pytest

from samples import MONTHS
from test_end_to_end import _write_landing, _write_rules
from wattlake.plans import job
from wattlake.schema import EXPECTED_COLUMNS, typed_projection
from wattlake.sources import staging

NAMES = EXPECTED_COLUMNS["contracts"]


def _row(key, **cells):
    base = {"id": str(key), "productid": "7", "usage": "100", "startdate": "2020-01-01", "modificationdate": "2020-01-01"}
    return tuple((base | cells).get(c) for c in NAMES) + ("20200101000000_contracts_staging_L1",)


def _text(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*NAMES, "source_table"]))


def test_rows_and_cells(spark):
    text = _text(spark, _row(1), _row(2, usage="12x", startdate="never"), _row(3, usage=" ", enddate="NULL"),
                 _row(4, usage="99999999999999"), _row("5?"), _row(6, usage="7.0", startdate="2020-02-03 00:00:00"))
    typed, rejects = staging.split_rejects(text, "contracts", "q")
    assert sorted((r.id, r.usage, r.startdate) for r in typed.collect()) == [
        (1, 100, dt.date(2020, 1, 1)), (3, None, dt.date(2020, 1, 1)), (6, 7, dt.date(2020, 2, 3))]
    assert {(r.column, r.text, r.reason) for r in rejects.collect()} == {
        ("usage", "12x", "not a int"), ("startdate", "never", "not a date"), ("usage", "99999999999999", "not a int"),
        ("id", "5?", "not a bigint")}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        typed_projection(text, "contracts").collect()
    strict = typed_projection(text.where("id in ('1', '3', '6')"), "contracts")
    assert sorted(map(str, strict.collect())) == sorted(map(str, typed.select(strict.columns).collect()))


def test_nothing_staged(spark, tmp_path):
    assert staging.quarantined_view(spark, str(tmp_path), "contracts", "L1").count() == 0


def test_load_with_a_bad_cell(spark, tmp_path):
    _write_landing(tmp_path / "landing")
    _write_rules(tmp_path / "rules")
    unit = sorted((tmp_path / "landing").glob("**/*_prices.csv"))[0]
    lines = unit.read_text(encoding="utf-8").splitlines()
    sep = ";" if ";" in lines[0] else ","
    at = [c.strip('"') for c in lines[0].lstrip("﻿").split(sep)].index("price")
    cells = lines[1].split(sep)
    cells[at] = "dear"
    unit.write_text("\n".join([lines[0], sep.join(cells), *lines[2:]]) + "\n", encoding="utf-8")

    def load(name, **options):
        return job.run_load(spark, str(tmp_path / "landing"), str(tmp_path / name), str(tmp_path / f"{name}-dwh"),
                            MONTHS[0], MONTHS[3], dt.date(2023, 2, 2), rules=str(tmp_path / "rules"),
                            run_ts=dt.datetime(2023, 2, 2), **options)

    with pytest.raises(Exception, match="dear"):
        load("strict")
    out = load("lenient", quarantine=True)
    log = spark.read.parquet(str(tmp_path / "lenient" / "_load_log"))
    kept = log.where("status = 'REJECTED'").collect()
    assert [(r.file, r.rows_loaded, r.error) for r in kept] == [(unit.name, 1, "cells that do not fit: price: 1")]
    rejects = spark.read.parquet(str(tmp_path / "lenient" / "_rejects" / "prices"))
    assert [(r.column, r.text) for r in rejects.collect()] == [("price", "dear")]
    assert out["tables"]["price_periods"].count() > 0


def test_options_reach_the_job(spark, tmp_path, monkeypatch):
    seen = {}

    def run_load(spark, *args, **options):
        seen.update(options)
        return {"load_id": "L", "log": spark.createDataFrame([], "status string, file string, error string")}

    class Builder:
        def appName(self, _):
            return self

        def getOrCreate(self):
            return spark

    monkeypatch.setattr(job, "run_load", run_load)
    monkeypatch.setattr(job, "SparkSession", type("S", (), {"builder": Builder()}))
    need = ["--landing", "l", "--staging", "s", "--warehouse", "w", "--end", "202301", "--as-of", "2023-02-02"]
    assert job.main(need) == 0
    assert (seen["pick"], seen["on_change"], seen["drift"], seen["overlap"], seen["quarantine"]) == (
        "longest", "close_only", True, "latest", False)
    job.main([*need, "--pick", "current", "--on-change", "close_and_open", "--no-drift", "--calendar-year", "--align",
              "--overlap", "error", "--quarantine", "--missing-as-null", "--only-new"])
    assert {k: seen[k] for k in ("pick", "on_change", "drift", "calendar_year", "align", "overlap", "quarantine",
                                 "missing_as_null", "only_new")} == {
        "pick": "current", "on_change": "close_and_open", "drift": False, "calendar_year": True, "align": True,
        "overlap": "error", "quarantine": True, "missing_as_null": True, "only_new": True}


def test_options_change_the_published_tables(spark, tmp_path):
    _write_landing(tmp_path / "landing")
    _write_rules(tmp_path / "rules")

    def periods(name, **options):
        out = job.run_load(spark, str(tmp_path / "landing"), str(tmp_path / name), str(tmp_path / f"{name}-dwh"),
                           MONTHS[0], MONTHS[3], dt.date(2023, 2, 2), rules=str(tmp_path / "rules"),
                           run_ts=dt.datetime(2023, 2, 2), check="none", **options)["tables"]["price_periods"]
        return {tuple(r) for r in out.select("product_id", "valid_from", "valid_until").collect()}

    plain, aligned = periods("a"), periods("b", align=True, calendar_year=True)
    assert len(plain) == 18 and aligned != plain
    assert all(f <= u and f.year == u.year for _, f, u in aligned)
