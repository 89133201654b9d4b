"""What a landing row costs: its unit, its cells and its lineage are found without patterns on every row."""

from test_landing_rows import NAMES, _row

from wattlake.sources import landing, staging

FEWER = [c for c in NAMES if c != "productcode"]
RULES = '{"__delimiter__": ";", "productcode": {"suggested": null, "user_submitted": 0, "pass_as_null": 1}}'


def _file(path, rows, names=NAMES):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([";".join(names), *rows]) + "\n", encoding="utf-8")


def _landed(tmp_path):
    """Units as files and as folders, parts at several depths, folders that look like names of units."""
    root = tmp_path / "in=put" / "my_products.csv" / "2019_products.csv"
    _file(root / "20200101000000_products.csv", [_row(1), _row(2)])
    _file(root / "a b" / "unit=20200201000000_products.csv" / "part 1.csv", [_row(11)])
    _file(root / "a b" / "unit=20200201000000_products.csv" / "more" / "k=20209999000000" / "part-2.csv", [_row(12)])
    _file(root / "20200301000000_products.csv" / "part-1.csv", [_row(21, names=FEWER)], FEWER)
    # Quoted line breaks at two depths of one unit, a row that is too long in each part of another.
    for k, name in enumerate(["p.csv", "deep/p.csv"]):
        _file(root / "20200401000000_products.csv" / name, [_row(31 + k, '"two\nlines"', names=FEWER)], FEWER)
        _file(root / "20200501000000_products.csv" / name, [_row(41 + k), _row(51) + ";x;y"])
    rules = tmp_path / "rules"
    rules.mkdir()
    for month in ("03", "04"):
        (rules / f"matching_2020{month}01000000_products.json").write_text(RULES)
    return str(root), str(rules)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_units_at_every_depth_are_staged_whole(spark, tmp_path):
    root, rules = _landed(tmp_path)
    loaded = staging.run_landing(spark, root, str(tmp_path / "staging"), "L1", entities="products", rules_dir=rules)
    log = [(r.file[4:6], r.status, r.rows_loaded, r.error) for r in loaded.log.collect()]
    assert sorted(log, key=lambda r: r[0]) == [
        ("01", "SUCCESS", 2, None), ("02", "SUCCESS", 2, None), ("03", "SUCCESS", 1, None),
        ("04", "SUCCESS", 2, None), ("05", "FAILED", 0, "2 row(s) with more cells than the header")]
    rows = {r.id: r for r in staging.staging_view(spark, str(tmp_path / "staging"), "products", "L1").collect()}
    assert set(rows) == {1, 2, 11, 12, 21, 31, 32}
    assert {k: r.source_table for k, r in rows.items()}[12] == "20200201000000_products_staging_L1"
    assert {k for k, r in rows.items() if r.productcode == "no_data"} == {21, 31, 32}
    assert rows[31].productname == "two\nlines" and rows[1].productcode == "1"


def test_no_row_meets_a_pattern_for_its_unit(spark, tmp_path):
    root, rules = _landed(tmp_path)
    files = staging._written(landing.select_files(landing.list_landing(spark, root), "products", "202001", "202003"),
                             "files")
    plan, _ = landing.reconcile(landing.unit_headers(files).drop("read_error"), landing.read_rules(spark, rules))
    plan = staging._written(plan, "plan")
    report = _plan(staging._line_report(spark, files, staging._layouts(plan), True))
    # Lines are reduced to a row per file before they meet their unit and its join.
    assert report.count("Join") == 1 and report.index("Join") < report.index("Aggregate [__file")
    assert not any("value#" in line and "regexp_extract" in line for line in report.split("\n"))
    frames = staging.read_units(spark, files, staging._written(staging.check_rows(spark, files, plan), "checked"))
    staged = _plan(staging.stage(frames["products"], "L1"))
    assert "regexp" not in staged
