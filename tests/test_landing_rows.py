"""Landing rows keep every cell: line breaks in quotes, odd quotes, long and short rows, repeated names."""

from pyspark.sql import functions as F

from wattlake.schema import EXPECTED_COLUMNS
from wattlake.sources import staging
from wattlake.streaming.landing_stream import start_landing_stream

NAMES = EXPECTED_COLUMNS["products"]


def _unit(root, stamp, rows, names=NAMES, sep=";"):
    root.mkdir(parents=True, exist_ok=True)
    path = root / f"{stamp}_products.csv"
    path.write_text("\n".join([sep.join(names), *rows]) + "\n", encoding="utf-8")
    return path


def _row(key, name="plain", sep=";", names=NAMES):
    cells = {"id": str(key), "productname": name, "modificationdate": "2020-01-01"}
    return sep.join(cells.get(c, "1") for c in names)


def test_rows_of_every_shape(spark, tmp_path):
    root = tmp_path / "a folder"  # with a space
    _unit(root, "20200101000000", [_row(1), _row(2, '"two\nlines; ""quoted"""'), _row(3)])
    _unit(root, "20200201000000", [_row(11), _row(12, 'a"b;c"d')])     # quotes inside a plain cell: one cell more
    _unit(root, "20200301000000", [_row(21), _row(22) + ";x;y", _row(23) + ";"])
    _unit(root, "20200401000000", [_row(31), _row(32).rsplit(";", 2)[0], _row(33, '5" pipe')])
    _unit(root, "20200501000000", [_row(41) + ";n1;n2"], names=[*NAMES, "note", "Note"])
    _unit(root, "20200601000000", [_row(51, '"a, b"', ",") + ",more"], names=[*NAMES, "note"], sep=",")
    loaded = staging.run_landing(spark, str(root), str(tmp_path / "staging"), "L1", entities="products")
    res = {r.file[4:6]: (r.status, r.rows_loaded, r.error) for r in loaded.log.collect()}
    view = staging.staging_view(spark, str(tmp_path / "staging"), "products", "L1")
    rows = {r.id: r for r in view.collect()}
    assert set(rows) == {1, 2, 3, 31, 32, 33, 51}
    assert {k: v[0] for k, v in res.items()} == {"01": "SUCCESS", "02": "FAILED", "03": "FAILED", "04": "SUCCESS",
                                                 "05": "FAILED", "06": "SUCCESS"}
    assert res["01"][1] == 3 and res["04"][1] == 3 and res["06"][1] == 1
    assert res["02"][2].startswith("1 row(s)") and res["03"][2].startswith("2 row(s)")
    assert res["05"][2] == "repeated column names: note"
    assert rows[2].productname == 'two\nlines; "quoted"' and rows[33].productname == '5" pipe'
    assert rows[51].productname == "a, b" and rows[32][NAMES[-1]] is None


def _stream(spark, tmp_path, load="B"):
    q = start_landing_stream(spark, str(tmp_path / "in"), str(tmp_path / "staging"), str(tmp_path / "ckpt"),
                             load_id_for=lambda b: f"{load}{b}", entities="products",
                             rules_dir=str(tmp_path / "rules"), log_dir=str(tmp_path / "log"))
    q.awaitTermination()
    assert q.exception() is None
    return {r.file[4:6]: (r.load_id, r.status, r.rows_loaded)
            for r in spark.read.parquet(str(tmp_path / "log")).collect()}


def test_stream_stages_a_failed_unit_once_rules_exist(spark, tmp_path):
    (tmp_path / "rules").mkdir()
    fewer = [c for c in NAMES if c != "productcode"]
    _unit(tmp_path / "in", "20200101000000", [_row(1)])
    _unit(tmp_path / "in", "20200201000000", [_row(2, names=fewer)], names=fewer)
    assert _stream(spark, tmp_path) == {"01": ("B0", "SUCCESS", 1), "02": ("B0", "FAILED", 0)}
    (tmp_path / "rules" / "matching_20200201000000_products.json").write_text(
        '{"__delimiter__": ";", "productcode": {"suggested": null, "user_submitted": 0, "pass_as_null": 1}}')
    for _ in range(2):  # the second start finds nothing to do
        assert _stream(spark, tmp_path) == {"01": ("B0", "SUCCESS", 1), "02": ("B0", "SUCCESS", 1)}
    assert staging.staging_view(spark, str(tmp_path / "staging"), "products", "B0").count() == 2


def test_stream_parts_of_a_unit_in_two_batches(spark, tmp_path):
    (tmp_path / "rules").mkdir()
    unit = tmp_path / "in" / "20200101000000_products.csv"
    unit.mkdir(parents=True)
    for k in (1, 2):
        (unit / f"part-{k}.csv").write_text(";".join(NAMES) + "\n" + _row(k) + "\n")
        q = start_landing_stream(spark, str(tmp_path / "in"), str(tmp_path / "staging"), str(tmp_path / "ckpt"),
                                 load_id_for=lambda b: "same", entities="products", log_dir=str(tmp_path / "log"))
        q.awaitTermination()
        assert q.exception() is None
    view = staging.staging_view(spark, str(tmp_path / "staging"), "products", "same")
    assert sorted(r.id for r in view.collect()) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "log")).agg(F.sum("rows_loaded")).first()[0] == 2
