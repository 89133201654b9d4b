"""Quoted line breaks read by blocks: the same records as one pass over the whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from wattlake.schema import EXPECTED_COLUMNS
from wattlake.sources import csv_records, staging

UNIT = "20200101000000_products.csv"


def _text(rows, sep, end):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator=end).writerows(rows)
    return out.getvalue()


def _cell(rnd):
    return rnd.choice(["plain", "two\nlines", 'a "quoted" word', "x;y,z", '"', "\n\n", "", 'end"', "é☃", "l" * rnd.randrange(60),
                       '"\n"', ";\n,"])


def _blocks(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    _blocks(spark, 64)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("sep,end,seed", [(";", "\n", 1), (",", "\r\n", 2), (";", "\n", 3)])
def test_blocks_equal_one_pass(spark, tmp_path, small_blocks, sep, end, seed):
    rnd = random.Random(seed)
    rows = [["id", "a", "b"]] + [[str(i), _cell(rnd), _cell(rnd)] for i in range(150)]
    rows[70][1] = "\n".join("a long cell; over many blocks" for _ in range(40))
    text = _text(rows, sep, end)
    (tmp_path / UNIT).write_text(text, encoding="utf-8", newline="")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = staging._scan_records(spark, [str(tmp_path)], sep, 3).collect()
    want = list(csv.reader(io.StringIO(text, newline=""), delimiter=sep))[1:]
    cells = sorted(tuple(c or "" for c in r["__cells"]) for r in got)
    assert cells == sorted(map(tuple, want)) and all(r["__closed"] for r in got)


def test_no_task_reads_a_whole_file(spark, tmp_path, small_blocks):
    """The lines of one file are spread over its blocks, and so are its records' texts."""
    (tmp_path / UNIT).write_text("id;a\n" + "".join(f'{i};"x\ny"\n' for i in range(300)))
    lines = csv_records.placed(staging._text(spark, [str(tmp_path)])).withColumn("__delimiter", F.lit(";")).withColumn(
        "__unit", F.lit(UNIT))
    most = lines.groupBy("__block").count().agg(F.max("count"), F.count("*")).first()
    assert most[0] <= 20 and most[1] > 30
    assert csv_records.records(lines).count() == 300


def test_an_open_quote_fails_its_unit(spark, tmp_path, small_blocks):
    names = EXPECTED_COLUMNS["products"]
    root = tmp_path / "in"
    root.mkdir()

    def row(key, name):
        return ";".join({"id": str(key), "productname": name, "modificationdate": "2020-01-01"}.get(c, "1") for c in names)

    head = ";".join(names)
    (root / UNIT).write_text("\n".join([head, row(1, '"never closed'), *[row(i, "x") for i in range(2, 30)]]) + "\n")
    (root / UNIT.replace("2020", "2021")).write_text(
        "\n".join([head, row(51, '5" pipe'), row(52, '"a\n""b"""'), row(53, 'a"b"c')]) + "\n")
    loaded = staging.run_landing(spark, str(root), str(tmp_path / "staging"), "L1", entities="products")
    log = {r.file[:4]: (r.status, r.error) for r in loaded.log.collect()}
    assert log == {"2020": ("FAILED", "a quoted cell does not end"), "2021": ("SUCCESS", None)}
    view = staging.staging_view(spark, str(tmp_path / "staging"), "products", "L1").collect()
    assert {r.id: r.productname for r in view} == {51: '5" pipe', 52: 'a\n"b"', 53: 'a"b"c'}
