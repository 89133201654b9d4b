"""Dense keys: gap-free and unique over loads, replays included, and no single-task step."""

import random

from wattlake.operators import dense_keys


def _rows(spark, *keys):
    return spark.createDataFrame([(k, None if k % 5 == 0 else f"v{k % 3}") for k in keys], "a int, b string").repartition(5)


def test_loads_continue_and_replays_repeat(spark, tmp_path):
    path = str(tmp_path / "keys")
    rnd = random.Random(3)
    seen = {}
    for load in range(4):
        keys = [rnd.randrange(400) for _ in range(150)]
        got = {(r.a, r.b): r.sk for r in dense_keys.assign(_rows(spark, *keys, *keys[:20]), ["a", "b"], path, f"L{load}").collect()}
        assert len(got) == len(set(keys)) and all(got[k] == seen[k] for k in got if k in seen)
        seen |= got
        assert sorted(seen.values()) == list(range(1, len(seen) + 1))
    again = {(r.a, r.b): r.sk for r in dense_keys.assign(_rows(spark, *keys), ["a", "b"], path, "L3").collect()}
    assert set(again) == set(got) and sorted((seen | again).values()) == list(range(1, len(seen) + 1))


def test_empty_load(spark, tmp_path):
    assert dense_keys.assign(_rows(spark, 1).limit(0), ["a", "b"], str(tmp_path), "L1").count() == 0
    assert [r.sk for r in dense_keys.assign(_rows(spark, 7), ["a", "b"], str(tmp_path), "L2").collect()] == [1]


def test_no_row_passes_a_single_task(spark):
    rows = spark.range(0, 1000, 1, 6)
    out, last = dense_keys.numbered(rows, 41)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert last == 1041 and sorted(r.sk for r in out.collect()) == list(range(42, 1042))
