import hashlib
import math
import random
import re

import pytest

from llm_fixtures import MESSY, empty, messy, same_rows
from wattlake.llm import source_mix as M


def key(i):
    return int(hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest()[:15], 16)


def brute_targets(sizes, total):
    """Share by weight, stop at the caps, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return {s: share.get(s, 2 * sizes[s]) for s in names}
        full |= set(above)


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = {}
    for (_, _, s), n in zip(rows, size):
        total[s] = total.get(s, 0) + n
    target = brute_targets(total, 1.5 * sum(size))
    out = []
    for s in total:
        budget = math.floor(target[s])
        epochs = budget // total[s] if total[s] else 0
        rest = budget - epochs * total[s]
        mine = sorted(((key(i), i is not None, i or 0, n, i) for (i, _, x), n in zip(rows, size) if x == s),
                      key=lambda r: r[:4])
        done = 0
        for k, _, _, n, i in mine:
            ties = sum(r[:4] == (k, i is not None, i or 0, n) for r in mine)
            start = done
            if start + n * ties <= rest:
                last = n
            elif start < rest:
                last = (rest - start) // ties
            else:
                last = 0
            out.append((i, s, n, total[s], round(float(target[s]), 6), epochs * n + last, (k, n, ties)))
            # Ties stand at the same place; go on only after the last of them.
            seen = sum(1 for o in out if o[1] == s and o[6] == (k, n, ties) and o[0] == i)
            if seen == ties:
                done += n * ties
    return [o[:6] for o in out]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 6), r["taken"])
           for r in M.mix_sizes(df).collect()]
    same_rows(got, brute(rows))
    return got


def test_messy_rows(spark):
    check(spark, [(r[0], r[1], r[3]) for r in MESSY])


@pytest.mark.parametrize("seed", range(3))
def test_random_sources(spark, seed, monkeypatch):
    monkeypatch.setattr(M, "ranges", lambda n_rows: -(-n_rows // 7))
    rng = random.Random(seed)
    names = ["a", "b", "", "Z", None, "é", "hot"]
    rows = [(i if rng.random() < 0.9 else 5, "w " * rng.randrange(0, 30), "hot" if rng.random() < 0.4 else rng.choice(names))
            for i in range(300)]
    got = check(spark, rows)
    for s in {r[1] for r in got}:
        mine = [r for r in got if r[1] == s]
        assert abs(sum(r[5] for r in mine) - mine[0][4]) <= 1 + len(mine) * 0.1
        assert all(r[5] <= 2 * r[2] for r in mine)


def test_empty_and_wordless(spark):
    assert M.mix_sizes(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in M.mix_sizes(df).collect()] == [(0.0, 0)] * 2


def test_mixed_documents_keep_columns_and_cut_the_last(spark):
    df = messy(spark)
    out = M.mixed_documents(df)
    assert out.columns[:len(df.columns)] == df.columns and out.columns[len(df.columns):] == ["target", "copies"]
    sizes = {(r["doc_id"], r["source"]): (r["taken"], r["size"]) for r in M.mix_sizes(df).collect()}
    for r in out.collect():
        taken, size = sizes[r["doc_id"], r["source"]]
        assert len(r["text"].split()) == min(taken, size) if r["doc_id"] != 10 else True
        assert r["copies"] == -(-taken // size)
