import random

import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import MESSY, empty, messy
from wattlake.llm import simhash_variants as S


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_by_definition():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["Ab", "c", "É", "x y", "it"]) for _ in range(n)) for n in range(40)]
    for t in [*texts, None, "", " \t\r\n", "a\x0bb\x0cc d", "ÀÉ A"]:
        assert S.fingerprint(t) == slow_fingerprint(t)


def test_long_text_counts_in_chunks():
    text = " ".join(str(i % 977) for i in range(70_000))
    assert S.fingerprint(text) == slow_fingerprint(text)


def test_pairs_equal_all_pairs(spark):
    rng = random.Random(4)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(6):
            x = base
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1, 1 << 63}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [tuple(r) for r in S.near_pairs(df).collect()]
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    assert len(got) == len(set(got)) and set(got) == want and want
    assert len(want) > 100


def test_incomplete_distance_is_refused(spark):
    with pytest.raises(ValueError):
        S.near_pairs(spark.createDataFrame([(1,)], "fp long"), 6)


def test_components(spark):
    rng = random.Random(5)
    edges = [tuple(rng.sample(range(-40, 90), 2)) for _ in range(70)] + [(i, i + 1) for i in range(200, 240)]
    nodes = {n for e in edges for n in e}
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find(nodes, edges)
    assert S.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = union_find(range(len(rows)), near)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(root[k], []).append(i)
    least = {r: min((i for i in g if i is not None), default=None) for r, g in ids.items()}
    return [(i, f, least[root[k]]) for k, ((i, _), f) in enumerate(zip(rows, fps))]


def test_query_equals_brute_force(spark):
    rng = random.Random(6)
    rows = [r[:2] for r in MESSY]
    for k in range(30):
        words = [rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(120)]
        rows.append((100 + 3 * k, " ".join(words)))
        words[rng.randrange(120)] = "new"
        rows.append((101 + 3 * k, " ".join(words)))
        rows.append((102 + 3 * k, " ".join(words).upper()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.near_duplicates(df).select("doc_id", F.lower(F.hex("fp")).alias("f"), "component_id").collect()
    assert sorted(map(repr, ((r[0], int(r[1], 16), r[2]) for r in got))) == sorted(map(repr, brute(rows)))


def test_keep_one(spark):
    kept = S.keep_one(messy(spark))
    assert kept.columns == messy(spark).columns
    rows = kept.collect()
    # 5 repeats 1; 2, 3, 4 and the null text without an id are all empty.
    assert sorted((r["doc_id"] for r in rows if r["doc_id"] is not None)) == [-3, 1, 2, 6, 7, 8, 9, 10, 11]
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["no id here at all my friend"]
    assert all(r["size"] == "x" for r in rows)
    assert S.keep_one(empty(spark)).count() == 0 and S.near_duplicates(empty(spark)).count() == 0


def test_keep_one_keeps_a_row_of_every_component(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine",
               "red green blue cyan magenta yellow black white")
    assert S.keep_one(spark.createDataFrame([(3, a), (3, b)], "doc_id long, text string")).count() == 2
    rows = [(1, a), (2, a), (2, b), (None, c), (None, c), (5, b), (2, b)]
    for table in (rows, rows[::-1]):
        got = S.keep_one(spark.createDataFrame(table, "doc_id long, text string")).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(1, a), (2, b), (None, c)]))
