import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from llm_fixtures import empty, messy, same_rows
from wattlake.llm import spelling as M


def edits(a, letters):
    cut = {a[:i] + a[i + 1:] for i in range(len(a))}
    put = {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in letters}
    swap = {a[:i] + c + a[i + 1:] for i in range(len(a)) for c in letters}
    return (cut | put | swap) - {a}


def brute(docs, min_chars=6, min_count=5, ratio=5, drop_every=None):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    letters = set("".join(n))
    form, near = {}, {}
    for w in n:
        near[w] = [x for x in edits(w, letters) if x in n]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def corpus(seed, docs=60):
    rnd = random.Random(seed)
    stems = ["harbour", "Harbor", "colour", "color", "naïvely", "reïssue", "ÀÉÖabc", "lantern", "lanternn", "gnomes"]
    stems += ["".join(rnd.choice("abcé") for _ in range(6)) for _ in range(40)]
    out = []
    for i in range(docs):
        ws = []
        for _ in range(80):
            w = stems[min(int(rnd.expovariate(0.15)), len(stems) - 1)]
            if rnd.random() < 0.2:
                at = rnd.randrange(len(w))
                w = rnd.choice([w[:at] + w[at + 1:], w[:at] + "x" + w[at:], w[:at] + "e" + w[at + 1:]])
            ws.append(w if rnd.random() < 0.8 else w.upper())
        out.append((i, " ".join(ws) + "."))
    return out


def run(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return [tuple(r) for r in M.variants(df, **options).collect()]


# Words a key may hold: a few levels, more, all levels and blocks of one word.
@pytest.mark.parametrize("shard_words", [50_000, 12, 1])
def test_equals_brute_force(spark, shard_words):
    docs = corpus(1)
    want = brute(docs, min_count=2, drop_every=7)
    assert sum(f is not None for _, f, *_ in want) > 20
    same_rows(run(spark, docs, min_count=2, drop_every=7, shard_words=shard_words), want)


def test_chains_ties_and_long_words(spark):
    long = "qwerty" * 500
    words = {"abcdef": 1000, "abcdeg": 150, "abcdxg": 20, "abcyxg": 4, "hhhhhh": 3, "hhhhhi": 20, "hhhhih": 20,
             long: 30, long + "z": 5, "rolled": 30, "roller": 30}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    got = run(spark, docs, min_count=3)
    same_rows(got, brute(docs, min_count=3))
    by = {r[0]: r for r in got}
    assert by["abcyxg"][1:3] == ("abcdxg", "abcdef")
    assert by["hhhhhh"][1] == "hhhhhi" and by["rolled"][1] is None and by["rolled"][4] == 1
    assert by[long + "z"][2] == long


def test_messy_and_empty_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in messy(spark).select("doc_id", "text").collect()]
    got = [tuple(r) for r in M.variants(messy(spark), min_chars=3, min_count=1, drop_every=3).collect()]
    same_rows(got, brute(rows, 3, 1, 5, 3))
    assert M.variants(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        M.variants(empty(spark), ratio=1)


def test_every_near_pair_is_reached_once():
    """All pairs of a small set, through the keys and the trie at every depth."""
    found = ["".join(p) for n in (2, 3) for p in itertools.product("amb", repeat=n)]
    want = {frozenset(p) for p in itertools.combinations(found, 2) if p[1] in edits(p[0], "amb")}
    for depth in (1, 3, M.GROUPS):
        met = Counter()
        for a in found:
            for key, spent in M.reached(M.vector(a)[:depth]):
                own = [(w, 1) for w in found if M.vector(w)[:depth] == key]
                if own:
                    for leaf, same in M.leaves(M.trie(own, depth), M.vector(a)[depth:], spent):
                        met.update(frozenset((a, b)) for b, _ in leaf.candidates(a) if (not same or a < b) and M.one_edit(a, b))
        assert set(met) == want and set(met.values()) == {1}
