import random

from llm_fixtures import MESSY, empty, messy
from wattlake.llm import decontam as D


def distance(pattern, text):
    """Least edit distance of the pattern to any substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text))
        op = rng.random()
        if op < 0.34:
            text[k] = rng.choice("xyz")
        elif op < 0.67:
            del text[k]
        else:
            text.insert(k, rng.choice("xyz "))
    return "".join(text)


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        assert D.myers(p, t)[0] == distance(p, t)


def setting(seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 8))) for _ in range(60)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 40)))) for k in range(12)]
    docs = []
    for i in range(60):
        body = " ".join(rng.choice(words) for _ in range(rng.randrange(20, 120)))
        if i % 3 == 0:
            item = items[i % 12][1]
            n = rng.randrange(0, D.budget(item) + 4)
            body = f"{body[:50]} {edited(rng, item, n).upper()}\n{body[50:]}"
        docs.append((i, body))
    return items, docs


def brute(items, docs):
    out = set()
    for i, text in docs:
        for k, item in items:
            p, t = D.normalised(item), D.normalised(text)
            d = distance(p, t) if p else 1
            if p and d <= D.budget(p):
                out.add((i, k, d))
    return out


def test_search_equals_brute_force(spark):
    items, docs = setting()
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(items, docs)
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == want and len(got) == len(want) > 10
    assert any(d for *_, d in want)


def test_blocks_do_not_change_the_result(spark):
    items, docs = setting(3)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = D.contaminated(d, b).collect()
    assert len(list(D.blocks(b, 300))) > 3
    assert sorted(map(tuple, D.contaminated(d, b, block_chars=300).collect())) == sorted(map(tuple, whole))
    kept = {r["doc_id"] for r in D.decontaminated(d, b, block_chars=300).collect()}
    assert kept == {i for i, _ in docs} - {r["doc_id"] for r in whole}


def test_repeated_pieces_in_one_document():
    item = "ab ab ab ab ab ab ab ab ab ab ab ab ab ab"
    hit = D.Matcher([(1, item)]).find("ab " * 5000 + "x")
    assert hit and hit[0][:2] == (1, 0)


def test_short_items_need_whole_words():
    m = D.Matcher([(1, "Yes it is"), (2, ""), (3, None)])
    assert m.find("well, YES  it is.") == [(1, 0, 6, 15)] and m.find("yes it isnt") == []


def test_messy_and_empty(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, ""), (None, "negative id")],
                                  "item_id long, text string")
    got = D.contaminated(messy(spark), bench)
    assert sorted((r["doc_id"], r["item_id"] or -1) for r in got.collect()) == [(-3, -1), (1, 1), (5, 1), (5, 1)]
    kept = D.decontaminated(messy(spark), bench)
    assert kept.columns == messy(spark).columns and kept.count() == len(MESSY) - 4
    assert D.contaminated(empty(spark), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(messy(spark), none).count() == 0 and D.decontaminated(messy(spark), none).count() == len(MESSY)
