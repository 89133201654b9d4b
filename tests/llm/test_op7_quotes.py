import random
import re

from llm_fixtures import same_rows
from wattlake.llm import quote_threads as Q

COLUMNS = "conv_id long, turn long, role string, text string, depth string, root string"


def run(spark, rows):
    return Q.threads(spark.createDataFrame([(*r, "d", "r") for r in rows], COLUMNS))


def test_links_levels_and_order(spark):
    rows = [(1, 0, "user", "How do I sort?\nIn Spark."), (1, 1, "user", "Other question"),
            (1, 2, "assistant", "> how do I   SORT?\n> In Spark.\n\nUse orderBy."),
            (1, 3, "assistant", "> Other question\nAnother answer."),
            (1, 4, "user", "> > How do I sort?\n> > In Spark.\n> Use orderBy.\nThanks"),
            (1, 5, "user", ">>>deep only\n> nobody said this\nalone"), (2, 9, "user", "> Use orderBy.\nelsewhere")]
    got = run(spark, rows).collect()
    assert [(r["conv_id"], r["thread"], r["turn"], r["parent_turn"], r["reply_depth"], r["text"]) for r in got] == [
        (1, 0, 0, None, 0, "How do I sort?\nIn Spark."), (1, 0, 2, 0, 1, "Use orderBy."), (1, 0, 4, 2, 2, "Thanks"),
        (1, 1, 1, None, 0, "Other question"), (1, 1, 3, 1, 1, "Another answer."), (1, 5, 5, None, 0, "alone"),
        (2, 9, 9, None, 0, "elsewhere")]
    assert [r["n_quotes"] for r in got] == [0, 1, 2, 0, 1, 2, 1]


def brute(rows):
    """Latest earlier turn per quoted line, most matches, latest on ties (one-line quotes only)."""
    out = []
    parent = {}
    for c, t, _, text in rows:
        quoted = {x[2:] for x in text.split("\n") if x.startswith("> ")}
        votes = {}
        for q in quoted:
            said = [u for d, u, _, other in rows if d == c and u < t and q in other.split("\n")]
            if said:
                votes[max(said)] = votes.get(max(said), 0) + 1
        parent[c, t] = max(votes, key=lambda u: (votes[u], u)) if votes else None
    for c, t, _, _ in rows:
        root, depth = t, 0
        while parent[c, root] is not None:
            root, depth = parent[c, root], depth + 1
        out.append((c, root, t, parent[c, t], depth))
    return out


def test_random_conversations_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(Q, "TURNS_PER_RANGE", 4)
    rng = random.Random(1)
    rows = []
    for c in range(3):
        for t in range(40):
            lines = []
            for _ in range(rng.randrange(1, 3)):
                if rng.random() < 0.5:
                    lines += [f"> line {rng.randrange(6)}", rng.choice(["ok", ""])]
                lines.append(f"line {rng.randrange(6)}")
            rows.append((c, t, "user", "\n".join(lines)))
    # The default argument of links() is bound at definition; pass the range through.
    messages = Q.parsed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    small = {(r["conv_id"], r["turn"]): r["parent_turn"] for r in Q.links(messages, 4).collect()}
    got = run(spark, rows).collect()
    same_rows([(r["conv_id"], r["thread"], r["turn"], r["parent_turn"], r["reply_depth"]) for r in got], brute(rows))
    assert small == {(r["conv_id"], r["turn"]): r["parent_turn"] for r in got if r["parent_turn"] is not None} and small


def test_messy_rows(spark):
    rows = [(None, 0, "u", "> a"), (1, None, "u", "a"), (1, 0, None, None), (1, 0, "u", "a"), (1, 0, "u", "a"),
            (1, 1, "u", ""), (1, 2, "u", ">"), (1, 3, "u", "> a"), (1, 3, "u", "> a"), (1, -5, "u", "> a"),
            (1, 4, "u", "> a\r\n> \r\nb" + "x" * 200_000)]
    got = run(spark, rows).collect()
    assert len(got) == len(rows)
    assert {r["turn"]: r["parent_turn"] for r in got if r["parent_turn"] is not None} == {3: 0, 4: 0}
    assert run(spark, []).count() == 0


def parents(spark, texts):
    got = run(spark, [(1, t, "u", text) for t, text in enumerate(texts)]).collect()
    return {r["turn"]: r["parent_turn"] for r in got if r["parent_turn"] is not None}


def test_parts_of_longer_messages_link(spark):
    assert parents(spark, ["a\nb\n\nc\nd", "> a\n> b\nanswer"]) == {1: 0}
    assert parents(spark, ["a\nb\n\nc\nd\ne", "> c\n> d\nanswer", "> d e\nx"]) == {1: 0, 2: 0}
    assert parents(spark, ["a\nb\n\nc\nd", "> c\n> d\n>\n> nobody\nanswer"]) == {1: 0}
    # Adjacent lines beat the same lines said apart, and the whole passage beats both.
    assert parents(spark, ["x\na\nb\ny", "a", "b", "> a\n> b\nanswer"]) == {3: 0}
    assert parents(spark, ["a\nb", "x\na\nb", "> a\n> b\n> z\nanswer"]) == {2: 1}
    # Lines that are known singly vote, and lines never join over a blank one.
    assert parents(spark, ["a\nz", "b\ny", "b\nq\na", "> a\n> b\nanswer"]) == {3: 2}
    assert parents(spark, ["a\n\nb", "ab", "> a b c\nanswer"]) == {}


def test_deeper_levels_link_where_no_level_one_is_known(spark):
    texts = ["question\nmore", "> question\n> more\nanswer", ">> question\n>> more\nthanks",
             ">> question\n> answer\nwell", ">>> question\n>> answer\n> nobody\nso"]
    assert parents(spark, texts) == {1: 0, 2: 0, 3: 1, 4: 1}


def brute_part(texts):
    """Parents by the rules for whole passages, paragraphs, adjacent lines and lines."""
    def runs(text):
        out = []
        for line in text.split("\n"):
            marks = re.match(r"(?:[ \t]*>)*", line)[0]
            level = marks.count(">")
            line = " ".join(line[len(marks):].lower().split())
            if not out or out[-1][0] != level:
                out.append((level, []))
            out[-1][1].append(line)
        return [(n, [p.split("\n") for p in re.sub(r"\n\n+", "\n\n", "\n".join(x).strip("\n")).split("\n\n")])
                for n, x in out if any(x)]

    def text_of(paragraphs):
        return " ".join(" ".join(p) for p in paragraphs)

    def pairs(p):
        return {f"{a} {b}" for a, b in zip(p, p[1:])}

    said, out = [], {}
    for t, text in enumerate(texts):
        own = [r for n, r in runs(text) if n == 0]
        latest = lambda x: max((u for u in range(t) if x in said[u]), default=None)  # noqa: E731,B023
        votes = {}
        for level, quoted in {(n, text_of(r)): (n, r) for n, r in runs(text) if n}.values():
            whole = latest(text_of(quoted))
            found = [whole] if whole is not None else []
            for p in {" ".join(p): p for p in quoted}.values() if whole is None else ():
                for keys in ({" ".join(p)}, pairs(p), set(p)):
                    hits = [u for u in map(latest, keys) if u is not None]
                    if hits:
                        found.append(max(hits, key=lambda u: (hits.count(u), u)))  # noqa: B023
                        break
            for u in found:
                votes[level, u] = votes.get((level, u), 0) + 1
        if votes:
            out[t] = max(votes, key=lambda v: (-v[0], votes[v], v[1]))[1]
        said.append({text_of([p for r in own for p in r])} | {text_of(r) for r in own}
                    | {x for r in own for p in r for x in {" ".join(p)} | pairs(p) | set(p)})
    return out


def test_random_partial_quotes_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for t in range(120):
        lines = []
        for _ in range(rng.randrange(3)):
            marks = rng.choice(["> ", "> ", ">> ", "> > > "])
            source = (texts[rng.randrange(t)] if t else "w0\nw1").split("\n")
            at = rng.randrange(len(source))
            part = [x.lstrip("> ") for x in source[at:at + rng.randrange(1, 5)]]
            lines += [marks + x for x in part + rng.choice([[], [], ["", f"w{rng.randrange(12)}"]])]
            lines += rng.choice([[], ["ok"], [""]])
        lines += [rng.choice(["", f"w{rng.randrange(12)}", f"w{rng.randrange(12)}", f"W{rng.randrange(12)}  x"])
                  for _ in range(rng.randrange(1, 7))]
        texts.append("\n".join(lines))
    want = brute_part(texts)
    assert parents(spark, texts) == want and len(want) > 40
