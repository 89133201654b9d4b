"""Personal data by a skip-chain conditional random field.

Base patterns (e-mail, IP, card, phone) label a document's tokens.  Candidate
tokens - white-space words with a digit or ``@``, or that are the name part of an
address in the document - form a chain; tokens that
repeat or resemble each other anywhere in the document are joined by skip
edges.  Tokens under a base span are clamped to its label, the rest start near
"outside" by what their shape has meant in the corpus, and loopy message
passing lets repeated or similar tokens agree: a second mention that its
pattern misses (a number without its ``+``, an address without its domain) takes
its entity's label.  Base spans always stay; the method only adds.

The potentials are rates over all documents, as the base patterns label them, so
a table and the same table many times over have the same field.  How often two
mentions agree is counted where base patterns took both; a token that they left
out beside a labelled mention is what the field has to decide and counts neither
as a disagreement nor as outside.  Labelling covers every whole text.
Null texts are empty and have no spans.  Offsets are code points, end
exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, islice, takewhile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col
from .common import field as row_field
from .common import packed, text_batches

# The kinds in contract order.
KINDS = ("email", "ip", "card", "phone")
# Share of a rate that stays with its prior, however many cases are counted.
PRIOR = 0.25
# How often a mention is one that its base pattern misses.
MISSED = 0.03
ROUNDS = 20
DAMPING = 0.5
MIN_KEY = 6
# The base patterns of the contract, in their possessive form
# where that matches the same text (each part ends before a character it excludes).
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
_DIGITS = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_OTHER = re.compile(r"[^\w.+()@-]|_")
MARKS = "@.-+("
STRIP = ".,;:!?\"'()[]{}<>«»“”‘’…"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        k = ord(d) - 48
        if i % 2:
            k = k * 2 - 9 * (k > 4)
        total += k
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of every base match, by start, then kind."""
    spans = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                spans.append((m.start(), m.end(), 3))
    return sorted(spans, key=lambda s: (s[0], s[2]))


def tokens(text: str) -> list[tuple[int, int]]:
    """Spans of white-space words with a digit or ``@``, outer punctuation removed."""
    found, end, n = [], 0, len(text)
    m = _HINT.search(text)
    while m:
        start = stop = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        while stop < n and not text[stop].isspace():
            stop += 1
        end = stop
        word = text[start:stop]
        start += len(word) - len(word.lstrip(STRIP))
        stop -= len(word) - len(word.rstrip(STRIP))
        if start < stop:
            found.append((start, stop))
        m = _HINT.search(text, end)
    return found


def name_mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words that are the local part of one of the document's e-mail addresses."""
    names = {text[a:b].partition("@")[0].lower() for a, b, kind in spans if kind == 0}
    names = {n for n in names if len(n) >= MIN_KEY}
    found = []
    for m in _WORD.finditer(text) if names else ():
        word = m[0].lstrip(STRIP)
        start = m.end() - len(word)
        word = word.rstrip(STRIP)
        if word.lower() in names and not _HINT.search(word):
            found.append((start, start + len(word)))
    return found


def shape(word: str) -> str:
    """Digits, digit groups, letters and marks of the whole word; some ten thousand values at most."""
    groups = _DIGITS.findall(word)
    marks = "".join(m for m in MARKS if m in word) + ("x" if _OTHER.search(word) else "")
    letters = "a" if _LETTERS.search(word) else ""
    return f"{min(sum(map(len, groups)), 20)}/{min(len(groups), 5)}{letters}{marks}"


def keys(word: str) -> list[tuple[str, str]]:
    """What a token shares with its other mentions: (kind of link, key)."""
    lowered = word.lower()
    digits = "".join(_DIGITS.findall(word))
    out = [("same", lowered)] if len(lowered) >= MIN_KEY else []
    if len(digits) >= 7 and "@" not in word:
        out.append(("alike", digits[-7:]))
    local = lowered.partition("@")[0]
    if len(local) >= MIN_KEY:
        out.append(("alike", local))
    return out


def skip_edges(words: list[str]) -> list[tuple[int, int, str]]:
    """Each token linked to the mention before it, once per pair; ``same`` beats ``alike``."""
    last: dict[tuple[str, str], int] = {}
    edges: dict[tuple[int, int], str] = {}
    for i, word in enumerate(words):
        for kind, key in keys(word):
            j = last.get((kind, key))
            if j is not None and edges.get((j, i)) != "same":
                edges[j, i] = kind
            last[kind, key] = i
    return [(a, b, kind) for (a, b), kind in edges.items()]


def token_labels(found: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Per token 0 (outside) or 1 + kind of the first base span that it overlaps."""
    reach = list(accumulate((s[1] for s in spans), max))
    labels, k = [], 0
    for start, stop in found:
        while k < len(spans) and reach[k] <= start:
            k += 1
        near = takewhile(lambda s: s[0] < stop, islice(spans, k, None))  # noqa: B023
        labels.append(next((1 + s[2] for s in near if s[1] > start), 0))
    return labels


def events(text: str | None) -> list[str]:
    """What a document adds to the counts that the potentials come from."""
    text = text or ""
    found = tokens(text)
    if not found:
        return []
    labels = token_labels(found, base_spans(text))
    words = [text[a:b] for a, b in found]
    skips = skip_edges(words)
    open_ = {i for a, b, _ in skips for i, j in ((a, b), (b, a)) if labels[j] and not labels[i]}
    out = [f"u{y}\t{shape(w)}" for i, (w, y) in enumerate(zip(words, labels)) if i not in open_]
    out += [f"{kind}{int(labels[a] == labels[b])}" for a, b, kind in skips if labels[a] and labels[b]]
    out += [f"c{int(labels[i] == labels[i + 1])}" for i in range(len(found) - 1)
            if found[i + 1][0] - found[i][1] == 1 and (labels[i] or labels[i + 1]) and not {i, i + 1} & open_]
    return out


@dataclass(frozen=True)
class Potentials:
    """Counts of labels by token shape, and agreement weights of the edges (log-odds)."""

    shapes: dict[str, tuple] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=lambda: {"same": 6.4, "alike": 5.7, "c": 0.0})

    def unary(self, word: str) -> np.ndarray:
        """Log-weights of a token that no base pattern took, by shares of its shape's tokens."""
        n = np.asarray(self.shapes.get(shape(word), (0,) * 5), dtype=float)
        taken = n[1:].sum()
        kinds = PRIOR / len(KINDS) + (1 - PRIOR) * (n[1:] / taken if taken else np.full(len(KINDS), 1 / len(KINDS)))
        return np.log(np.concatenate([[1 + n[0] / max(n.sum(), 1)], MISSED * kinds]))


def potentials(counts: dict[str, int]) -> Potentials:
    """From counted events; each rate keeps a fixed share of what mentions of one thing usually do."""
    shapes: dict[str, list] = {}
    for event, n in counts.items():
        head, _, what = event.partition("\t")
        if what:
            shapes.setdefault(what, [0] * 5)[int(head[1:])] += n

    def weight(kind: str, differ: float, top: float) -> float:
        yes, no = counts.get(f"{kind}1", 0), counts.get(f"{kind}0", 0)
        if yes + no:
            differ = PRIOR * differ + (1 - PRIOR) * no / (yes + no)
        return min(max(math.log((1 - differ) / differ), 0.0), top)

    return Potentials({k: tuple(v) for k, v in shapes.items()},
                      {"same": weight("same", 1 / 601, 8), "alike": weight("alike", 1 / 301, 7),
                       "c": weight("c", 1 / 2, 1)})


def propagate(unary: np.ndarray, edges: list[tuple[int, int, float]], rounds: int = ROUNDS) -> np.ndarray:
    """Beliefs (rows sum to one) of loopy sum-product with agreement weights on the edges."""
    n, labels = unary.shape
    if not edges:
        b = np.exp(unary - unary.max(1, keepdims=True))
        return b / b.sum(1, keepdims=True)
    a = np.array([e[0] for e in edges] + [e[1] for e in edges])
    b = np.array([e[1] for e in edges] + [e[0] for e in edges])
    gain = np.expm1(np.array([e[2] for e in edges] * 2))[:, None]
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((len(a), labels))
    for _ in range(rounds):
        total = unary.copy()
        np.add.at(total, b, messages)
        out = total[a] - messages[back]
        out = np.exp(out - out.max(1, keepdims=True))
        new = np.log(out.sum(1, keepdims=True) + gain * out)
        new -= new.max(1, keepdims=True)
        step = DAMPING * messages + (1 - DAMPING) * new
        if np.abs(step - messages).max() < 1e-6:
            messages = step
            break
        messages = step
    total = unary.copy()
    np.add.at(total, b, messages)
    out = np.exp(total - total.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def label(text: str | None, model: Potentials) -> tuple[list[tuple], list[tuple]]:
    """Base spans and the spans the field adds, as (start, end, kind)."""
    text = text or ""
    if not _HINT.search(text):
        return [], []
    spans = base_spans(text)
    if not spans:
        return [], []
    found = sorted(tokens(text) + name_mentions(text, spans))
    words = [text[a:b] for a, b in found]
    labels = token_labels(found, spans)
    skips = skip_edges(words)
    # Without a skip edge at a free token no label can travel further than a chain weight.
    if not any(not labels[a] or not labels[b] for a, b, _ in skips):
        return spans, []
    unary = np.array([model.unary(w) for w in words])
    for i, y in enumerate(labels):
        if y:
            unary[i] = -60.0
            unary[i, y] = 0.0
    edges = [(a, b, model.weights[kind]) for a, b, kind in skips]
    edges += [(i, i + 1, model.weights["c"]) for i in range(len(found) - 1)
              if found[i + 1][0] - found[i][1] == 1 and model.weights["c"]]
    beliefs = propagate(unary, edges)
    best = beliefs.argmax(1)
    added = [(found[i][0], found[i][1], int(best[i]) - 1) for i in range(len(found))
             if not labels[i] and best[i] and beliefs[i, best[i]] > 0.5]
    return spans, added


def fit(docs: DataFrame, text_col: str = "text") -> Potentials:
    """Potentials from the counts of all documents; shapes have few values whatever the table's size."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = Counter(e for text in batch["text"] for e in events(text))
            yield pd.DataFrame({"event": pd.Series(list(n), dtype=object), "n": pd.Series(list(n.values()), dtype="int64")})

    seen = text_batches(docs).select(col(text_col).alias("text")).mapInPandas(counted, "event string, n long")
    return potentials({r["event"]: r["n"] for r in seen.groupBy("event").agg(F.sum("n").alias("n")).collect()})


def _flat(spans: list[tuple]) -> list[int]:
    return [x for s in spans for x in s]


def spans_column(text: Column, model: Potentials) -> Column:
    """struct<base, added>: arrays of start, end, kind in turn."""
    @F.pandas_udf("struct<base: array<int>, added: array<int>>")
    def spans(texts: pd.Series) -> pd.DataFrame:
        both = [label(t, model) for t in texts]
        return pd.DataFrame({"base": pd.Series([_flat(b) for b, _ in both], dtype=object),
                             "added": pd.Series([_flat(a) for _, a in both], dtype=object)})
    return spans(text)


def as_structs(flat: Column) -> Column:
    """array<struct<start, end, kind>> of a flat array."""
    step = F.sequence(F.lit(0), F.floor(F.size(flat) / 3).cast("int") - 1)
    made = F.transform(step, lambda i: F.struct(F.get(flat, i * 3).alias("start"), F.get(flat, i * 3 + 1).alias("end"),
                                                F.get(flat, i * 3 + 2).alias("kind")))
    return F.when(F.size(flat) > 0, made).otherwise(F.array().cast("array<struct<start:int,end:int,kind:int>>"))


def written(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind: int):
    """Predicate for ``filter`` over spans (of one argument: a second would be the index)."""
    return lambda span: span["kind"] == kind


def sorted_spans(spans: Column) -> Column:
    """By start, then kind as listed, then end."""
    moved = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                  s["end"].alias("end")))
    return F.array_sort(moved)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id with ``base`` and ``spans`` (base and added), sorted arrays of structs."""
    model = fit(docs, text_col)
    rows = docs.select(col(id_col).alias("doc_id"), spans_column(col(text_col), model).alias("s"))
    rows = rows.withColumn("b", as_structs(F.col("s.base"))).withColumn("a", as_structs(F.col("s.added")))
    return rows.select("doc_id", sorted_spans(F.col("b")).alias("base"),
                       sorted_spans(F.concat("b", "a")).alias("spans"))


def redact(text: str | None, model: Potentials) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    if not text:
        return text
    base, added = label(text, model)
    out, done, end = [], 0, -1
    for start, stop, kind in sorted(base + added, key=lambda s: (s[0], s[2])):
        if start >= end:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
            end = stop
        end = max(end, stop)
        done = end
    return "".join(out) + text[done:]


def redacted(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text, and the length column brought up to date."""
    model = fit(docs, text_col)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, model) for t in texts], dtype=object)

    rows = packed(docs).withColumn("__w_text", clean(row_field(text_col)))
    changed = {text_col: F.col("__w_text")}
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        changed[length_col] = F.when(row_field(text_col).isNull(), row_field(length_col)).otherwise(
            F.char_length("__w_text").cast(kind))
    return rows.select(*[changed.get(c, row_field(c)).alias(c) for c in docs.columns])
