"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from its copy in a document by
``m // CHARS_PER_EDIT`` edits.  It is cut into one piece more than that, so a
copy within the budget holds at least one piece unchanged.  All pieces are
searched for exactly, in one pass over each whole text (Aho-Corasick); around
each hit, at the place the item would start, Myers' bit-parallel algorithm
computes the least edit distance of the whole item to any substring.

Texts are compared lower-cased with white-space runs as one space.  Items go
through in blocks of at most ``BLOCK_CHARS`` characters, each block one pass
over the documents, so what a task holds does not grow with the benchmark.
Items and documents without characters match nothing; an item shorter than
``CHARS_PER_EDIT`` must occur exactly, as whole words.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, text_batches

CHARS_PER_EDIT = 20
BLOCK_CHARS = 400_000
HITS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return len(item) // chars_per_edit


def cut(item: str, n: int) -> list[tuple[int, str]]:
    """``n`` pieces of nearly equal length with their offsets."""
    edges = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a substring of ``text``, and the first end where it is reached."""
    m = len(pattern)
    match: dict[str, int] = {}
    for i, c in enumerate(pattern):
        match[c] = match.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = match.get(c, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1, minus << 1
        up = full & (minus | ~(vertical | plus))
        down = full & plus & vertical
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int = CHARS_PER_EDIT):
        self.items = [(i, t) for i, t in ((i, normalised(t)) for i, t in items) if t]
        self.budgets = [budget(t, chars_per_edit) for _, t in self.items]
        where: dict[str, list] = {}
        for k, (_, t) in enumerate(self.items):
            for offset, piece in cut(t, self.budgets[k] + 1):
                where.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best match of every item within its budget."""
        text = normalised(text)
        if not text or not self.items:
            return []
        starts: dict[int, list] = {}
        for last, (n, places) in self.automaton.iter(text):
            for k, offset in places:
                starts.setdefault(k, []).append(last + 1 - n - offset)
        found = (self._verify(text, k, sorted(set(at))) for k, at in starts.items())
        return sorted(hit for hit in found if hit)

    def _verify(self, text: str, k: int, starts: list[int]) -> tuple[int, int, int, int] | None:
        item_id, item = self.items[k]
        e, m = self.budgets[k], len(item)
        if not e:
            exact = [s for s in starts if (s == 0 or not text[s - 1].isalnum())
                     and (s + m == len(text) or not text[s + m].isalnum())]
            return (item_id, 0, exact[0], exact[0] + m) if exact else None
        best = None
        low = high = starts[0]
        for s in [*starts[1:], None]:
            # Neighbouring starts share one window; long chains are cut so that
            # a window stays within a few items' lengths.
            if s is not None and s - high <= 2 * e and s - low <= 2 * m:
                high = s
                continue
            a = max(0, low - e)
            distance, end = myers(item, text[a:high + m + e])
            if distance <= e and (best is None or distance < best[1]):
                best = (item_id, distance, max(0, a + end - m), a + end)
            if best is not None and best[1] == 0:
                break
            low = high = s
        return best


def matches_column(text: Column, items: list[tuple[int, str]], chars_per_edit: int) -> Column:
    built: dict[str, Matcher] = {}

    @F.pandas_udf(HITS)
    def leaks(texts: pd.Series) -> pd.Series:
        if "m" not in built:
            built["m"] = Matcher(items, chars_per_edit)
        keys = ("item_id", "distance", "start", "end")
        return pd.Series([[dict(zip(keys, hit)) for hit in built["m"].find(t)] for t in texts], dtype=object)
    return leaks(text)


def blocks(benchmark: DataFrame, block_chars: int, item_col: str = "item_id", text_col: str = "text"):
    """Lists of items, each of at most ``block_chars`` characters (or one longer item)."""
    rows = benchmark.select(col(item_col).cast("long").alias("i"), col(text_col).alias("t")).where(
        F.col("t").isNotNull()).orderBy("i", "t")
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and size + len(r["t"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += len(r["t"])
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT,
                 block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, start, end): the best match of every item in every document.

    Offsets are those of the compared (lower-cased, single-spaced) text; start
    is exact when the distance is zero.
    """
    slim = text_batches(docs).select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    parts = [slim.select("doc_id", F.explode(matches_column(F.col("text"), block, chars_per_edit)).alias("m"))
             .select("doc_id", "m.*") for block in blocks(benchmark, block_chars)]
    if not parts:
        kind = docs.schema[id_col].dataType
        hit = [T.StructField("doc_id", kind), *HITS.elementType.fields]
        return docs.sparkSession.createDataFrame([], T.StructType(hit))
    return reduce(DataFrame.union, parts)


def decontaminated(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT,
                   block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found."""
    out = text_batches(docs)
    for block in blocks(benchmark, block_chars):
        out = out.where(F.size(matches_column(col(text_col), block, chars_per_edit)) == 0)
    return out
