"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's frequency vector has GROUPS counts, one per letter group (letters
whose code points agree modulo GROUPS).  Words are arranged in a trie by
successive counts.  A word at one inserted, deleted or replaced letter has a
vector with at most one count higher by one and at most one lower by one, so a
depth-first search that spends a surplus and a deficit of one each reaches it;
words of the leaf are then verified letter by letter.

Every pair is met once, from the word that has fewer letters of the first group
in which the two differ (words of one leaf: the smaller word), so a search
spends its surplus before its deficit.

The first levels of the trie are Spark's key: every word is filed under its own
counts of those levels and sent to the keys that the budgets reach from there;
a task builds the rest of one key's trie and searches it.  As many levels are
keys as it takes for no key to hold more than SHARD words; words with all
counts alike beyond that number are dealt into blocks, each searched by all.
Tasks return sums per word, never pairs.

Null and empty texts have no words.  A null id counts as the empty text in the
hash of a dropped letter.  Repeated rows count as often as they occur, other
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, materialize, pieces, text_batches

# Fixed by the contract: letters of a run, the letter dropped from rare runs, word and form bounds.
RUN = "[A-Za-zÀ-ÿ]"
DROP_EVERY = 199
MIN_CHARS, MIN_COUNT, FORM_RATIO = 6, 5, 5

GROUPS = 12
SHARD = 25_000
DEPTHS = (3, 4, 5, 6, 8, 10, GROUPS)
# Words whose searches make a task.
TASK_WORDS = 8_000
# Words of a leaf from which on it is indexed by halves.
LARGE_LEAF = 8
# Distinct words a counting task holds before it passes them on.
HELD = 300_000

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def spelled(run: str, prefix_crc: int, drop_every: int | None) -> str:
    """The lower-cased run, without one letter where ``drop_every`` divides its hash."""
    word = run.translate(LOWER)
    if drop_every:
        h = zlib.crc32(word.encode(), prefix_crc)
        if h % drop_every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
    return word


def _count(min_chars: int, drop_every: int | None
           ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"{RUN}{{{min_chars},}}")  # shorter runs never make a word
        held: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                prefix = zlib.crc32(f"{i}:".encode())
                for found, n in Counter(runs.findall(text)).items():
                    word = spelled(found, prefix, drop_every)
                    if len(word) >= min_chars:
                        held[word] += n
            if len(held) > HELD:
                yield out(held)
                held = Counter()
        yield out(held)
    return run


def words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, drop_every: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with at least ``min_chars`` letters and ``min_count`` occurrences."""
    texts = text_batches(docs).where(col(text_col).isNotNull()).select(
        F.coalesce(col(id_col).cast("string"), F.lit("")).alias("id"), col(text_col).alias("text"))
    return (texts.mapInArrow(_count(min_chars, drop_every), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def vector(word: str) -> list[int]:
    counts = [0] * GROUPS
    for c in word:
        counts[ord(c) % GROUPS] += 1
    return counts


def vector_column(word: Column) -> Column:
    @F.pandas_udf("string")
    def written(found: pd.Series) -> pd.Series:
        return found.map(lambda w: ",".join(map(str, vector(w))))
    return written(word)


def reached(counts: list[int]) -> Iterator[tuple[list[int], int]]:
    """The keys in reach of a key's counts, with what is spent: 0 nothing, 1 the surplus, 2 both."""
    yield counts, 0
    for up in range(len(counts)):
        more = [*counts[:up], counts[up] + 1, *counts[up + 1:]]
        yield more, 1
        for down in range(up + 1, len(counts)):
            if more[down]:
                yield [*more[:down], more[down] - 1, *more[down + 1:]], 2


def routed(depth: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows (shard, word, n, spent): a word in its own shard (-1) and as a search in all in reach."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: dict[tuple[int, ...], list[tuple[str, int]]] = {}
        for frame in frames:
            out = []
            for word, n, v in zip(frame["word"], frame["n"], frame["v"], strict=True):
                counts = tuple(map(int, v.split(",")[:depth]))
                to = names.get(counts)
                if to is None:
                    to = [(",".join(map(str, c)), spent) for c, spent in reached(list(counts))]
                    if len(names) < HELD // 10:
                        names[counts] = to
                out.append((to[0][0], word, n, -1))
                out.extend((shard, word, n, spent) for shard, spent in to)
            yield pd.DataFrame(out, columns=["shard", "word", "n", "spent"])
    return run


def one_edit(a: str, b: str) -> bool:
    """True if exactly one inserted, deleted or replaced letter makes a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        at += 1
    return a[at + (len(a) == len(b)):] == b[at + 1:]


class Leaf:
    """Words with the same counts, (word, n) each."""

    __slots__ = ("halves", "words")

    def __init__(self) -> None:
        self.words: list[tuple[str, int]] = []
        self.halves: dict[int, tuple[dict, dict]] = {}

    def candidates(self, word: str) -> list[tuple[str, int]]:
        """All that can be one edit from ``word``: in a large leaf, those that share its first or last half.

        An edit lies in one half of the shorter word, so the other half is alike.
        """
        half = min(len(word), len(self.words[0][0])) // 2
        if len(self.words) < LARGE_LEAF or not half:
            return self.words
        if half not in self.halves:
            heads, tails = {}, {}
            for item in self.words:
                heads.setdefault(item[0][:half], []).append(item)
                tails.setdefault(item[0][-half:], []).append(item)
            self.halves[half] = heads, tails
        heads, tails = self.halves[half]
        head = word[:half]
        return heads.get(head, []) + [x for x in tails.get(word[-half:], ()) if x[0][:half] != head]


def trie(own: list[tuple[str, int]], depth: int) -> dict:
    """Nested counts of the levels from ``depth`` on (one level of 0 if none is left); a leaf lists its words."""
    root: dict = {}
    for item in own:
        node, counts = root, vector(item[0])[depth:] or [0]
        for c in counts[:-1]:
            node = node.setdefault(c, {})
        node.setdefault(counts[-1], Leaf()).words.append(item)
    return root


def leaves(root: dict, counts: list[int], spent: int) -> Iterator[tuple[Leaf, bool]]:
    """Leaves in reach of ``counts``, and whether nothing was spent on the way."""
    counts = counts or [0]
    last = len(counts) - 1
    stack = [(root, 0, spent)]
    while stack:
        node, level, used = stack.pop()
        c = counts[level]
        steps = [(c, used)]
        if used == 0:
            steps.append((c + 1, 1))
        elif used == 1 and c:
            steps.append((c - 1, 2))
        for key, now in steps:
            child = node.get(key)
            if child is not None:
                if level == last:
                    yield child, now == 0
                else:
                    stack.append((child, level + 1, now))


def search(depth: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One shard: (word, n_near, best_n, best) of the pairs its searches find, from both ends."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = list(zip(frame["word"], frame["n"], frame["spent"], strict=True))
        root = trie([(w, n) for w, n, spent in rows if spent < 0], depth)
        near: dict[str, list] = {}

        def note(word: str, other: str, n: int) -> None:
            kept = near.get(word)
            if kept is None:
                near[word] = [1, n, other]
            else:
                kept[0] += 1
                if n > kept[1] or n == kept[1] and other < kept[2]:
                    kept[1:] = n, other

        if root:
            for word, n, spent in rows:
                if spent >= 0:
                    for leaf, same in leaves(root, vector(word)[depth:], spent):
                        for other, m in leaf.candidates(word):
                            if (not same or word < other) and one_edit(word, other):
                                note(word, other, m)
                                note(other, word, n)
        return pd.DataFrame([(w, *kept) for w, kept in near.items()], columns=["word", "n_near", "best_n", "best"])
    return run


def _shard(depth: int) -> Column:
    return F.substring_index("v", ",", depth)


def near_words(found: DataFrame, shard_words: int = SHARD) -> DataFrame:
    """(word, n_near, best_n, best): number of near words, and the one of largest n (then smallest).

    ``found`` has (word, n), each word once.
    """
    vectors = materialize(found.select("word", "n", vector_column(F.col("word")).alias("v")), "vectors")
    each = vectors.groupBy("v").agg(F.count("*").alias("c"))
    sizes = each.select("c", F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _shard(d).alias("shard"))
                                                 for d in DEPTHS])).alias("s")).groupBy("s").agg(F.sum("c").alias("c"))
    most, total = {}, 0
    for r in sizes.groupBy("s.depth").agg(F.max("c").alias("c"), F.sum("c").alias("total")).collect():
        most[r["depth"]], total = r["c"], r["total"]
    depth = next((d for d in DEPTHS if most.get(d, 0) <= shard_words), GROUPS)
    rows = vectors.mapInPandas(routed(depth), "shard string, word string, n long, spent int")
    keys = ["shard"]
    if most.get(depth, 0) > shard_words:
        rows, keys = blocks(rows, vectors, shard_words), ["shard", "block", "turn"]
    # A search costs more than its bytes tell, so the number of tasks follows the words.
    dealt = rows.repartition(pieces(total, TASK_WORDS), *keys)
    parts = dealt.groupBy(*keys).applyInPandas(search(depth), "word string, n_near long, best_n long, best string")
    return (parts.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")))


def blocks(rows: DataFrame, vectors: DataFrame, shard_words: int) -> DataFrame:
    """Rows of the shards over the bound, dealt to (block of own words, turn of searches).

    Every block meets every turn once; all others keep one block and turn.
    """
    large = (vectors.groupBy(F.col("v").alias("shard")).agg(F.count("*").alias("c")).where(F.col("c") > shard_words)
             .select("shard", F.ceil(F.col("c") / shard_words).cast("int").alias("parts")))
    mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = rows.join(large, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = (dealt.where("spent < 0").withColumn("block", mine).withColumn("turn", F.explode(every)))
    asked = (dealt.where("spent >= 0").withColumn("turn", mine).withColumn("block", F.explode(every)))
    return own.unionByName(asked).drop("parts")


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of (word, form): the end of the chain of forms, by pointer doubling.

    ``steps`` is the longest chain's length at most.  A form is its words' near
    word, so no form has more words than a word has letters to change.
    """
    now = forms.select("word", F.col("form").alias("root"))
    for i in range(max(0, math.ceil(math.log2(max(1, steps))))):
        now = materialize(now, f"roots-{i}")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return now


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO,
             drop_every: int | None = None, shard_words: int = SHARD, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    A word's form is its near word of largest n (ties: smallest by code point)
    if that n is at least ``ratio`` times the word's own; its root is the end of
    the chain of forms, the word itself without a form.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could run in a circle")
    found = materialize(words(docs, min_chars, min_count, drop_every, id_col, text_col), "words")
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = materialize(found.join(near_words(found, shard_words), "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "formed")
    span = formed.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    steps = math.floor(math.log(span["most"] / span["least"], ratio) + 1e-9) if span["most"] else 0
    ends = roots(formed.where("form is not null"), steps)
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                    "n_near", "form_n")
