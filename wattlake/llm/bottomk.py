"""Bottom-k sketches of shingle hashes: fingerprints that merge.

A text's sketch is the ``k`` smallest distinct 64-bit hashes of its word
shingles.  Sketches of parts merge by keeping the k smallest of their union, so
the sketch of a corpus part never needs the part itself.  Two sketches estimate
resemblance (shared hashes among the k smallest of the union), containment and
the number of distinct shingles.

Words are runs of non-white-space of the lower-cased text; fewer than
``shingle`` words make one shingle of all of them, no words an empty sketch.
Two empty sketches resemble each other fully, an empty and a full one not at
all.  Null texts are empty.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, col, materialize, pieces

K = 128
SHINGLE_WORDS = 5
ROWS_PER_RANGE = 4096
_SPAN = 2.0 ** 64


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K,
                shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` plus the sketch of ``text`` (ascending signed hashes) as column ``name``."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), "")
    hashed = df.withColumn("__w_words", F.transform(words, lambda w: F.xxhash64(w)))
    h = F.col("__w_words")
    n = F.size(h)
    # Reading single elements; slicing an array inside the lambda would copy all of it.
    each = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, shingle)]))
    shingles = (F.when(n >= shingle, F.slice(each, F.lit(1), n - (shingle - 1))).when(n > 0, F.array(F.xxhash64(h)))
                .otherwise(F.array().cast("array<bigint>")))
    return hashed.withColumn(name, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)).drop("__w_words")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what ``a`` and ``b`` were made of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    union = merged(a, b, k)
    return (F.when(a == b, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Exact below k hashes, else (k - 1) over the share of the hash range they span."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(_SPAN / 2) + 1) / F.lit(_SPAN)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((F.size(sketch) - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too, 0 to 1 (empty ``a``: 1)."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def digest(sketch: Column) -> Column:
    """The sketch as one short string: equal sketches, equal digests."""
    return F.sha2(F.array_join(sketch.cast("array<string>"), ",").cast("binary"), 256)


def merge_groups(df: DataFrame, group: list[str], sketch: str, k: int = K, salts: int = 64) -> DataFrame:
    """One sketch per group from the sketches of its rows.

    The k smallest hashes are taken per (group, salt) first, so a group that
    holds a third of all rows is spread over ``salts`` tasks, and only
    ``salts * k`` hashes per group meet in the second step.
    """
    keys = [F.col(g) for g in group]
    hashes = df.select(*keys, F.explode(sketch).alias("h"))
    hashes = hashes.withColumn("salt", F.pmod(F.col("h"), F.lit(salts))).distinct()
    first = Window.partitionBy(*keys, "salt").orderBy("h")
    second = Window.partitionBy(*keys).orderBy("h")
    top = (hashes.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k)
           .withColumn("r", F.row_number().over(second)).where(F.col("r") <= k))
    found = top.groupBy(*keys).agg(F.sort_array(F.collect_list("h")).alias(sketch))
    empty = df.select(*keys).distinct().withColumn("__w_none", F.array().cast("array<bigint>"))
    on = None
    for g in group:
        same = empty[g].eqNullSafe(found[g])
        on = same if on is None else on & same
    if on is None:
        return found
    return empty.join(found, on, "left").select(*[empty[g] for g in group],
                                                F.coalesce(found[sketch], empty["__w_none"]).alias(sketch))


def _sort_number(text: Column) -> Column:
    """The first seven bytes of the text as a number that sorts as the texts do."""
    return F.conv(F.rpad(F.substring(F.hex(F.encode(F.substring(text, 1, 7), "UTF-8")), 1, 14), 14, "0"),
                  16, 10).cast("double")


def _cuts(keys: DataFrame) -> DataFrame:
    """One row per kind of id (null or not): its range starts, ascending, in blocks.

    A start is the key of some row: keys are doubles, as quantiles are, so ids
    beyond 2^53 may share one.  There is one for about every
    ``ROWS_PER_RANGE`` rows, in ``blocks`` of about the square root of their
    number, so that a search reads two short arrays.
    """
    found = []
    for no_id in (True, False):
        rows = keys.where(F.col("no_id") == no_id)
        n = pieces(rows.count(), ROWS_PER_RANGE)
        # One string instead of n expressions.
        marks = F.split(F.lit(",".join(str(i / n) for i in range(n))), ",").cast("array<double>")
        starts = rows.agg(F.percentile_approx("key", marks, F.lit(min(2 ** 31 - 1, 20 * n + 10_000))).alias("q"),
                          F.min("key").alias("first"))
        starts = starts.where("first is not null").select(F.array_sort(F.array_distinct(
            F.concat(F.array("first"), "q"))).alias("starts"))
        width = F.ceil(F.sqrt(F.size("starts"))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), ((F.size("starts") - 1) / width).cast("int")),
                             lambda i: F.slice("starts", i * width + 1, width))
        found.append(starts.select(F.lit(no_id).alias("no_id"), F.size("starts").alias("ranges"),
                                   width.alias("width"), blocks.alias("blocks")))
    return materialize(found[0].union(found[1]), "sketch-ranges")


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, text) rows with ``sketch``, and the text and sketch of the next document.

    Next in ascending (doc_id, text), nulls first; after the last comes the
    first.  Documents are dealt into ranges of doc_id, those without one into
    ranges of their text's first bytes; the number of ranges follows the rows.
    Each range is a task of its own and is sorted there: the texts move once.
    Behind its rows stands a copy of the next range's first row.  Rows with
    one doc_id, and rows without one whose texts begin alike, share a range,
    which is sorted on disk where it is large.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    no_id = F.col("doc_id").isNull()
    keyed = docs.withColumn("no_id", no_id).withColumn(
        "key", F.when(no_id, _sort_number(F.col("text"))).otherwise(F.col("doc_id").cast("double")))
    cuts = _cuts(keyed.select("no_id", "key"))
    ranges = {r["no_id"]: r["ranges"] for r in cuts.select("no_id", "ranges").collect()}
    before, n = ranges.get(True, 0), sum(ranges.values())

    # Two rows at most: the starts of either kind.
    dealt = keyed.join(F.broadcast(cuts), "no_id")
    block = F.size(F.filter(F.transform("blocks", lambda b: F.get(b, F.lit(0))), lambda c: c <= F.col("key"))) - 1
    dealt = dealt.withColumn("block", block)
    inside = F.get("blocks", F.col("block"))
    dealt = dealt.withColumn("at", F.size(F.filter(inside, lambda c: c <= F.col("key"))) - 1)
    part = F.when(F.col("no_id"), F.lit(0)).otherwise(F.lit(before)) + F.col("block") * F.col("width") + F.col("at")
    dealt = dealt.select("doc_id", "text", part.cast("int").alias("part"),
                         (F.get(inside, F.col("at")) == F.col("key")).alias("first"))

    # Every range has rows: its start is one's key.
    heads = dealt.where("first").groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("head"))
    heads = heads.select("head.doc_id", "head.text", F.pmod(F.col("part") - 1, F.lit(max(1, n))).alias("part"),
                         F.lit(True).alias("behind"))
    rows = dealt.select("doc_id", "text", "part", F.lit(False).alias("behind")).union(heads)
    rows = with_sketch(rows.repartitionById(max(1, n), F.col("part")), F.col("text"), "sketch", k)
    order = Window.partitionBy("part").orderBy("behind", "doc_id", "text")
    rows = rows.withColumn("__w_next", F.lead(F.struct("text", "sketch")).over(order)).where("not behind")
    return rows.select("doc_id", "text", "sketch", F.col("__w_next.text").alias("next_text"),
                       F.col("__w_next.sketch").alias("next_sketch"))


def edited_text(text: Column, n: Column, following: Column) -> Column:
    """The last floor(n / 4) code points replaced by the first as many of ``following``."""
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))


def fingerprints(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sketches of every text, of its edited text and of the next one, with likenesses."""
    rows = with_next(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), k)
    rows = rows.withColumn("n_chars", F.char_length("text"))
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("n_chars"), F.col("next_text")))
    rows = with_sketch(rows, F.col("edited"), "edited_sketch", k)
    return rows.withColumn("near_edited", resemblance(F.col("sketch"), F.col("edited_sketch"), k)).withColumn(
        "near_next", resemblance(F.col("sketch"), F.col("next_sketch"), k))
