"""Chat formatting by quotation linking.

A line's quote level is its number of leading ``>``; a run of lines of one level
is a passage, its parts between blank lines are its paragraphs.  All are
normalised (lower case, white space as one space) and hashed.  A message can be
quoted whole, by a run of its own (level zero) lines, by a paragraph, by two
adjacent lines or by a line.  A quoted passage is answered by the latest earlier
message of the conversation that has all of it; if none has, each of its
paragraphs is looked up for itself, and a paragraph that none has goes to the
message with most of its adjacent lines, or else with most of its lines, the
latest on ties.  A message with several quotes answers the one with most
matching passages, the latest on ties.  Quotes at level one count first; those
of the next level count where none of the levels before is known, and lead to
the message that wrote them.

A message that quotes nothing known starts a thread; threads are the trees of
quote links.  The result has one row per message, in reply order: threads by
their first turn, inside a thread by turn, so a message stands after everything
it answers and before the next thread; quotes are removed.  No conversation is
ever gathered: links are as-of joins with turns dealt into ranges, and roots
are found by pointer jumping.

Null texts are empty messages; rows that repeat (conv_id, turn) stay and share
their links; a null turn or conv_id sorts first and links nothing.  DataFrame
operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, materialize

TURNS_PER_RANGE = 1024
# What a quotation is found by, the finest first.
LINE, PAIR, PARAGRAPH, WHOLE = range(4)
MARK = r"^(?:[\x20\t]*>)+"


def levels(lines: Column) -> Column:
    """array<struct<level, line>>: each line's quote level and its text without marks."""
    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, MARK, 0)
        return F.struct(F.char_length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                        F.regexp_replace(line, MARK + r"[\x20\t]?", "").alias("line"))
    return F.transform(lines, parse)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\x{A0}]+", " "))


def parsed(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Messages with their own text, the hashes of what they say and their quoted passages.

    A quoted passage has its level, its hash and ``asked``: (unit, grain, hash)
    of the whole, of its paragraphs, pairs of adjacent lines and lines, finer
    ones only where they differ from the coarser.  Joining the lines with a mark
    at each change of level and splitting there finds passages without a loop.
    """
    rows = turns.select(col(conv).alias("conv_id"), col(turn).cast("long").alias("turn"), col(role).alias("role"),
                        F.coalesce(col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("lines", levels(F.split(F.col("text"), r"\r\n|\r|\n")))
    own = F.filter(F.col("lines"), lambda x: x["level"] == 0)
    rows = rows.withColumn("clean", F.trim(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), F.lit(" \n\t")))
    index = F.sequence(F.lit(0), F.size("lines") - 1)
    # Position of the first line of each run, then the lines from there to the next run.
    rows = rows.withColumn("starts", F.filter(index, lambda i: (i == 0) | (
        F.get(F.col("lines"), i)["level"] != F.get(F.col("lines"), i - 1)["level"])))
    run_no = F.sequence(F.lit(0), F.size("starts") - 1)

    def passage(k: Column) -> Column:
        first = F.get(F.col("starts"), k)
        stop = F.coalesce(F.get(F.col("starts"), k + 1), F.size("lines"))
        part = F.slice(F.col("lines"), first + 1, stop - first)
        return F.struct(F.get(F.col("lines"), first)["level"].alias("level"),
                        F.array_join(F.transform(part, lambda x: normalised(x["line"])), "\n").alias("lines"))

    rows = rows.withColumn("runs", F.transform(run_no, passage))
    # Paragraphs are split at blank lines; a run without any is empty.
    rows = rows.withColumn("runs", F.filter(F.transform("runs", lambda p: F.struct(
        p["level"].alias("level"), F.filter(F.split(p["lines"], r"\n{2,}|^\n|\n$"), lambda x: x != "").alias("parts"))),
        lambda p: F.size(p["parts"]) > 0))
    quotes = F.transform(F.filter(F.col("runs"), lambda p: p["level"] > 0), lambda p: F.struct(
        p["level"].alias("level"), F.xxhash64(_flat(F.array_join(p["parts"], "\n"))).alias("hash"),
        _asked(p["parts"]).alias("asked")))
    said = F.flatten(F.transform(F.filter(F.col("runs"), lambda p: p["level"] == 0), lambda p: F.concat(
        F.array(_flat(F.array_join(p["parts"], "\n"))), F.flatten(F.transform(p["parts"], lambda x: F.concat(
            F.array(_flat(x)), _pairs(x), F.split(x, "\n")))))))
    said = F.array_append(said, normalised(F.col("clean")))
    own_hashes = F.array_distinct(F.transform(F.filter(said, lambda x: x != ""), lambda x: F.xxhash64(x)))
    return rows.select("conv_id", "turn", "role", "text", "clean", quotes.alias("quotes"), own_hashes.alias("said"))


def _flat(paragraph: Column) -> Column:
    return F.translate(paragraph, "\n", " ")


def _pairs(paragraph: Column) -> Column:
    """Every two adjacent lines of a paragraph, as one text."""
    lines = F.split(paragraph, "\n")
    return F.zip_with(F.slice(lines, F.lit(1), F.size(lines) - 1), F.slice(lines, F.lit(2), F.size(lines)),
                      lambda a, b: F.concat_ws(" ", a, b))


def _asked(parts: Column) -> Column:
    """array<struct<unit, grain, hash>> of a quoted passage: what it can be found by."""
    def as_keys(unit: Column, grain: int, texts: Column) -> Column:
        return F.transform(texts, lambda x: F.struct(unit.alias("unit"), F.lit(grain).alias("grain"),
                                                     F.xxhash64(x).alias("hash")))

    def of_paragraph(x: Column) -> Column:
        unit, lines = F.xxhash64(_flat(x)), F.split(x, "\n")
        none = F.slice(lines, F.lit(1), F.lit(0))
        return F.concat(as_keys(unit, PARAGRAPH, F.array(_flat(x))),
                        as_keys(unit, PAIR, F.when(F.size(lines) > 2, _pairs(x)).otherwise(none)),
                        as_keys(unit, LINE, F.when(F.size(lines) > 1, lines).otherwise(none)))

    whole = as_keys(F.lit(0).cast("long"), WHOLE, F.array(_flat(F.array_join(parts, "\n"))))
    return F.array_distinct(F.concat(whole, F.flatten(F.transform(parts, of_paragraph))))


def links(messages: DataFrame, turns_per_range: int = TURNS_PER_RANGE) -> DataFrame:
    """(conv_id, turn, parent_turn, n_links): the message that each quoting message answers.

    An as-of join: for every quoted hash the latest earlier turn that said it.
    Turns are dealt into ranges; inside one, a running maximum; before it, the
    maximum over the earlier ranges of the same (conversation, hash), one row
    per range.  So a line that everybody says is never gathered.
    """
    base = messages.where("conv_id is not null and turn is not null")
    said = base.select("conv_id", "turn", F.explode("said").alias("hash")).distinct().withColumn("said", F.lit(True))
    asked = (base.select("conv_id", "turn", F.explode("quotes").alias("q"))
             .select("conv_id", "turn", F.col("q.level").alias("level"), F.col("q.hash").alias("passage"),
                     F.explode("q.asked").alias("a"))
             .select("conv_id", "turn", "level", "passage", "a.unit", "a.grain", "a.hash")
             .distinct().withColumn("said", F.lit(False)))
    # Only what is quoted somewhere in the conversation matters.
    wanted = asked.select("conv_id", "hash").distinct()
    said = said.join(wanted, ["conv_id", "hash"], "left_semi")
    events = said.unionByName(asked, allowMissingColumns=True).withColumn("part", F.floor(F.col("turn") / turns_per_range).cast("long"))
    events = materialize(events, "quote-events")
    said_turn = F.when(F.col("said"), F.col("turn"))
    per_part = events.groupBy("conv_id", "hash", "part").agg(F.max(said_turn).alias("latest"))
    before = Window.partitionBy("conv_id", "hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_part.withColumn("carried", F.max("latest").over(before)).drop("latest")
    inside = Window.partitionBy("conv_id", "hash", "part").orderBy("turn").rangeBetween(
        Window.unboundedPreceding, -1)
    asof = (events.withColumn("near", F.max(said_turn).over(inside)).where("not said")
            .join(carried, ["conv_id", "hash", "part"])
            .withColumn("parent_turn", F.coalesce("near", "carried")).where("parent_turn is not null"))
    # One answer for each unit (a passage or one of its paragraphs), by the coarsest that is known.
    message, passage = ["conv_id", "turn"], ["level", "passage"]
    found = asof.groupBy(*message, *passage, "unit", "grain", "parent_turn").agg(F.count("*").alias("n"))
    units = found.groupBy(*message, *passage, "unit").agg(F.max(F.struct("grain", "n", "parent_turn")).alias("a"))
    # A passage known as a whole leaves its paragraphs out.
    whole = F.max(F.when(F.col("a.grain") == WHOLE, F.col("a.parent_turn")))
    answers = units.groupBy(*message, *passage).agg(whole.alias("whole"), F.collect_list("a.parent_turn").alias("parts"))
    answers = answers.select(*message, "level", F.explode(F.when(F.col("whole").isNotNull(), F.array("whole")).otherwise(
        F.col("parts"))).alias("parent_turn"))
    counted = answers.groupBy(*message, "level", "parent_turn").agg(F.count("*").alias("n_links"))
    best = counted.groupBy(*message).agg(
        F.max(F.struct((-F.col("level")).alias("level"), "n_links", "parent_turn")).alias("best"))
    return best.select("conv_id", "turn", "best.parent_turn", "best.n_links")


def roots(link: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of every linked message, by pointer jumping.

    Each round doubles the distance covered; links lead to earlier turns only,
    so they end.  Rounds are written tables.
    """
    current = materialize(link.select("conv_id", "turn", F.col("parent_turn").alias("to"),
                                      F.lit(1).cast("long").alias("depth")), "reply-links")
    while True:
        ahead = current.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("further"),
                               F.col("depth").alias("more"))
        jumped = current.join(ahead, ["conv_id", "to"], "left").select(
            "conv_id", "turn", F.coalesce("further", "to").alias("to"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved"))
        current = materialize(jumped, "reply-jumps")
        if not current.where("moved").limit(1).count():
            return current.select("conv_id", "turn", F.col("to").alias("root"), "depth")
        current = current.drop("moved")


def threads(turns: DataFrame, **columns) -> DataFrame:
    """One row per message in reply order.

    conv_id, thread (turn of the thread's first message), turn, role,
    parent_turn, reply_depth, n_quotes, n_links, text (quotes removed).
    """
    messages = materialize(parsed(turns, **columns), "messages")
    link = materialize(links(messages), "links")
    known = link.join(roots(link), ["conv_id", "turn"])
    out = messages.join(known, ["conv_id", "turn"], "left")
    return (out.select("conv_id", F.coalesce("root", "turn").alias("thread"), "turn", "role", "parent_turn",
                       F.coalesce("depth", F.lit(0)).alias("reply_depth"), F.size("quotes").alias("n_quotes"),
                       F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("clean").alias("text"))
            .orderBy("conv_id", "thread", "turn"))
