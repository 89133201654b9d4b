"""Records of CSV files whose quoted cells hold line breaks, read in parallel.

A file is read line by line from all its blocks at once.  Whether a line starts
inside a quoted cell depends on all lines before it, but each line only maps
the state before it to the state after it, and such maps compose: a running
composition inside every block, then one over the blocks of each file (a row
per block), tells the state at every line.  Lines that start outside a quoted
cell start a record; the rest are joined to the record before, across blocks
too.  No file, however long, is read by one task.

Quotes follow the CSV reader: a cell is quoted if it starts with a quote, a
doubled quote inside it is a quote, and it ends at a quote before the delimiter
or the line's end.  A quote elsewhere is a character of its cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A line's place: its file, the block's offset in it, and its order among the lines of one scan.
PLACE = ["__file", "__block"]


def _maps(line: Column, sep: Column) -> tuple[Column, Column]:
    """Whether the line ends inside a quoted cell if it starts outside one, and if it starts inside."""
    quoted = F.lit('[^"]*+(?:""[^"]*+)*+')
    mark = F.concat(F.lit("\\Q"), sep, F.lit("\\E"))
    plain = F.concat(F.lit('(?!")(?:(?!'), mark, F.lit(").)*+"))
    cells = F.concat(F.lit('(?:(?:"'), quoted, F.lit('"|'), plain, F.lit(")"), mark, F.lit(")*+"))
    opened = F.concat(cells, F.lit('"'), quoted, F.lit("\\z"))
    return (F.rlike(line, F.concat(F.lit("(?s)\\A"), opened)),
            F.rlike(line, F.concat(F.lit("(?s)\\A"), quoted, F.lit('(?:\\z|"'), mark, opened, F.lit(")"))))


def _composed(before: Column | None, last_fixed: Column, swaps: Column) -> Column:
    """State after a run of maps: the last map that forgets the state, or the state before, swapped."""
    start = F.coalesce(last_fixed, F.lit(False) if before is None else before)
    return start != (swaps % 2 == 1)


def _running(df: DataFrame, order: Window, outside: str, inside: str) -> DataFrame:
    """Adds ``__fixed`` and ``__swaps``: the composition of all maps up to each row of its window."""
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed, swap = F.col(outside) == F.col(inside), F.col(outside) & ~F.col(inside)
    df = df.withColumn("__all_swaps", F.sum(swap.cast("int")).over(up_to))
    at_fixed = F.last(F.when(fixed, F.col("__all_swaps")), ignorenulls=True).over(up_to)
    return (df.withColumn("__fixed", F.last(F.when(fixed, F.col(outside)), ignorenulls=True).over(up_to))
            .withColumn("__swaps", F.col("__all_swaps") - F.coalesce(at_fixed, F.lit(0))).drop("__all_swaps"))


def records(lines: DataFrame) -> DataFrame:
    """(__file, __unit, __record, __closed) of every record but the header, in no order.

    ``lines``: __unit, __delimiter, value (without its line break) and PLACE plus
    ``__order``, as :func:`placed` gives them.  ``__closed`` is false on the
    records of a file that ends inside a quoted cell; the one left open comes
    without its text, which could be the rest of the file.
    """
    outside, inside = _maps(F.regexp_replace("value", "\r\\z", ""), F.col("__delimiter"))
    mapped = lines.withColumn("__out", outside).withColumn("__in", inside)
    in_block = Window.partitionBy(*PLACE).orderBy("__order")
    run = _running(mapped, in_block, "__out", "__in")
    blocks = run.groupBy(*PLACE).agg(
        F.max_by(F.struct("__fixed", "__swaps"), "__order").alias("m"),
        F.count("*").alias("__lines"))
    blocks = blocks.select(*PLACE, _composed(F.lit(False), F.col("m.__fixed"), F.col("m.__swaps")).alias("__out"),
                           _composed(F.lit(True), F.col("m.__fixed"), F.col("m.__swaps")).alias("__in"))
    in_file = Window.partitionBy("__file").orderBy("__block")
    over = _running(blocks, in_file, "__out", "__in")
    after = _composed(None, F.col("__fixed"), F.col("__swaps"))
    starts = over.select(
        *PLACE, F.coalesce(F.lag(after).over(in_file), F.lit(False)).alias("__start"),
        F.last(after).over(Window.partitionBy("__file").orderBy("__block").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("__ends_open"))
    at = run.join(starts, PLACE)
    state = _composed(F.col("__start"), F.col("__fixed"), F.col("__swaps"))
    before = F.coalesce(F.lag(state).over(in_block), F.col("__start"))
    first = ~before
    numbered = at.withColumn("__first", first).withColumn("__number", F.sum(F.col("__first").cast("int")).over(in_block))
    # Lines before a block's first record belong to the last record of the blocks before it.
    ends = numbered.groupBy(*PLACE).agg(F.max("__number").alias("n"))
    own = F.when(F.col("n") > 0, F.struct(F.col("__block").alias("b"), F.col("n")))
    earlier = F.last(own, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    last_own = F.last(own, ignorenulls=True).over(Window.partitionBy("__file").orderBy("__block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select(*PLACE, earlier.alias("__earlier"), last_own.alias("__last"))
    placed_lines = numbered.join(ends, PLACE).withColumn("__record_at", F.when(
        F.col("__number") > 0, F.struct(F.col("__block").alias("b"), F.col("__number").cast("long").alias("n")))
        .otherwise(F.col("__earlier")))
    left_open = F.col("__ends_open") & (F.col("__record_at") == F.col("__last"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~left_open, F.struct("__block", "__order", "value")))),
                                    lambda x: x.value), "\n")
    out = placed_lines.groupBy("__file", "__unit", "__delimiter", "__record_at").agg(
        text.alias("__record"), (~F.max("__ends_open")).alias("__closed"))
    header = (F.col("__record_at.b") == 0) & (F.col("__record_at.n") == 1)
    return out.where(~header).select("__file", "__unit", "__delimiter",
                                     F.regexp_replace("__record", "\r\\z", "").alias("__record"), "__closed")


def placed(raw: DataFrame) -> DataFrame:
    """Lines of a text scan with their place: file, block offset, order within the scan."""
    return raw.select(F.col("_metadata.file_path").alias("__file"),
                      F.col("_metadata.file_block_start").alias("__block"),
                      F.monotonically_increasing_id().alias("__order"), "value")
