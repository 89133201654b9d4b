"""Report sink: the published CSV layout.

``;`` separated, dates ``dd.MM.yyyy``, decimal comma with two decimals, and
on the first day's row the last day's value and the percentage decline:

    createdat;sum_revenue;;
    01.10.2020;7682,82;1255,77;84%
    02.10.2020;7139,76;;
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.reports import first_last_change

HEADER = "createdat;sum_revenue;;"


def decimal_comma(value: Column, digits: int = 2) -> Column:
    """Half-up rounded text with a decimal comma and no grouping."""
    fixed = F.round(value.cast("decimal(38,10)"), digits).cast(f"decimal(38,{digits})")
    return F.regexp_replace(fixed.cast("string"), r"\.", ",")


def report_lines(series: DataFrame, day_col: str = "createdat",
                 value_col: str = "sum_revenue") -> DataFrame:
    """(order, line) rows of the report; the series is already one row per day."""
    summary = first_last_change(series, day_col, value_col)
    decline = F.round((F.col("first_value") - F.col("last_value")) * 100
                      / F.nullif(F.col("first_value"), F.lit(0)), 0).cast("int")
    one = summary.select("first_day", "last_value", decline.alias("decline_pct"))
    first = F.col(day_col) == F.col("first_day")
    blank = F.lit("")
    line = F.concat_ws(
        ";", F.date_format(day_col, "dd.MM.yyyy"),
        F.coalesce(decimal_comma(F.col(value_col)), blank),
        F.when(first, F.coalesce(decimal_comma(F.col("last_value")), blank)).otherwise(blank),
        F.when(first, F.coalesce(F.concat(F.col("decline_pct").cast("string"), F.lit("%")), blank))
         .otherwise(blank))
    rows = series.crossJoin(F.broadcast(one)).select(F.col(day_col).alias("__day"), line.alias("line"))
    header = series.sparkSession.createDataFrame([(None, HEADER)], "__day date, line string")
    return header.unionByName(rows)


def write_report_csv(series: DataFrame, path: str, day_col: str = "createdat",
                     value_col: str = "sum_revenue") -> None:
    """Write the report as ordered text parts, header first, days in order.

    The global sort range-partitions the lines, so part files in name order
    concatenate to the report (``hadoop fs -getmerge``) and no single task
    has to write it all.
    """
    lines = report_lines(series, day_col, value_col)
    (lines.orderBy(F.col("__day").asc_nulls_first()).select("line")
          .write.mode("overwrite").text(path))


def csv_lines(df: DataFrame, order: list[str]) -> DataFrame:
    """Any table as lines in the published conventions: ``;`` separated,
    dates ``dd.MM.yyyy``, decimals and doubles with a decimal comma and two
    decimals, integers and text as they are, nulls empty.  Returns
    (__order..., line) rows plus the header with null order keys."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            cell = F.date_format(c, "dd.MM.yyyy")
        elif isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            cell = decimal_comma(c)
        else:
            cell = c.cast("string")
        cells.append(F.coalesce(cell, F.lit("")))
    rows = df.select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate(order)],
                     F.concat_ws(";", *cells).alias("line"))
    header = df.sparkSession.createDataFrame(
        [tuple([None] * len(order)) + (";".join(df.columns),)],
        T.StructType([T.StructField(f"__o{i}", df.schema[k].dataType, True)
                      for i, k in enumerate(order)] + [T.StructField("line", T.StringType())]))
    return header.unionByName(rows)


def write_table_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """Write a report table as ordered CSV text parts, header first.

    Part files in name order concatenate to the report; the sort is range
    partitioned, so the write is spread over tasks.
    """
    lines = csv_lines(df, order)
    keys = [F.col(f"__o{i}").asc_nulls_first() for i in range(len(order))]
    lines.orderBy(*keys).select("line").write.mode("overwrite").text(path)
