"""A sweep over intervals: what is open on each stretch of a key's timeline.

The bounds of a key's intervals cut its timeline into segments.  Going through
the bounds in order, intervals that begin are put on a heap by rank and those
that have ended are taken off when they surface, so the work is n log n in the
key's intervals however deep they overlap; no segment meets all intervals that
cover it.

Rows are dealt by key and sorted once; a key's intervals are held together, so
callers make them distinct first: by (product, year) they are bounded by the
calendar.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def segments(rows: Sequence[tuple[int, int, int, tuple[int, ...]]], channels: int
             ) -> Iterator[tuple[int, int, int, list[int | None]]]:
    """(first day, last day, intervals open, best row of each channel) of every covered segment.

    ``rows`` are (first day, last day, channel, rank); the best row of a channel
    is the open one of largest rank (then the first given).
    """
    begins = sorted(range(len(rows)), key=lambda i: rows[i][0])
    ends = sorted(r[1] + 1 for r in rows)
    cuts = sorted({r[0] for r in rows} | set(ends))
    heaps: list[list] = [[] for _ in range(channels)]
    begun = ended = 0
    for cut, after in zip(cuts, cuts[1:], strict=False):
        while begun < len(begins) and rows[begins[begun]][0] == cut:
            i = begins[begun]
            heappush(heaps[rows[i][2]], (tuple(-x for x in rows[i][3]), i))
            begun += 1
        while ended < len(ends) and ends[ended] <= cut:
            ended += 1
        for heap in heaps:
            while heap and rows[heap[0][1]][1] < cut:
                heappop(heap)
        if begun > ended:
            yield cut, after - 1, begun - ended, [heap[0][1] if heap else None for heap in heaps]


def _run(keys: list[str], payload: list[str], ranks: int, channels: int, schema: pa.Schema
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple, tuple]]:
        for batch in batches:
            c = batch.to_pydict()
            yield from zip(zip(*[c[f"__key{i}"] for i in range(len(keys))], strict=True),
                           zip(c["__from"], c["__until"], c["__channel"],
                               zip(*[c[f"__rank{i}"] for i in range(ranks)], strict=True), strict=True),
                           zip(*[c[p] for p in payload], strict=True), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, group in groupby(rows_of(batches), key=lambda r: r[0]):
            own = list(group)
            for first, last, n, best in segments([r[1] for r in own], channels):
                found = [x for i in best for x in (own[i][2] if i is not None else [None] * len(payload))]
                out.append((*key, first, last, n, *found))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
    return run


def swept(df: DataFrame, keys: dict[str, Column], start: str, end: str, rank: Sequence[Column],
          payload: Sequence[str], channel: Column | None = None, channels: int = 1) -> DataFrame:
    """One row per covered segment: keys, seg_from, seg_until, n_open, ``<payload>_<channel>``.

    Rows with a null key or bound, or an end before the start, cover nothing.
    ``rank`` columns are whole numbers.
    """
    rows = df.where(F.col(start) <= F.col(end)).select(
        *[c.alias(f"__key{i}") for i, c in enumerate(keys.values())],
        F.unix_date(start).alias("__from"), F.unix_date(end).alias("__until"),
        (F.lit(0) if channel is None else channel).cast("int").alias("__channel"),
        *[c.cast("long").alias(f"__rank{i}") for i, c in enumerate(rank)], *payload)
    named = [f"__key{i}" for i in range(len(keys))]
    for k in named:
        rows = rows.where(F.col(k).isNotNull())
    types = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([*[T.StructField(k, types[k]) for k in named], T.StructField("__from", T.IntegerType()),
                           T.StructField("__until", T.IntegerType()), T.StructField("n_open", T.IntegerType()),
                           *[T.StructField(f"{p}_{c}", types[p]) for c in range(channels) for p in payload]])
    ordered = rows.repartition(*named).sortWithinPartitions(*named, "__from")
    found = ordered.mapInArrow(_run(list(keys), list(payload), len(rank), channels, to_arrow_schema(schema)), schema)
    return found.select(*[F.col(f"__key{i}").alias(k) for i, k in enumerate(keys)],
                        F.date_from_unix_date("__from").alias("seg_from"),
                        F.date_from_unix_date("__until").alias("seg_until"), "n_open",
                        *[f"{p}_{c}" for c in range(channels) for p in payload])
