"""WARC archives and their index, merged from locally sorted capture runs.

Writing: every page becomes one record in a Spark-written, compressed text
file whose lines *are* the records (a record may hold any bytes; the line
separator is the record's last byte).  Of pages with equal payloads the one
with the largest id is the response, the others revisit it and carry no
payload, only the HTTP header with the full length.

Reading: records begin with ``WARC/1.1`` and the archive's own token, a fresh
random name in their first header field; splitting at that line gives one row
per record without holding a file in memory, and the block must have the length
its header states and the digest it names, or reading fails.

Index: the entries of each reading task, sorted by URL key and timestamp, are
written as one capture run.  The key space is dealt into ranges of bounded size
over (URL key, timestamp, id) - a URL with a third of all captures spans several -
and each range merges its slices of all runs with a loser tree.  Ranges in order,
rows in order inside them: a global order of captures, every URL's history
together.

A null payload is empty, a null URL has the empty key; of pages equal in
payload and id all are responses; a null id is smaller than any.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import col, lookup, materialize, pieces

MIN_REVISIT_BYTES = 0
ROWS_PER_MERGE = 20_000
# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
END = CRLF + CRLF
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
TOKEN_FIELD = "X-Archive-Token"
EPOCH = 1_577_836_800  # captures without a time: 2020-01-01 plus the id in seconds

INDEX_SCHEMA = ("merge_part int, merge_pos long, urlkey string, captured_at string, page_id long, "
                "record_type string, payload_bytes long, payload_digest string, refers_to long, run int")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""
    def spelled(digits: Column) -> Column:
        out = []
        for k in range(0, 40, 5):
            chunk = F.conv(F.substring(digits, k + 1, 5), 16, 10).cast("int")
            out += [F.substring(F.lit(BASE32), F.shiftright(chunk, s).bitwiseAND(31) + 1, F.lit(1))
                    for s in (15, 10, 5, 0)]
        return F.concat(*out)
    # Bound by a lambda, so the digest is computed once and not per letter.
    return F.get(F.transform(F.array(F.sha1(payload)), spelled), 0)


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, then path and query in lower case."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    rest = F.regexp_replace(F.regexp_replace(rest, r"(?s)#.*$", ""), r"^www\.", "")
    host = F.regexp_extract(rest, r"^[^/?]*", 0)
    path = F.substring(rest, F.char_length(host) + 1, F.char_length(rest))
    return F.when(rest == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path))


def _header_value(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _headers(pairs: list[tuple[str, Column]]) -> Column:
    """``Name: value`` lines; null values are left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(k + ": "), v, F.lit(CRLF)), F.lit("")) for k, v in pairs])


def _record_id(token: str, page_id: Column) -> Column:
    return F.concat(F.lit(f"<urn:capture:{token}:"), page_id.cast("string"), F.lit(">"))


def captures(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url",
             payload_col: str = "html", time_col: str | None = None) -> DataFrame:
    """Pages with payload digest and, for revisits, the id that they refer to.

    The page of the largest id per digest comes from a pre-aggregated table;
    payloads shared by very many pages are looked up by broadcast, all others
    by a shuffled join (see :func:`common.lookup`).
    """
    when = F.col(time_col) if time_col else None
    rows = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).alias("url"),
                        F.coalesce(col(payload_col), F.lit("")).alias("payload"),
                        *([when.alias("time")] if time_col else []))
    if not time_col:
        rows = rows.withColumn("time", F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + EPOCH))
    rows = (rows.withColumn("payload_digest", base32_sha1(F.col("payload").cast("binary")))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")))
    last = materialize(rows.groupBy("payload_digest").agg(
        F.max("page_id").alias("last_id"), F.count("*").alias("n")), "payloads")
    found = lookup(rows, last, ["payload_digest"], "n", F.col("page_id"))
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return found.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"),
                              "refers_to": F.when(revisit, F.col("last_id"))}).drop("last_id")


def records(caps: DataFrame, token: str) -> DataFrame:
    """One text column ``value``: a WARC record without its last byte (the line separator)."""
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
                          + "Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    is_revisit = F.col("record_type") == "revisit"
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = _headers([
        (TOKEN_FIELD, F.lit(token)),
        ("WARC-Type", F.col("record_type")),
        ("WARC-Record-ID", F.coalesce(_record_id(token, F.col("page_id")), F.lit(f"<urn:capture:{token}:->"))),
        ("WARC-Date", F.date_format(F.col("time"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Target-URI", _header_value(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(is_revisit, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", F.when(is_revisit, _record_id(token, F.col("refers_to")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string"))])
    return caps.select(F.concat(F.lit(VERSION + CRLF), head, F.lit(CRLF), block, F.lit(CRLF + "\r")).alias("value"))


def write_archives(caps: DataFrame, path: str, compression: str = "gzip") -> str:
    """Write the records under ``path``; the token that separates them on reading."""
    token = uuid.uuid4().hex
    records(caps, token).write.option("lineSep", "\n").option("compression", compression).text(path)
    return token


def read_archives(spark: SparkSession, path: str, token: str) -> DataFrame:
    """One row per record: its fields, the payload as binary (null for revisits).

    Raises on a record whose block has another length or digest than stated.
    """
    start = VERSION + CRLF + TOKEN_FIELD + ": " + token + CRLF
    raw = spark.read.option("lineSep", start).text(path).where("value <> ''")
    parts = raw.select(F.substring_index("value", END, 1).alias("head"), "value")
    body = F.substring(F.col("value"), F.char_length("head") + 5, F.char_length("value") - F.char_length("head") - 8)

    def header(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"(?:^|\n){name}: ([^\r\n]*)", 1), F.lit(""))

    fields = parts.select(
        header("WARC-Type").alias("record_type"), header("WARC-Date").alias("captured_at"),
        header("WARC-Target-URI").alias("url"),
        F.expr("try_cast(regexp_extract(head, 'WARC-Record-ID: <urn:capture:[^:]*:([0-9-]+)>', 1) AS bigint)")
        .alias("page_id"),
        F.expr("try_cast(regexp_extract(head, 'WARC-Refers-To: <urn:capture:[^:]*:([0-9-]+)>', 1) AS bigint)")
        .alias("refers_to"),
        F.regexp_extract("head", r"WARC-Payload-Digest: sha1:([A-Z2-7]+)", 1).alias("payload_digest"),
        header("Content-Length").cast("long").alias("block_bytes"), body.alias("block"))
    http = F.substring_index("block", END, 1)
    stated = F.regexp_extract(http, r"Content-Length: ([0-9]+)", 1).cast("long")
    payload = F.when(F.col("record_type") == "response", F.substring(
        F.col("block"), F.char_length(http) + 5, F.char_length("block")).cast("binary"))
    out = fields.withColumn("payload_bytes", stated).withColumn("payload", payload)
    sound = (F.octet_length("block") == F.col("block_bytes")) & (
        F.col("payload").isNull() | ((F.octet_length("payload") == F.col("payload_bytes"))
                                     & (base32_sha1(F.col("payload")) == F.col("payload_digest"))))
    checked = F.when(sound, F.col("record_type")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record "), F.coalesce(F.col("page_id").cast("string"), F.lit("?")))))
    return out.withColumn("record_type", checked).drop("block", "block_bytes")


def capture_runs(recs: DataFrame) -> DataFrame:
    """Index entries as locally sorted runs, one per task, written."""
    entries = recs.select(
        url_key(F.col("url")).alias("urlkey"), F.coalesce("captured_at", F.lit("")).alias("captured_at"), "page_id",
        "record_type", "payload_bytes", "payload_digest", "refers_to", F.spark_partition_id().alias("run"))
    return materialize(entries.sortWithinPartitions("urlkey", "captured_at", "page_id"), "capture-runs")


class LoserTree:
    """Tournament of k sorted sources; ``pop`` gives the least item in log k comparisons."""

    _DONE = (1,)

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources, self.k = sources, len(sources)
        # A finished source compares above every item: (1,) > (0, ...).
        self.items = [self._next(i) for i in range(self.k)]
        self.losers = [0] * max(1, self.k)
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            if self.items[b] < self.items[a]:
                a, b = b, a
            winners[node], self.losers[node] = a, b
        self.losers[0] = winners[1] if self.k > 1 else 0

    def _next(self, i: int) -> tuple:
        item = next(self.sources[i], None)
        return self._DONE if item is None else (0, item)

    def pop(self) -> tuple | None:
        winner = self.losers[0]
        if not self.k or self.items[winner] is self._DONE:
            return None
        out = self.items[winner][1]
        self.items[winner] = self._next(winner)
        node = (winner + self.k) // 2
        while node:
            if self.items[self.losers[node]] < self.items[winner]:
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner
        return out


def loser_tree_merge(runs: list[Iterable[tuple]]) -> Iterator[tuple]:
    tree = LoserTree([iter(r) for r in runs])
    while (item := tree.pop()) is not None:
        yield item


def merge_runs(runs: DataFrame, rows_per_merge: int = ROWS_PER_MERGE, batch: int = 5000) -> DataFrame:
    """The globally ordered index: ``merge_part`` and ``merge_pos`` in order.

    Ranges hold about ``rows_per_merge`` entries whatever the number of runs;
    a task keeps one range.
    """
    order = ["urlkey", "captured_at", "page_id"]
    n = pieces(runs.count(), rows_per_merge)
    fields = ["urlkey", "captured_at", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[int, list] = {}
        part = None
        for pdf in batches:
            for row in zip(*[pdf[f].tolist() for f in ("part", "run", *fields, "no_id")]):
                part = row[0]
                values, no_id = row[2:-1], row[-1]
                # Sort key first; a null id sorts before any.
                slices.setdefault(row[1], []).append(
                    (values[0], values[1], not no_id, values[2], row[1], len(slices.get(row[1], ())), values))
        pos, out = 0, []
        for item in loser_tree_merge(list(slices.values())):
            values = list(item[-1])
            for k in (2, 6):
                values[k] = None if values[k] == _NO_ID else values[k]
            out.append((part, pos, *values, item[4]))
            pos += 1
            if len(out) == batch:
                yield _frame(out)
                out = []
        if out:
            yield _frame(out)

    filled = runs.withColumn("no_id", F.col("page_id").isNull()).withColumn(
        "page_id", F.coalesce("page_id", F.lit(_NO_ID))).withColumn("refers_to", F.coalesce("refers_to", F.lit(_NO_ID)))
    dealt = (filled.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
             .sortWithinPartitions("run", *order))
    return dealt.mapInPandas(merge, INDEX_SCHEMA)


_NO_ID = -(1 << 63)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    pdf = pd.DataFrame(rows, columns=names)
    for name in ("page_id", "refers_to"):
        pdf[name] = pdf[name].astype("Int64")
    return pdf


def archive_and_index(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, path: str | None = None,
                      **columns) -> DataFrame:
    """Write ``pages`` to archives, read them back and return the merged capture index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    token = write_archives(captures(pages, min_bytes, **columns), path)
    return merge_runs(capture_runs(read_archives(spark, path, token)))
