"""Messy inputs for every operator of the training-data part."""

from pyspark.sql import types as T

# Names that the operators use for their own columns, given to extra input columns.
CLASHING = ["size", "fp", "score", "n", "part", "key", "label", "component_id", "src", "a", "b", "taken", "sketch"]

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASHING]])

LONG = "lorem ipsum dolor sit amet consetetur " * 20000


def doc(i, text, source="s1", n_chars=None):
    return (i, text, "en", source, len(text) if text is not None and n_chars is None else n_chars,
            *["x"] * len(CLASHING))


MESSY = [
    doc(1, "one two three four five six seven"), doc(2, None), doc(3, ""), doc(4, " \t\n "),
    doc(5, "one two three four five six seven"), doc(5, "one two three four five six seven"),
    doc(6, "mail a.b@example.com or +1 (555) 555-1234 now", None), doc(None, "no id here at all my friend", "s2"),
    doc(None, None, None), doc(7, LONG, "s2"), doc(8, "word", "é"), doc(9, "naïve ☃ 𝄞 text with marks", "s1"),
    doc(10, "one\x00two", "s1"), doc(11, "You IDIOT! 1d10t you stupid moron", "s3"), doc(-3, "negative id", "s3"),
]


def messy(spark):
    return spark.createDataFrame(MESSY, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def labels(spark, rows=((1, 1, 0), (6, 1, 0), (11, 0, 1), (9, None, None), (None, 1, 1), (8, 0, 0), (8, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def same_rows(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))
