"""Small tables, and plain versions of the operators to hold them against."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use for columns of their own.
CLASHING = ["row", "h", "g", "score", "label", "hashes", "fingerprint", "start", "length", "part", "_gone", "_cut", "kept", "_words"]


def docs(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with further columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None if r[1] is None else len(r[1])) for r in rows]
    schema = T.StructType([*SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in CLASHING]])
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in full], schema)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ODD = [
    (1, "The quick brown fox jumps over the lazy dog. " * 30), (1, "The quick brown fox jumps over the lazy dog. " * 30), (2, None), (3, ""),
    (4, "   \n\t \n"), (5, "one"), (6, "Ünïcödé – ﬁ İ ß 日本語 😀 words, here."), (None, "A row that has no id at all, but text."), (None, None),
    (7, "x" * 50_000), (8, "word " * 30_000), (9, "a\nb\n\na\nA line of some length here\na line of some length HERE  "), (10, "1 2 3 | # <|endoftext|> $$$"),
]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
