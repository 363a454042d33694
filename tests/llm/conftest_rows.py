"""Rows with every odd case."""

from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Extra columns with names that operators use inside.
        T.StructField("size", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)
PASSAGE = " ".join(f"word{i}" for i in range(40))
LONG = " ".join(f"w{i % 997}x{i}" for i in range(120_000))


def odd_rows():
    """(doc_id, text, lang, source)"""
    return [
        (1, PASSAGE, "en", "a"),
        (2, PASSAGE, "en", "a"),
        (2, PASSAGE, "en", "a"),  # a repeated row
        (3, "start " + PASSAGE + " end", "de", "b"),
        (4, None, "en", "b"),
        (5, "", "en", None),
        (6, " \n\t ", None, None),
        (7, "one two", None, "a"),
        (8, "One TWO", "en", "a"),
        (9, LONG, "en", "c"),
        (10, LONG + " tail", "en", "c"),
        (None, "a row without an id " + PASSAGE, "en", "a"),
        (None, None, None, None),
        (11, "tick " * 60, "en", "b"),
        (12, "ÄÖ 日本語 <|endoftext|> it's", "de", "b"),
    ]
