"""Link triples from text files, compressed or not.

Both readers take any path Spark can read; the codec follows from the file
name, and ``.bz2`` files are split between tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linkrank.functions.lines import SOURCE_TOKEN, TARGET_TOKEN, leading_tokens

TRIPLE_SCHEMA = StructType(
    [StructField(name, StringType(), True) for name in ("source", "predicate", "target")]
)


def read_triples_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``source, predicate, target``, one blank between fields, no header.

    Permissive: further tokens are dropped, missing ones are NULL, quoted
    literals are one field, and blank lines give no row.
    """
    return spark.read.csv(path, schema=TRIPLE_SCHEMA, sep=" ", header=False)


def _is_short(tokens: str | Column) -> Column:
    return F.size(tokens) <= TARGET_TOKEN


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def links_from_lines(lines: DataFrame, rejected: Observation | None = None) -> DataFrame:
    """``source, target`` from a table of text lines (column ``value``).

    Lines with fewer than three tokens hold no link and are left out. With an
    ``Observation`` the number of such lines is reported by the first action
    as ``rejected_lines``; it is a progress figure, which tasks that run
    again after a loss may count twice. ``rejected_lines()`` is exact.
    """
    split = lines.select(leading_tokens(F.col("value")).alias("tokens"))
    if rejected is not None:
        split = split.observe(rejected, F.count_if(_is_short("tokens")).alias("rejected_lines"))
    return split.where(~_is_short("tokens")).select(
        F.get("tokens", F.lit(SOURCE_TOKEN)).alias("source"),
        F.get("tokens", F.lit(TARGET_TOKEN)).alias("target"),
    )


def read_triples_text(
    spark: SparkSession, path: str | list[str], rejected: Observation | None = None
) -> DataFrame:
    """``source, target``: tokens 0 and 2 of whitespace-separated lines."""
    return links_from_lines(_lines(spark, path), rejected)


def rejected_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines ``read_triples_text`` leaves out, to be counted or looked at."""
    return _lines(spark, path).where(_is_short(leading_tokens(F.col("value"))))
