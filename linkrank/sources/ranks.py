"""Saved ranks, read back in any of the layouts the sinks write."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.sinks.layouts import CSV, TEXT, URL, check_layout

# What no saved page can be: one character that the writers never give alone.
NO_VALUE = "\x00"
# The rank follows the last comma, as page names may hold commas themselves.
_CSV_LINE = r"(?s)^(.*),([^,]*)$"
_TUPLE_LINE = r"(?s)^\((['\"])(.*)\1, ([^,]*)\)$"


def _unescaped(text):
    """Undo the backslashes of a printed tuple: drop each, keep what it guards."""
    return F.regexp_replace(text, r"\\(.)", "$1")


def _among(domains: Collection[str | None]) -> Column:
    """A condition on the directories alone, so that it prunes them."""
    named = sorted({d for d in domains if d})
    without = F.col("domain").isNull() if any(not d for d in domains) else F.lit(False)
    return F.col("domain").isin(named) | without


def read_ranks(
    spark: SparkSession, path: str, layout: str = CSV, domains: Collection[str | None] | None = None
) -> DataFrame:
    """``page, pagerank`` (for the URL layout also ``domain, protocol``).

    ``domains`` keeps the pages of these domains alone. Only the URL layout
    knows domains; there the other directories are neither opened nor read.
    ``None`` among them (and ``''``, which directories do not tell from it)
    stands for pages without a domain; an empty collection keeps no page.
    """
    check_layout(layout)
    if domains is not None and layout != URL:
        raise ValueError(f"domains are known to the layout {URL!r} only")
    if layout == URL:
        # A full schema keeps domains such as 2024 strings. A page is never read
        # as NULL because it is empty: "" and nothing stay apart.
        schema = "page STRING, pagerank DOUBLE, domain STRING, protocol STRING"
        saved = spark.read.csv(path, schema=schema, nullValue=NO_VALUE)
        return saved if domains is None else saved.where(_among(domains))
    if layout == TEXT:
        lines, pattern, page, rank = spark.read.text(path), _TUPLE_LINE, 2, 3
    else:
        lines, pattern, page, rank = spark.read.csv(path, schema="value STRING"), _CSV_LINE, 1, 2
    name = F.regexp_extract("value", pattern, page)
    return lines.select(
        (_unescaped(name) if layout == TEXT else name).alias("page"),
        F.regexp_extract("value", pattern, rank).cast("double").alias("pagerank"),
    )
