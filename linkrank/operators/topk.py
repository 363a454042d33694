"""Ordering ranked pages. Ties go by page, so results are stable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a line of the top-k report.
REPORT_LINE = "%d. %s has rank: %.6f"


def _by_rank() -> list[Column]:
    return [F.desc("pagerank"), F.asc("page")]


def sorted_ranks(ranks: DataFrame) -> DataFrame:
    """``page, pagerank``, highest rank first (range-partitioned sort).

    The page is a sort key too, so a rank shared by very many pages is still
    split between tasks.
    """
    return ranks.select("page", "pagerank").orderBy(*_by_rank())


def top_k(ranks: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest ranks; each task sends at most ``k`` rows."""
    return sorted_ranks(ranks).limit(k)


def numbered(ranks: DataFrame, k: int) -> DataFrame:
    """``position, page, pagerank`` of the ``k`` highest ranks, from 1."""
    position = F.row_number().over(Window.orderBy(*_by_rank())).cast("bigint")
    return top_k(ranks, k).select(position.alias("position"), "page", "pagerank")


def report_lines(ranks: DataFrame, k: int) -> DataFrame:
    """``position, line``: ``1. page has rank: 0.123456`` for the top ``k``."""
    line = F.format_string(REPORT_LINE, "position", F.col("page").cast("string"), "pagerank")
    return numbered(ranks, k).select("position", line.alias("line"))
