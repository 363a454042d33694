"""Writers for ranked pages: compressed CSV, URL directories, sorted text.

``mode`` is Spark's save mode: ``error`` refuses an existing path,
``overwrite`` empties it first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions.lines import csv_rank_line, tuple_rank_line
from linkrank.operators.topk import sorted_ranks
from linkrank.operators.urls import annotate_ranks
from linkrank.session import smaller_tasks
from linkrank.sinks.layouts import CSV, TEXT, check_layout, default_mode

# Files of a directory without adaptive execution, at most.
SPLIT_FILES = 64
# With it, shuffled bytes of a task that writes directories, at most: half a million to a million rows.
SPLIT_BYTES = 6 << 20


def write_ranks_csv(ranks: DataFrame, path: str, mode: str = "error") -> None:
    """One quoted ``page,rank`` column per line, bzip2. NULL pages give no line."""
    line = csv_rank_line(F.col("page"), F.col("pagerank"))
    ranks.select(line.alias("value")).write.mode(mode).csv(path, compression="bzip2")


def write_ranks_by_url(annotated: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``page, pagerank`` as CSV below ``domain=.../protocol=...``.

    The rows are brought together by directory first, so that a directory gets
    few files instead of one from every task. ``rebalance`` does this by size:
    a domain that holds most of the pages is split into many files, of
    ``SPLIT_BYTES`` in the shuffle, and small domains share a task. Ranked pages
    are compressed to a few bytes each there, so the session's size for a task would
    give one of them many millions. Without adaptive execution a hash of the page is part
    of the key, so that a large domain is split then as well.
    """
    rows = annotated.select("page", "pagerank", "domain", "protocol")
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        dealt = rows.hint("rebalance", "domain", "protocol")
    else:
        part = F.pmod(F.xxhash64("page"), F.lit(SPLIT_FILES))
        dealt = rows.repartition("domain", "protocol", part)
    writer = dealt.write.partitionBy("domain", "protocol").mode(mode)
    with smaller_tasks(rows.sparkSession, SPLIT_BYTES):
        writer.csv(path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_ranks_text(ranks: DataFrame, path: str, mode: str = "error") -> None:
    """``('page', rank)`` lines, highest rank first across the part files."""
    line = tuple_rank_line(F.col("page"), F.col("pagerank"))
    sorted_ranks(ranks).select(line.alias("value")).write.mode(mode).text(path)


def write_ranks(
    ranks: DataFrame,
    path: str,
    layout: str = CSV,
    mode: str | None = None,
    strip_brackets: bool = False,
) -> None:
    """Write the result of ``pagerank()`` in one of the three layouts."""
    check_layout(layout)
    mode = mode or default_mode(layout)
    if layout == CSV:
        write_ranks_csv(ranks, path, mode)
    elif layout == TEXT:
        write_ranks_text(ranks, path, mode)
    else:
        write_ranks_by_url(annotate_ranks(ranks, strip_brackets), path, mode)
