"""Adding domain and protocol to ranked pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions.urls import url_domain, url_protocol


def annotate_ranks(ranks: DataFrame, strip_brackets: bool = False) -> DataFrame:
    """``page, pagerank, domain, protocol`` from the result of ``pagerank()``.

    Both parts depend on the page alone and are known for pages that have
    links, so no join is needed; other pages get NULL.
    """
    page, has_links = F.col("page").cast("string"), F.col("out_degree") > 0
    return ranks.select(
        "page",
        "pagerank",
        F.when(has_links, url_domain(page, strip_brackets)).alias("domain"),
        F.when(has_links, url_protocol(page, strip_brackets)).alias("protocol"),
    )


def join_url_parts(ranks: DataFrame, edges: DataFrame, strip_brackets: bool = False) -> DataFrame:
    """The same for any rank table, by a left join with the sources in ``edges``.

    The sources are made distinct first, so that no rank is repeated for each
    outgoing link.
    """
    source = F.col("source").cast("string")
    parts = (
        edges.select("source")
        .distinct()
        .select(
            F.col("source").alias("page"),
            url_domain(source, strip_brackets).alias("domain"),
            url_protocol(source, strip_brackets).alias("protocol"),
        )
    )
    return ranks.join(parts, "page", "left").select("page", "pagerank", "domain", "protocol")
