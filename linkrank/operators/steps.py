"""One ranking step, in the parts it consists of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.operators.graph import LinkGraph, out_degree


def start_ranks(edges: DataFrame) -> DataFrame:
    """``page, out_degree, pagerank``: rank 1 for every page with a link."""
    return out_degree(edges).withColumn("pagerank", F.lit(1.0))


def damped(total: Column, damping: float) -> Column:
    """``(1 - d) + d * total``."""
    return F.lit(1 - damping) + F.lit(damping) * total


def page_shares(graph: LinkGraph, ranks: DataFrame | None, keep_unranked: bool) -> DataFrame:
    """``page, salts, contribution``: what each page passes along every one of its links.

    Has the layout of the graph's sources, and keeps it in a checkpoint.
    """
    share = F.col("pagerank") / F.col("degree")
    return graph.ranked_sources(ranks, keep_unranked).select("page", "salts", share.alias("contribution"))


def link_contributions(graph: LinkGraph, ranks: DataFrame | None, keep_unranked: bool) -> DataFrame:
    """``source, target, contribution``: what each link passes on.

    The division happens once per page, before the join with the links.
    """
    return graph.along_links(page_shares(graph, ranks, keep_unranked))


def neighbour_contributions(ranked: DataFrame) -> DataFrame:
    """``target, contribution`` from the adjacency table of ranked pages."""
    return ranked.select(
        F.explode("neighbours").alias("target"),
        (F.col("pagerank") / F.col("degree")).alias("contribution"),
    )


def sum_contributions(contributions: DataFrame) -> DataFrame:
    """``target, sum_contributions``; summed per task first, so hubs do no harm."""
    return contributions.groupBy("target").agg(F.sum("contribution").alias("sum_contributions"))


def ranks_from_shares(
    graph: LinkGraph, shares: DataFrame, damping: float, reached: DataFrame | None = None
) -> DataFrame:
    """``page, pagerank`` of every page that is the target of a link of a page in ``shares``, or is in ``reached``."""
    passed = graph.along_links(shares).select("target", "contribution")
    if reached is not None:
        passed = passed.unionByName(reached.select(F.col("page").alias("target"), F.lit(0.0).alias("contribution")))
    totals = sum_contributions(passed)
    return totals.select(
        F.col("target").alias("page"),
        damped(F.col("sum_contributions"), damping).alias("pagerank"),
    )


def rank_step(
    graph: LinkGraph, ranks: DataFrame | None, damping: float, keep_unranked: bool
) -> DataFrame:
    """``page, pagerank`` of every page that is the target of a counted link."""
    return ranks_from_shares(graph, page_shares(graph, ranks, keep_unranked), damping)


def complete_ranks(graph: LinkGraph, ranks: DataFrame, add_sources: bool) -> DataFrame:
    """``page, pagerank, out_degree`` of a rank table.

    With ``add_sources``, pages that have links but no rank are added with
    rank 0 (outer join, gaps filled with 0). A NULL page on one side never
    meets one on the other, so there can be two.
    """
    how = "full_outer" if add_sources else "right"
    joined = graph.with_page_layout(ranks.select("page", "pagerank"), how)
    return joined.select("page", "pagerank", F.col("degree").alias("out_degree")).na.fill(0, ["pagerank", "out_degree"])
