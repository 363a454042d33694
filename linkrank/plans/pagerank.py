"""Fixed-iteration link ranking under two sets of rules.

``ROWS_ZERO``: the degree of a page is its number of input rows; the rank goes
to the distinct targets; pages nobody links to stay, with rank 0.

``DISTINCT_DROP``: the degree is the number of distinct targets; pages that
receive nothing in a step are gone from then on, and what only they linked to
goes one step later.

Both start every page that has links at rank 1 and compute
``(1 - d) + d * sum`` a fixed number of times. Pages without links pass
nothing on, and nothing is normalised.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.operators.graph import LIST_ROWS, DegreeRule, LinkGraph, prepare_graph
from linkrank.operators.numbering import PageNumbers
from linkrank.operators.progress import CountedSteps
from linkrank.operators.steps import complete_ranks, page_shares, ranks_from_shares
from linkrank.session import (
    checkpoint_in_place,
    discard_checkpoint,
    ensure_checkpoint_dir,
    shuffle_width,
    small_batches,
)


class RankSemantics(Enum):
    ROWS_ZERO = "rows-zero"
    DISTINCT_DROP = "distinct-drop"

    @property
    def degree_rule(self) -> DegreeRule:
        return DegreeRule.ROWS if self is RankSemantics.ROWS_ZERO else DegreeRule.DISTINCT

    @property
    def keeps_unreached(self) -> bool:
        return self is RankSemantics.ROWS_ZERO


def pagerank(
    edges: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    semantics: RankSemantics = RankSemantics.ROWS_ZERO,
    num_partitions: int | None = None,
    checkpoint_every: int = 2,
    hot_links: int | None = None,
    on_step: Callable[[int, int], None] | None = None,
    numbered: bool = False,
    block_size: int | None = None,
    durable: bool = False,
) -> DataFrame:
    """Rank the pages in ``edges`` (columns ``source, target`` of one type).

    Returns ``page, pagerank, out_degree``, read from a reliable checkpoint:
    using the result several times ranks once. Every ``checkpoint_every`` steps
    what the pages pass on - a table of the pages with links, small next to the
    links - is written to ``spark.checkpoint.dir``, which bounds the plan, the
    shuffle files held, and the work repeated when executors are lost. It keeps
    the layout of the links, so the next step joins it as it lies. The files of
    a checkpoint are removed once the next one is there.

    Pages nobody links to pass something on in the first step alone: from then on
    they have rank 0 or are gone. So the pages of the first step are a checkpoint
    too, and later steps join only the links that leave these pages
    (``LinkGraph.leaving``). What lies in the rank table of the last step is that of the
    first under ``ROWS_ZERO``, whose targets always are all targets.

    ``on_step(step, pages)`` is called after each step with the number of pages in
    the rank table. If pages can drop out, each step is a checkpoint, and an
    ``Observation`` counts its rows in the job that writes it. If a task of it ran
    more than once, which the observation shows, a job of its own counts them.

    ``num_partitions`` is the number of partitions of the result, by default
    that of the session; steps have as many if there are links enough for them.
    It and ``hot_links`` are explained at ``prepare_graph``, as are
    ``block_size``, with which a step joins adjacency blocks in place of links,
    and ``durable``. ``numbered`` replaces pages by numbers for the steps. None
    of them changes ranks.
    """
    return pagerank_after(edges, (iterations,), damping, semantics, num_partitions, checkpoint_every, hot_links, on_step, numbered, block_size, durable)[0]


def pagerank_after(
    edges: DataFrame,
    steps: Collection[int],
    damping: float = 0.85,
    semantics: RankSemantics = RankSemantics.ROWS_ZERO,
    num_partitions: int | None = None,
    checkpoint_every: int = 2,
    hot_links: int | None = None,
    on_step: Callable[[int, int], None] | None = None,
    numbered: bool = False,
    block_size: int | None = None,
    durable: bool = False,
) -> list[DataFrame]:
    """The rank tables after each of several numbers of ``steps``, ascending, from one run.

    Each is what ``pagerank()`` returns for that number; the other options are its own.
    """
    steps = list(steps)
    if not steps or any(isinstance(n, bool) or not isinstance(n, int) or n < 0 for n in steps):
        raise ValueError("iterations must be a whole number, 0 or more")
    if not 0 <= damping <= 1:
        raise ValueError("damping must lie between 0 and 1")
    if checkpoint_every < 1:
        raise ValueError("checkpoint_every must be 1 or more")
    ensure_checkpoint_dir(edges.sparkSession)
    wanted = sorted(set(steps))
    iterations = wanted[-1]

    if numbered:
        numbers = PageNumbers(edges, num_partitions)
        links = numbers.links(edges).persist()
        plain = pagerank_after(links, wanted, damping, semantics, num_partitions, checkpoint_every, hot_links, on_step, False, block_size, durable)
        links.unpersist()
        results = []
        for ranks in plain:
            named = numbers.names(ranks).select("page", "pagerank", "out_degree")
            results.append((named.repartition(num_partitions, "page") if num_partitions else named).checkpoint())
            discard_checkpoint(ranks)
        numbers.release()
        return results
    spark = edges.sparkSession
    keeps = semantics.keeps_unreached
    graph = prepare_graph(edges, semantics.degree_rule, num_partitions, hot_links, block_size=block_size, durable=durable)
    with shuffle_width(spark, graph.width), small_batches(spark, LIST_ROWS):
        old: DataFrame | None = None
        pages: int | None = None
        counted = CountedSteps(on_step) if on_step and not keeps else None
        live, reached = graph, None

        def result(ranks: DataFrame | None) -> DataFrame:
            table = _page_table(graph, ranks, semantics)
            if num_partitions and num_partitions != graph.width:
                table = table.repartition(num_partitions, "page")
            return table.checkpoint()

        try:
            results = [result(None)] if wanted[0] == 0 else []
            ranks, shares = None, page_shares(graph, None, keeps)
            for step in range(1, iterations + 1):
                ranks = ranks_from_shares(live, shares, damping, reached if step in wanted else None)
                if on_step and keeps:
                    # The targets of links never change, nor do the sources.
                    pages = pages or _page_table(graph, ranks, semantics).count()
                    on_step(step, pages)
                elif counted:
                    # Written as a whole: a merge join need not read all rows of a side.
                    ranks = checkpoint_in_place(counted.watch(step, ranks))
                    counted.report()
                fresh = ranks if counted else None
                if step == 1 and iterations > 1:
                    fresh = ranks = ranks if counted else checkpoint_in_place(ranks)
                    live = graph.leaving(ranks, 1 - damping) or graph
                    reached = ranks if keeps and live is not graph else None
                if step in wanted:
                    results.append(result(ranks))
                shares = page_shares(live, ranks, keeps)
                if not counted and step % checkpoint_every == 0 and step < iterations:
                    fresh = shares = checkpoint_in_place(shares)
                if fresh is not None:
                    if old is not None and old is not reached:
                        discard_checkpoint(old)
                    old = fresh
            for table in (old, reached):
                if table is not None:
                    discard_checkpoint(table)
            return results
        finally:
            if live is not graph:
                live.release()
            graph.release()


def _page_table(graph: LinkGraph, ranks: DataFrame | None, semantics: RankSemantics) -> DataFrame:
    if ranks is None:
        return graph.ranked_sources(None, True).select(
            "page", "pagerank", F.col("degree").alias("out_degree")
        )
    return complete_ranks(graph, ranks, semantics.keeps_unreached)


def pagerank_progress(edges: DataFrame, **options) -> DataFrame:
    """``iteration, n_pages``: pages in the rank table after each step.

    Takes the options of ``pagerank()``.
    """
    steps: list[tuple[int, int]] = []
    pagerank(edges, on_step=lambda step, pages: steps.append((step, pages)), **options)
    return edges.sparkSession.createDataFrame(steps, "iteration BIGINT, n_pages BIGINT")
