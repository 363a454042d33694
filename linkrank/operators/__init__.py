"""Single relational steps the ranking is made of."""

from linkrank.operators.graph import (
    DegreeRule,
    LinkGraph,
    adjacency,
    distinct_links,
    out_degree,
    prepare_graph,
    project_links,
)
from linkrank.operators.numbering import PageNumbers
from linkrank.operators.partitioning import bucket_sizes, partition_sizes, place_by_bucket
from linkrank.operators.steps import (
    complete_ranks,
    damped,
    link_contributions,
    neighbour_contributions,
    rank_step,
    start_ranks,
    sum_contributions,
)
from linkrank.operators.topk import numbered, report_lines, sorted_ranks, top_k
from linkrank.operators.urls import annotate_ranks, join_url_parts

__all__ = [
    "DegreeRule",
    "LinkGraph",
    "PageNumbers",
    "adjacency",
    "annotate_ranks",
    "bucket_sizes",
    "complete_ranks",
    "damped",
    "distinct_links",
    "join_url_parts",
    "link_contributions",
    "neighbour_contributions",
    "numbered",
    "out_degree",
    "partition_sizes",
    "place_by_bucket",
    "prepare_graph",
    "project_links",
    "rank_step",
    "report_lines",
    "sorted_ranks",
    "start_ranks",
    "sum_contributions",
    "top_k",
]
