"""Link ranking on Spark DataFrames."""

from linkrank.plans.pagerank import RankSemantics, pagerank, pagerank_progress
from linkrank.sinks import write_ranks
from linkrank.sources import read_ranks, read_triples_csv, read_triples_text

__all__ = [
    "RankSemantics",
    "pagerank",
    "pagerank_progress",
    "read_ranks",
    "read_triples_csv",
    "read_triples_text",
    "write_ranks",
]
