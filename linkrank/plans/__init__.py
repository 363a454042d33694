"""The iterative ranking."""

from linkrank.plans.pagerank import RankSemantics, pagerank, pagerank_after, pagerank_progress

__all__ = ["RankSemantics", "pagerank", "pagerank_after", "pagerank_progress"]
