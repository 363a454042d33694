"""Readers: link triples in, saved ranks back in."""

from linkrank.sources.ranks import read_ranks
from linkrank.sources.triples import (
    TRIPLE_SCHEMA,
    links_from_lines,
    read_triples_csv,
    read_triples_text,
    rejected_lines,
)

__all__ = [
    "TRIPLE_SCHEMA",
    "links_from_lines",
    "read_ranks",
    "read_triples_csv",
    "read_triples_text",
    "rejected_lines",
]
