"""Writers for ranked pages."""

from linkrank.sinks.layouts import CSV, LAYOUTS, TEXT, URL, default_mode
from linkrank.sinks.ranks import write_ranks, write_ranks_by_url, write_ranks_csv, write_ranks_text

__all__ = [
    "CSV",
    "LAYOUTS",
    "TEXT",
    "URL",
    "default_mode",
    "write_ranks",
    "write_ranks_by_url",
    "write_ranks_csv",
    "write_ranks_text",
]
