"""Column functions: everything here is a built-in Spark expression."""

from linkrank.functions.keys import first_character_bucket, md5_bucket
from linkrank.functions.lines import csv_rank_line, leading_tokens, tuple_rank_line
from linkrank.functions.urls import url_domain, url_protocol

__all__ = [
    "csv_rank_line",
    "first_character_bucket",
    "leading_tokens",
    "md5_bucket",
    "tuple_rank_line",
    "url_domain",
    "url_protocol",
]
