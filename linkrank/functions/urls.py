"""Domain and protocol of a page URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These two patterns decide what counts as a domain and a protocol.
DOMAIN_PATTERN = r"^(?:https?:\/\/)?(?:www\.)?([^\/]+)"
PROTOCOL_PATTERN = r"^(https?):\/\/"


def _plain(url: Column, strip_brackets: bool) -> Column:
    """``<iri>`` without its angle brackets, if asked for."""
    return F.regexp_replace(url, r"^<|>$", "") if strip_brackets else url


def url_domain(url: Column, strip_brackets: bool = False) -> Column:
    """Host part of a URL without ``http(s)://`` and ``www.``; '' when there is none.

    A bracketed IRI (``<http://h/x>``) has the domain ``<http:`` unless
    ``strip_brackets`` is set. NULL stays NULL.
    """
    return F.regexp_extract(_plain(url, strip_brackets), DOMAIN_PATTERN, 1)


def url_protocol(url: Column, strip_brackets: bool = False) -> Column:
    """``http`` or ``https``; '' for everything else. NULL stays NULL."""
    return F.regexp_extract(_plain(url, strip_brackets), PROTOCOL_PATTERN, 1)
