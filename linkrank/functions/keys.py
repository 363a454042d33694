"""Hash buckets of page keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_PER_CHUNK = 8
_CHUNK_BASE = 16**_HEX_PER_CHUNK


def md5_bucket(key: Column, buckets: int) -> Column:
    """The 128-bit md5 of ``key`` modulo ``buckets``, as BIGINT.

    The digest is wider than any Spark number, so it is folded chunk by chunk:
    every 8 hex digits shift the remainder so far by 2**32. The remainder stays
    below ``buckets``, hence the product fits a BIGINT for up to 2**31 buckets.
    """
    if not 1 <= buckets < 2**31:
        raise ValueError("buckets must be between 1 and 2**31 - 1")
    digest = F.md5(key.cast("string"))

    def fold(remainder: Column, start: int) -> Column:
        chunk = F.conv(F.substring(digest, start, _HEX_PER_CHUNK), 16, 10).cast("bigint")
        return F.pmod(remainder * F.lit(_CHUNK_BASE) + chunk, F.lit(buckets).cast("bigint"))

    return reduce(fold, range(1, 33, _HEX_PER_CHUNK), F.lit(0).cast("bigint"))


def first_character_bucket(key: Column, buckets: int) -> Column:
    """Bucket of the first character only.

    Kept to show what goes wrong with it: all ``<...>`` keys share one bucket.
    """
    return md5_bucket(F.substring(key.cast("string"), 1, 1), buckets)
