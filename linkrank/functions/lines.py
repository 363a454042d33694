"""Text lines: splitting link triples, formatting saved ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A gap between tokens is a run of Unicode whitespace (the four
# separator control characters included); source and target are tokens 0 and 2.
TOKEN_GAP = r"(?U)[\s\x1c-\x1f]+"
SOURCE_TOKEN, TARGET_TOKEN = 0, 2
# A gap other than one blank.
_ODD_GAP = r"(?U)[\s\x1c-\x1f&&[^ ]]|  "


def leading_tokens(line: Column) -> Column:
    """The first three tokens and, as a fourth, whatever follows them."""
    # Most lines have single blanks, and to split at these needs no pattern.
    pieces = TARGET_TOKEN + 2
    return F.when(F.rlike(line, F.lit(_ODD_GAP)), F.split(line, TOKEN_GAP, pieces)).otherwise(F.split(line, " ", pieces))


def csv_rank_line(page: Column, rank: Column) -> Column:
    """``page,rank`` as one string; NULL if either is NULL."""
    return F.concat(page.cast("string"), F.lit(","), rank.cast("string"))


def tuple_rank_line(page: Column, rank: Column) -> Column:
    """``('page', rank)``, the way Python prints such a pair.

    A page holding a single quote is put in double quotes; one holding both
    kinds has its single quotes escaped. Backslashes are doubled. Tabs and other
    control characters stay as they are, where Python would escape them.
    """
    text = F.replace(page.cast("string"), F.lit("\\"), F.lit("\\\\"))
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    quoted = (
        F.when(single & ~double, F.concat(F.lit('"'), text, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )
    return F.concat(F.lit("("), quoted, F.lit(", "), rank.cast("string"), F.lit(")"))
