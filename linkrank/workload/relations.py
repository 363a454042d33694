"""Link relations derived from the given tables, as SQL that Spark and DuckDB both read.

Each reads its whole table. ``{lineitem}`` stands for the table name.
"""

# Orders to parts, with one id space for both: has copies, pages without
# in-links, pages without out-links, and chains between the two.
ORDER_LINKS = "SELECT l_orderkey AS source, l_partkey AS target FROM lineitem"

# Parts to suppliers: most links occur many times.
PART_LINKS = "SELECT l_partkey AS source, l_suppkey AS target FROM lineitem"


# Page 0 holds about a third of all rows as a source and another as a target.
HUB_LINKS = """
SELECT CASE WHEN l_linenumber % 3 = 0 THEN CAST(0 AS BIGINT) ELSE l_partkey END AS source,
       CASE WHEN l_linenumber % 3 = 1 THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS target
FROM lineitem
"""


def page_url(key: str) -> str:
    """A URL for a page id: both protocols, with and without ``www.``, five domains."""
    return (
        f"concat('http', CASE WHEN {key} % 3 = 0 THEN 's' ELSE '' END, '://', "
        f"CASE WHEN {key} % 2 = 0 THEN 'www.' ELSE '' END, "
        f"'site', CAST({key} % 5 AS VARCHAR(20)), '.example.org/n/', CAST({key} AS VARCHAR(20)))"
    )


# The order links between URLs.
URL_LINKS = (
    f"SELECT {page_url('l_orderkey')} AS source, {page_url('l_partkey')} AS target FROM lineitem"
)

# Two of the five domains.
SAVED_DOMAINS = ("site1.example.org", "site3.example.org")


def bracketed(key: str) -> str:
    return f"concat('<http://ex.org/n/', CAST({key} AS VARCHAR(20)), '>')"


# The order links in angle brackets.
IRI_LINKS = (
    f"SELECT {bracketed('l_orderkey')} AS source, {bracketed('l_partkey')} AS target FROM lineitem"
)

PREDICATE = "<http://ex.org/p>"

# Well-formed triple lines.
TRIPLE_LINES = (
    f"SELECT concat({bracketed('l_orderkey')}, ' {PREDICATE} ', {bracketed('l_partkey')}, ' .') "
    "AS value FROM lineitem"
)

# Triple lines as they turn up: tabs, wide gaps, no final dot, leading blanks,
# and lines that end too early.
ODD_LINES = f"""
SELECT CASE l_linenumber
         WHEN 1 THEN concat(s, ' ', p, ' ', t, ' .')
         WHEN 2 THEN concat(s, '   ', p, '  ', t, ' .')
         WHEN 3 THEN concat(s, chr(9), p, chr(9), t, chr(9), '.')
         WHEN 4 THEN concat(s, ' ', p, ' ', t)
         WHEN 5 THEN concat(' ', s, ' ', p, ' ', t, ' .')
         WHEN 6 THEN concat(s, ' ', p)
         ELSE s
       END AS value
FROM (SELECT l_linenumber, {bracketed('l_orderkey')} AS s, '{PREDICATE}' AS p,
             {bracketed('l_partkey')} AS t FROM lineitem) AS named
"""
