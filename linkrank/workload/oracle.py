"""The registered queries as plain SQL for an independent engine (DuckDB).

The ranking is unrolled into one common table expression per step, with the
outer join and the filling of gaps repeated in every step. Ranks are rounded
as in the queries: to nine digits, which removes noise, then to six.
"""

from __future__ import annotations

from linkrank.workload.relations import (
    HUB_LINKS,
    IRI_LINKS,
    ODD_LINES,
    ORDER_LINKS,
    PART_LINKS,
    PREDICATE,
    SAVED_DOMAINS,
    URL_LINKS,
)

# The two patterns of linkrank.functions.urls as SQL text.
DOMAIN = r"'^(?:https?:\/\/)?(?:www\.)?([^\/]+)'"
PROTOCOL = r"'^(https?):\/\/'"
BUCKETS = 100


def _domain(url: str) -> str:
    return f"regexp_extract({url}, {DOMAIN}, 1)"


def _protocol(url: str) -> str:
    return f"regexp_extract({url}, {PROTOCOL}, 1)"


def _rows_zero(edges: str, steps: int = 10, damping: float = 0.85) -> str:
    """CTEs down to ``ranked(page, pagerank, out_degree)``."""
    ctes = [
        f"edges AS MATERIALIZED ({edges})",
        "degrees AS MATERIALIZED (SELECT source AS page, count(*) AS out_degree FROM edges GROUP BY source)",
        "links AS MATERIALIZED (SELECT DISTINCT source, target FROM edges)",
        "r0 AS (SELECT page, CAST(1 AS DOUBLE) AS pagerank, out_degree FROM degrees)",
    ]
    for i in range(1, steps + 1):
        ctes.append(
            f"n{i} AS (SELECT l.target AS page, (1 - {damping}) + {damping} * sum(r.pagerank / r.out_degree)"
            f" AS pagerank FROM links l JOIN r{i - 1} r ON l.source = r.page GROUP BY l.target)"
        )
        ctes.append(
            f"r{i} AS MATERIALIZED (SELECT coalesce(n.page, d.page) AS page, coalesce(n.pagerank, 0) AS pagerank,"
            f" coalesce(d.out_degree, 0) AS out_degree FROM n{i} n FULL JOIN degrees d ON n.page = d.page)"
        )
    ctes.append(f"ranked AS (SELECT page, round(round(pagerank, 9), 6) AS pagerank, out_degree FROM r{steps})")
    return "WITH " + ",\n".join(ctes)


def _distinct_drop(edges: str, steps: int = 10) -> str:
    """The same under the other rules; every step is also there as ``r<i>``."""
    ctes = [
        f"edges AS MATERIALIZED ({edges})",
        "links AS MATERIALIZED (SELECT DISTINCT source, target FROM edges)",
        "degrees AS MATERIALIZED (SELECT source AS page, count(*) AS out_degree FROM links GROUP BY source)",
        "r0 AS (SELECT page, CAST(1 AS DOUBLE) AS pagerank FROM degrees)",
    ]
    for i in range(1, steps + 1):
        ctes.append(
            f"r{i} AS MATERIALIZED (SELECT l.target AS page, sum(r.pagerank / d.out_degree) * 0.85 + 0.15 AS pagerank"
            f" FROM links l JOIN r{i - 1} r ON l.source = r.page JOIN degrees d ON l.source = d.page GROUP BY l.target)"
        )
    ctes.append(f"ranked AS (SELECT page, round(round(pagerank, 9), 6) AS pagerank FROM r{steps})")
    return "WITH " + ",\n".join(ctes)


def _md5_bucket(key: str, buckets: int) -> str:
    digest = f"md5({key})"
    result = "0::HUGEINT"
    for start in (1, 9, 17, 25):
        chunk = f"('0x' || substr({digest}, {start}, 8))::BIGINT"
        result = f"(({result}) * 4294967296 + {chunk}) % {buckets}"
    return f"CAST({result} AS BIGINT)"


PAGES = "\nSELECT page, pagerank FROM ranked"
TOP = "\nSELECT page, pagerank FROM ranked ORDER BY pagerank DESC, page LIMIT {k}"
NUMBERED = (
    "\nSELECT row_number() OVER (ORDER BY pagerank DESC, page) AS position, page, pagerank"
    " FROM ranked ORDER BY position LIMIT {k}"
)
ANNOTATED = (
    f"\nSELECT DISTINCT r.page, r.pagerank, {_domain('e.source')} AS domain, {_protocol('e.source')} AS protocol"
    " FROM ranked r LEFT JOIN edges e ON r.page = e.source"
)
# Saved directories do not tell '' from NULL.
ANNOTATED_SAVED = (
    f"\nSELECT DISTINCT r.page, r.pagerank, nullif({_domain('e.source')}, '') AS domain,"
    f" nullif({_protocol('e.source')}, '') AS protocol FROM ranked r LEFT JOIN edges e ON r.page = e.source"
)
STEP_ROWS = f"""
WITH edges AS ({{edges}}),
degrees AS (SELECT source AS page, count(*) AS out_degree FROM edges GROUP BY source),
links AS (SELECT DISTINCT source, target FROM edges)
"""
STEP_DISTINCT = f"""
WITH links AS (SELECT DISTINCT source, target FROM ({{edges}}) AS edges),
degrees AS (SELECT source AS page, count(*) AS out_degree FROM links GROUP BY source)
"""
# The ranks of pages with links after one step.
SECOND_ROWS = """, n1 AS (
  SELECT target AS page, (1 - 0.85) + 0.85 * sum(CAST(1 AS DOUBLE) / out_degree) AS pagerank
  FROM links JOIN degrees ON source = page GROUP BY target),
r1 AS (SELECT d.page, coalesce(n1.pagerank, 0) AS pagerank, out_degree FROM degrees d LEFT JOIN n1 ON d.page = n1.page)
"""
SECOND_DISTINCT = """, n1 AS (
  SELECT target AS page, sum(CAST(1 AS DOUBLE) / out_degree) * 0.85 + 0.15 AS pagerank
  FROM links JOIN degrees ON source = page GROUP BY target),
r1 AS (SELECT d.page, n1.pagerank, out_degree FROM degrees d JOIN n1 ON d.page = n1.page)
"""
STRIPPED = "regexp_replace({url}, '^<|>$', '', 'g')"


def _six(value: str) -> str:
    return f"round(round({value}, 9), 6)"


def _blocks(block_size: int, ranks: str, columns: str) -> str:
    """Blocks of the adjacency lists of pages in ``ranks``; follows STEP_DISTINCT."""
    block = f"('0x' || substr(md5(CAST(target AS VARCHAR)), 1, 15))::BIGINT % CAST(ceil(out_degree / {block_size}.0) AS BIGINT)"
    return f"""
, dealt AS (SELECT page, {block} AS block, target, out_degree, pagerank FROM links JOIN {ranks} ON source = page)
SELECT page, block, {columns} FROM dealt GROUP BY page, block, out_degree, pagerank"""


START = "(SELECT page, out_degree, CAST(1 AS DOUBLE) AS pagerank FROM degrees) AS r0"
NEIGHBOURS = "string_agg(CAST(target AS VARCHAR), ' ' ORDER BY target) AS neighbours, out_degree AS degree"
ODD_TOKENS = rf"SELECT regexp_split_to_array(value, '\s+') AS t FROM ({ODD_LINES}) AS lines"


def oracle_sql() -> dict[str, str]:
    part_rows = STEP_ROWS.format(edges=PART_LINKS)
    part_distinct = STEP_DISTINCT.format(edges=PART_LINKS)
    order_rows = STEP_ROWS.format(edges=ORDER_LINKS)
    iri_rows = _rows_zero(IRI_LINKS)
    return {
        "scan_triples_csv": f"SELECT source, '{PREDICATE}' AS predicate, target FROM ({IRI_LINKS}) AS links",
        "scan_triples_text": IRI_LINKS,
        "scan_triples_bz2": IRI_LINKS,
        "saved_ranks_top10": iri_rows + NUMBERED.format(k=10),
        "saved_domains_top10": _rows_zero(URL_LINKS)
        + "\nSELECT row_number() OVER (ORDER BY pagerank DESC, page) AS position, page, pagerank"
        f" FROM ranked WHERE out_degree > 0 AND {_domain('page')} IN {SAVED_DOMAINS} ORDER BY position LIMIT 10",
        "parse_neighbors": f"SELECT t[1] AS source, t[3] AS target FROM ({ODD_TOKENS}) AS tokens WHERE len(t) >= 3",
        "rejected_line_count": f"SELECT count(*) AS n_lines FROM ({ODD_TOKENS}) AS tokens WHERE len(t) < 3",
        "project_links": IRI_LINKS,
        "out_degree_rows": "SELECT l_partkey AS page, count(*) AS out_degree FROM lineitem GROUP BY l_partkey",
        "out_degree_distinct": (
            "SELECT l_partkey AS page, count(DISTINCT l_suppkey) AS out_degree FROM lineitem GROUP BY l_partkey"
        ),
        "initial_ranks": (
            "SELECT l_orderkey AS page, count(*) AS out_degree, CAST(1 AS DOUBLE) AS pagerank"
            " FROM lineitem GROUP BY l_orderkey"
        ),
        "contributions": part_rows
        + "SELECT source, target, round(round(CAST(1 AS DOUBLE) / out_degree, 9), 6) AS contribution"
        " FROM links JOIN degrees ON source = page",
        "rank_step_rows_zero": part_rows
        + "SELECT target AS page, round(round((1 - 0.85) + 0.85 * sum(CAST(1 AS DOUBLE) / out_degree), 9), 6) AS pagerank"
        " FROM links JOIN degrees ON source = page GROUP BY target",
        "rank_step_distinct_drop": part_distinct
        + "SELECT target AS page, round(round(sum(CAST(1 AS DOUBLE) / out_degree) * 0.85 + 0.15, 9), 6) AS pagerank"
        " FROM links JOIN degrees ON source = page GROUP BY target",
        "null_guard_sum": order_rows
        + ", sums AS (SELECT target, sum(CAST(1 AS DOUBLE) / out_degree) AS total"
        " FROM links JOIN degrees ON source = page GROUP BY target)"
        " SELECT page, round(round((1 - 0.85) + 0.85 * CASE WHEN total IS NOT NULL THEN total ELSE 0 END, 9), 6) AS pagerank"
        " FROM degrees LEFT JOIN sums ON page = target",
        "outer_fill_ranks": _rows_zero(ORDER_LINKS, 1) + "\nSELECT page, pagerank, out_degree FROM ranked",
        "rank_lines": iri_rows + "\nSELECT concat(page, ',', printf('%.6f', pagerank)) AS line FROM ranked",
        "url_domain": f"SELECT page_id, url, {_domain('url')} AS domain FROM pages",
        "url_protocol": f"SELECT page_id, url, {_protocol('url')} AS protocol FROM pages",
        "explode_contributions": part_distinct
        + "SELECT target, round(round(CAST(1 AS DOUBLE) / out_degree, 9), 6) AS contribution"
        " FROM links JOIN degrees ON source = page",
        "md5_bucket": f"SELECT page_id, {_md5_bucket('url', BUCKETS)} AS bucket FROM pages",
        "distinct_links": f"SELECT DISTINCT source, target FROM ({PART_LINKS}) AS edges",
        "annotated_ranks": _rows_zero(URL_LINKS) + ANNOTATED,
        "join_links_ranks": part_rows
        + "SELECT source, target, CAST(1 AS DOUBLE) AS pagerank, out_degree FROM links JOIN degrees ON source = page",
        "join_adjacency_ranks": part_distinct + _blocks(100_000, START, "out_degree AS n_neighbours, pagerank"),
        "left_join_url_info": _rows_zero(URL_LINKS, 1) + ANNOTATED,
        "sum_contributions": part_rows
        + "SELECT target, round(round(sum(CAST(1 AS DOUBLE) / out_degree), 9), 6) AS sum_contributions"
        " FROM links JOIN degrees ON source = page GROUP BY target",
        "reduce_contributions": part_distinct
        + "SELECT target, round(round(sum(CAST(1 AS DOUBLE) / out_degree), 9), 6) AS sum_contributions"
        " FROM links JOIN degrees ON source = page GROUP BY target",
        "adjacency_list": part_distinct + _blocks(100_000, START, NEIGHBOURS),
        "adjacency_blocks": part_distinct + _blocks(7, START, NEIGHBOURS),
        "join_links_ranks_second_step": part_rows
        + SECOND_ROWS
        + f"SELECT source, target, {_six('pagerank')} AS pagerank, out_degree FROM links JOIN r1 ON source = page",
        "contributions_second_step": part_rows
        + SECOND_ROWS
        + f"SELECT source, target, {_six('pagerank / out_degree')} AS contribution FROM links JOIN r1 ON source = page",
        "sum_contributions_second_step": part_rows
        + SECOND_ROWS
        + f"SELECT target, {_six('sum(pagerank / out_degree)')} AS sum_contributions"
        " FROM links JOIN r1 ON source = page GROUP BY target",
        "reduce_contributions_second_step": part_distinct
        + SECOND_DISTINCT
        + f"SELECT target, {_six('sum(pagerank / out_degree)')} AS sum_contributions"
        " FROM links JOIN r1 ON source = page GROUP BY target",
        "rank_step_rows_zero_second_step": part_rows
        + SECOND_ROWS
        + f"SELECT target AS page, {_six('(1 - 0.85) + 0.85 * sum(pagerank / out_degree)')} AS pagerank"
        " FROM links JOIN r1 ON source = page GROUP BY target",
        "rank_step_distinct_drop_second_step": part_distinct
        + SECOND_DISTINCT
        + f"SELECT target AS page, {_six('sum(pagerank / out_degree) * 0.85 + 0.15')} AS pagerank"
        " FROM links JOIN r1 ON source = page GROUP BY target",
        "join_adjacency_ranks_second_step": part_distinct
        + SECOND_DISTINCT
        + _blocks(7, "r1", f"count(*) AS n_in_block, out_degree AS n_neighbours, {_six('pagerank')} AS pagerank"),
        "explode_contributions_second_step": part_distinct
        + SECOND_DISTINCT
        + f"SELECT target, {_six('pagerank / out_degree')} AS contribution FROM links JOIN r1 ON source = page",
        "stripped_url_parts": (
            f"SELECT DISTINCT source AS page, {_domain(STRIPPED.format(url='source'))} AS domain,"
            f" {_protocol(STRIPPED.format(url='source'))} AS protocol FROM ({IRI_LINKS}) AS edges"
        ),
        "stripped_annotated_ranks": iri_rows
        + f"\nSELECT DISTINCT r.page, r.pagerank, {_domain(STRIPPED.format(url='e.source'))} AS domain,"
        f" {_protocol(STRIPPED.format(url='e.source'))} AS protocol FROM ranked r LEFT JOIN edges e ON r.page = e.source",
        "iteration_counts_rows_zero": _rows_zero(ORDER_LINKS)
        + "\n"
        + " UNION ALL ".join(
            f"SELECT CAST({i} AS BIGINT) AS iteration, count(*) AS n_pages FROM r{i}" for i in range(1, 11)
        ),
        "iteration_counts": _distinct_drop(ORDER_LINKS)
        + "\n"
        + " UNION ALL ".join(
            f"SELECT CAST({i} AS BIGINT) AS iteration, count(*) AS n_pages FROM r{i}" for i in range(1, 11)
        ),
        "pagerank_rows_zero": _rows_zero(ORDER_LINKS) + PAGES,
        "pagerank_distinct_drop": _distinct_drop(ORDER_LINKS) + PAGES,
        "pagerank_rows_zero_copies": _rows_zero(PART_LINKS) + PAGES,
        "pagerank_distinct_drop_copies": _distinct_drop(PART_LINKS) + PAGES,
        "pagerank_rows_zero_hub": _rows_zero(HUB_LINKS) + PAGES,
        "pagerank_distinct_drop_hub": _distinct_drop(HUB_LINKS) + PAGES,
        "triple_file_rows_zero": iri_rows + PAGES,
        "triple_file_distinct_drop": _distinct_drop(IRI_LINKS) + PAGES,
        "pagerank_annotated": _rows_zero(URL_LINKS) + ANNOTATED_SAVED,
        "pagerank_distinct_drop_partitioned": _distinct_drop(ORDER_LINKS) + PAGES,
        "pagerank_numbered_rows_zero": iri_rows + PAGES,
        "pagerank_numbered_distinct_drop": _distinct_drop(IRI_LINKS) + PAGES,
        "page_numbers": f"""
WITH links AS ({IRI_LINKS}),
ends AS (SELECT source AS page FROM links UNION ALL SELECT target FROM links)
SELECT page, row_number() OVER (ORDER BY page) - 1 AS number, count(*) AS rows FROM ends GROUP BY page""",
        "pagerank_blocks_distinct_drop": _distinct_drop(ORDER_LINKS) + PAGES,
        "pagerank_small_blocks_hub": _distinct_drop(HUB_LINKS) + PAGES,
        "pagerank_durable_rows_zero": _rows_zero(ORDER_LINKS) + PAGES,
        "placed_by_bucket": f"""
SELECT {_md5_bucket('source', BUCKETS)} AS "partition", count(*) AS n_rows FROM ({IRI_LINKS}) AS links GROUP BY 1""",
        "pagerank_iter3_d50": _rows_zero(ORDER_LINKS, 3, 0.5) + PAGES,
        "topk_numbered": _distinct_drop(ORDER_LINKS) + NUMBERED.format(k=5),
        "ranks_sorted": _rows_zero(ORDER_LINKS) + PAGES + " ORDER BY pagerank DESC, page",
        "top5_rows_zero": _rows_zero(ORDER_LINKS) + TOP.format(k=5),
        "top5_distinct_drop": _distinct_drop(ORDER_LINKS) + TOP.format(k=5),
        "max_rank": _distinct_drop(ORDER_LINKS) + TOP.format(k=1),
        "partition_skew": f"""
WITH links AS ({IRI_LINKS}),
keyed AS (
  SELECT 'whole_key' AS key_rule, {_md5_bucket('source', BUCKETS)} AS bucket FROM links
  UNION ALL
  SELECT 'first_character' AS key_rule, {_md5_bucket('substr(source, 1, 1)', BUCKETS)} AS bucket FROM links
)
SELECT key_rule, bucket, count(*) AS n_rows FROM keyed GROUP BY key_rule, bucket""",
        "sink_csv_bzip2": iri_rows + PAGES,
        "sink_partitioned_csv": iri_rows + ANNOTATED_SAVED,
        "sink_text": _distinct_drop(IRI_LINKS) + PAGES,
        "sink_csv_overwrite": iri_rows + PAGES,
        "sink_text_overwrite": iri_rows + PAGES,
        "topk_report_lines": _distinct_drop(ORDER_LINKS)
        + ", top AS (SELECT row_number() OVER (ORDER BY pagerank DESC, page) AS position, page, pagerank FROM ranked)"
        "\nSELECT position, printf('%d. %s has rank: %.6f', position, CAST(page AS VARCHAR), pagerank) AS line"
        " FROM top WHERE position <= 5",
    }
