"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions import md5_bucket, url_domain, url_protocol
from linkrank.operators import (
    DegreeRule,
    LinkGraph,
    PageNumbers,
    adjacency,
    annotate_ranks,
    bucket_sizes,
    complete_ranks,
    damped,
    distinct_links,
    join_url_parts,
    link_contributions,
    neighbour_contributions,
    numbered,
    out_degree,
    partition_sizes,
    place_by_bucket,
    prepare_graph,
    project_links,
    rank_step,
    report_lines,
    sorted_ranks,
    start_ranks,
    sum_contributions,
    top_k,
)
from linkrank.plans import RankSemantics, pagerank, pagerank_after, pagerank_progress
from linkrank.session import default_width, scratch_path
from linkrank.sinks import CSV, TEXT, URL, write_ranks
from linkrank.sources import (
    links_from_lines,
    read_ranks,
    read_triples_csv,
    read_triples_text,
    rejected_lines,
)
from linkrank.workload.relations import (
    HUB_LINKS,
    IRI_LINKS,
    ODD_LINES,
    ORDER_LINKS,
    PART_LINKS,
    PREDICATE,
    SAVED_DOMAINS,
    TRIPLE_LINES,
    URL_LINKS,
)

ROWS_ZERO, DISTINCT_DROP = RankSemantics.ROWS_ZERO, RankSemantics.DISTINCT_DROP
ROWS, DISTINCT = DegreeRule.ROWS, DegreeRule.DISTINCT
DAMPING = 0.85
BUCKETS = 100
# Low enough for the hub to be spread over partitions at every table size.
HUB_SPREAD = 500
# Targets of a page in one adjacency row: a usual number, and one that cuts most pages.
BLOCK_SIZE, SMALL_BLOCK = 100_000, 7
Query = Callable[[SparkSession, str], DataFrame]


def _relation(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(sql.replace("lineitem", "{lineitem}"), lineitem=lineitem)


def _six(column: str | Column) -> Column:
    """Six digits. Sums differ in their last digits from run to run; rounding to
    nine first keeps that from deciding exact halves such as 1.5590625.
    """
    return F.round(F.round(column, 9), 6)


def _rounded(ranks: DataFrame) -> DataFrame:
    return ranks.withColumn("pagerank", _six("pagerank"))


def _ranks(sql: str = ORDER_LINKS, **options) -> Query:
    return lambda spark, sf: pagerank(_relation(spark, sf, sql), **options)


def _pages(sql: str = ORDER_LINKS, **options) -> Query:
    run = _ranks(sql, **options)
    return lambda spark, sf: _rounded(run(spark, sf)).select("page", "pagerank")


# --- reading and parsing ---------------------------------------------------


def _saved_lines(
    spark: SparkSession, sf_dir: str, sql: str = TRIPLE_LINES, compression: str = "none"
) -> str:
    path = scratch_path(spark, "triples.nt")
    lines = _relation(spark, sf_dir, sql)
    if compression != "none":
        # A table in few files would be compressed by few tasks.
        lines = lines.repartition(default_width(spark))
    lines.write.text(path, compression=compression)
    return path


def scan_triples_csv(spark, sf_dir):
    return read_triples_csv(spark, _saved_lines(spark, sf_dir))


def scan_triples_text(spark, sf_dir):
    return read_triples_text(spark, _saved_lines(spark, sf_dir))


def scan_triples_bz2(spark, sf_dir):
    return project_links(read_triples_csv(spark, _saved_lines(spark, sf_dir, compression="bzip2")))


def links_of_odd_lines(spark, sf_dir):
    return links_from_lines(_relation(spark, sf_dir, ODD_LINES))


def rejected_line_count(spark, sf_dir):
    rejected = rejected_lines(spark, _saved_lines(spark, sf_dir, ODD_LINES))
    return rejected.agg(F.count(F.lit(1)).alias("n_lines"))


def project(spark, sf_dir):
    triples = _relation(spark, sf_dir, IRI_LINKS).withColumn("predicate", F.lit(PREDICATE))
    return project_links(triples)


# --- graph tables ----------------------------------------------------------


def distinct(spark, sf_dir):
    return distinct_links(_relation(spark, sf_dir, PART_LINKS))


def out_degree_rows(spark, sf_dir):
    return out_degree(_relation(spark, sf_dir, PART_LINKS), ROWS)


def out_degree_distinct(spark, sf_dir):
    return out_degree(_relation(spark, sf_dir, PART_LINKS), DISTINCT)


def initial_ranks(spark, sf_dir):
    return start_ranks(_relation(spark, sf_dir, ORDER_LINKS))


def _adjacency(block_size: int) -> Query:
    def run(spark, sf_dir):
        blocks = adjacency(_relation(spark, sf_dir, PART_LINKS), block_size)
        neighbours = F.array_join(F.col("neighbours").cast("array<string>"), " ")
        return blocks.select("page", "block", neighbours.alias("neighbours"), "degree")

    return run


# --- parts of a step -------------------------------------------------------


def _single_pass(spark, sf_dir, rule):
    return prepare_graph(_relation(spark, sf_dir, PART_LINKS), rule, keep=False)


def join_links_ranks(spark, sf_dir):
    graph = _single_pass(spark, sf_dir, ROWS)
    ranked = graph.ranked_sources(None, True).withColumnRenamed("degree", "out_degree")
    return graph.along_links(ranked.select("page", "salts", "pagerank", "out_degree"))


def join_adjacency_ranks(spark, sf_dir):
    edges = _relation(spark, sf_dir, PART_LINKS)
    blocks = adjacency(edges, BLOCK_SIZE, start_ranks(edges))
    return blocks.select("page", "block", F.col("degree").alias("n_neighbours"), "pagerank")


def contributions(spark, sf_dir):
    rows = link_contributions(_single_pass(spark, sf_dir, ROWS), None, True)
    return rows.withColumn("contribution", _six("contribution"))


def explode_contributions(spark, sf_dir):
    edges = _relation(spark, sf_dir, PART_LINKS)
    rows = neighbour_contributions(adjacency(edges, BLOCK_SIZE, start_ranks(edges)))
    return rows.withColumn("contribution", _six("contribution"))


def _sums(rule: DegreeRule) -> Query:
    def run(spark, sf_dir):
        graph = _single_pass(spark, sf_dir, rule)
        sums = sum_contributions(link_contributions(graph, None, rule is ROWS))
        return sums.withColumn("sum_contributions", _six("sum_contributions"))

    return run


def _step(rule: DegreeRule) -> Query:
    def run(spark, sf_dir):
        graph = _single_pass(spark, sf_dir, rule)
        return _rounded(rank_step(graph, None, DAMPING, rule is ROWS))

    return run


# --- the same parts in the second step, where ranks differ and pages are gone


def _second(rule: DegreeRule, part: Callable[[LinkGraph, DataFrame, bool], DataFrame]) -> Query:
    """``part`` of the graph and the ranks after one step."""

    def run(spark, sf_dir):
        graph, keeps = _single_pass(spark, sf_dir, rule), rule is ROWS
        return part(graph, rank_step(graph, None, DAMPING, keeps), keeps)

    return run


def _joined(graph, ranks, keeps):
    ranked = graph.ranked_sources(ranks, keeps).withColumnRenamed("degree", "out_degree")
    return _rounded(graph.along_links(ranked.select("page", "salts", "pagerank", "out_degree")))


def _passed_on(graph, ranks, keeps):
    rows = link_contributions(graph, ranks, keeps)
    return rows.withColumn("contribution", _six("contribution"))


def _summed(graph, ranks, keeps):
    sums = sum_contributions(link_contributions(graph, ranks, keeps))
    return sums.withColumn("sum_contributions", _six("sum_contributions"))


def _ranked(graph, ranks, keeps):
    return _rounded(rank_step(graph, ranks, DAMPING, keeps))


def _second_blocks(spark, sf_dir):
    edges = _relation(spark, sf_dir, PART_LINKS)
    graph = prepare_graph(edges, DISTINCT, keep=False)
    return adjacency(edges, SMALL_BLOCK, rank_step(graph, None, DAMPING, False))


def join_adjacency_second(spark, sf_dir):
    blocks = _rounded(_second_blocks(spark, sf_dir))
    n_in_block = F.size("neighbours").cast("bigint").alias("n_in_block")
    return blocks.select("page", "block", n_in_block, F.col("degree").alias("n_neighbours"), "pagerank")


def explode_second(spark, sf_dir):
    rows = neighbour_contributions(_second_blocks(spark, sf_dir))
    return rows.withColumn("contribution", _six("contribution"))


def outer_fill_ranks(spark, sf_dir):
    graph = prepare_graph(_relation(spark, sf_dir, ORDER_LINKS), ROWS, keep=False)
    return _rounded(complete_ranks(graph, rank_step(graph, None, DAMPING, True), True))


def null_guard_sum(spark, sf_dir):
    """Every source with its damped sum; no incoming contribution counts as 0."""
    graph = prepare_graph(_relation(spark, sf_dir, ORDER_LINKS), ROWS, keep=False)
    sums = sum_contributions(link_contributions(graph, None, True)).withColumnRenamed("target", "page")
    joined = graph.with_page_layout(sums, "left")
    total = F.coalesce("sum_contributions", F.lit(0.0))
    return joined.select("page", _six(damped(total, DAMPING)).alias("pagerank"))


# --- ranking ---------------------------------------------------------------


def iteration_counts(spark, sf_dir):
    return pagerank_progress(_relation(spark, sf_dir, ORDER_LINKS), semantics=DISTINCT_DROP)


def iteration_counts_rows_zero(spark, sf_dir):
    return pagerank_progress(_relation(spark, sf_dir, ORDER_LINKS))


def _file_ranks(links: DataFrame, **options) -> DataFrame:
    # Parsed once: laying out the links reads them twice.
    links = links.persist()
    ranks = pagerank(links, **options)
    links.unpersist()
    return _rounded(ranks).select("page", "pagerank")


def triple_file_rows_zero(spark, sf_dir):
    """From compressed triple lines to ranks, the way the rows-zero job does it."""
    return _file_ranks(scan_triples_bz2(spark, sf_dir))


def triple_file_distinct_drop(spark, sf_dir):
    """From triple lines to ranks, the way the distinct-drop job does it."""
    return _file_ranks(scan_triples_text(spark, sf_dir), semantics=DISTINCT_DROP)


def annotated_ranks(spark, sf_dir):
    return _rounded(annotate_ranks(_ranks(URL_LINKS)(spark, sf_dir)))


def left_join_url_info(spark, sf_dir):
    edges = _relation(spark, sf_dir, URL_LINKS)
    return _rounded(join_url_parts(pagerank(edges, 1), edges))


def max_rank(spark, sf_dir):
    return top_k(_pages(semantics=DISTINCT_DROP)(spark, sf_dir), 1)


# --- URLs and keys ---------------------------------------------------------


def _urls(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")


def domain_of_url(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", "url", url_domain(F.col("url")).alias("domain"))


def protocol_of_url(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", "url", url_protocol(F.col("url")).alias("protocol"))


def stripped_url_parts(spark, sf_dir):
    """URL parts from inside the angle brackets."""
    sources = _relation(spark, sf_dir, IRI_LINKS).select(F.col("source").alias("page")).distinct()
    page = F.col("page")
    return sources.select("page", url_domain(page, True).alias("domain"), url_protocol(page, True).alias("protocol"))


def stripped_annotated_ranks(spark, sf_dir):
    return _rounded(annotate_ranks(_ranks(IRI_LINKS)(spark, sf_dir), strip_brackets=True))


def bucket_of_key(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", md5_bucket(F.col("url"), BUCKETS).alias("bucket"))


def partition_skew(spark, sf_dir):
    return bucket_sizes(_relation(spark, sf_dir, IRI_LINKS), BUCKETS)


# --- saving ----------------------------------------------------------------


def placed_by_bucket(spark, sf_dir):
    return partition_sizes(place_by_bucket(_relation(spark, sf_dir, IRI_LINKS), BUCKETS))


def page_numbers(spark, sf_dir):
    """Each row of the links, as numbers with the names they stand for."""
    edges = _relation(spark, sf_dir, IRI_LINKS)
    return PageNumbers(edges).pages.select("page", "number", "rows")


def _saved(sql: str, layout: str, **options) -> Query:
    """Rank, save, and read back what was saved."""

    def run(spark, sf_dir):
        path = scratch_path(spark, layout)
        write_ranks(_ranks(sql, **options)(spark, sf_dir), path, layout)
        return _rounded(read_ranks(spark, path, layout))

    return run


def _overwritten(sql: str, layout: str) -> Query:
    """Save over what an earlier, shorter ranking has saved, and read back."""

    def run(spark, sf_dir):
        path = scratch_path(spark, layout)
        for ranks in pagerank_after(_relation(spark, sf_dir, sql), (1, 10)):
            write_ranks(ranks, path, layout, mode="overwrite")
        return _rounded(read_ranks(spark, path, layout))

    return run


def saved_domains_top10(spark, sf_dir):
    """The highest pages of two of the five domains, read from their directories alone."""
    path = scratch_path(spark, URL)
    write_ranks(_ranks(URL_LINKS)(spark, sf_dir), path, URL)
    return numbered(_rounded(read_ranks(spark, path, URL, SAVED_DOMAINS)), 10)


def saved_ranks_top10(spark, sf_dir):
    return numbered(_saved(IRI_LINKS, CSV)(spark, sf_dir), 10)


def rank_lines(spark, sf_dir):
    line = F.format_string("%s,%.6f", F.col("page"), F.col("pagerank"))
    return _pages(IRI_LINKS)(spark, sf_dir).select(line.alias("line"))


def queries() -> dict[str, Query]:
    return {
        "scan_triples_csv": scan_triples_csv,
        "scan_triples_text": scan_triples_text,
        "scan_triples_bz2": scan_triples_bz2,
        "saved_ranks_top10": saved_ranks_top10,
        "saved_domains_top10": saved_domains_top10,
        "parse_neighbors": links_of_odd_lines,
        "rejected_line_count": rejected_line_count,
        "project_links": project,
        "out_degree_rows": out_degree_rows,
        "out_degree_distinct": out_degree_distinct,
        "initial_ranks": initial_ranks,
        "contributions": contributions,
        "rank_step_rows_zero": _step(ROWS),
        "rank_step_distinct_drop": _step(DISTINCT),
        "null_guard_sum": null_guard_sum,
        "outer_fill_ranks": outer_fill_ranks,
        "rank_lines": rank_lines,
        "url_domain": domain_of_url,
        "url_protocol": protocol_of_url,
        "explode_contributions": explode_contributions,
        "md5_bucket": bucket_of_key,
        "distinct_links": distinct,
        "annotated_ranks": annotated_ranks,
        "join_links_ranks": join_links_ranks,
        "join_adjacency_ranks": join_adjacency_ranks,
        "left_join_url_info": left_join_url_info,
        "sum_contributions": _sums(ROWS),
        "reduce_contributions": _sums(DISTINCT),
        "adjacency_list": _adjacency(BLOCK_SIZE),
        "adjacency_blocks": _adjacency(SMALL_BLOCK),
        "join_links_ranks_second_step": _second(ROWS, _joined),
        "contributions_second_step": _second(ROWS, _passed_on),
        "sum_contributions_second_step": _second(ROWS, _summed),
        "reduce_contributions_second_step": _second(DISTINCT, _summed),
        "rank_step_rows_zero_second_step": _second(ROWS, _ranked),
        "rank_step_distinct_drop_second_step": _second(DISTINCT, _ranked),
        "join_adjacency_ranks_second_step": join_adjacency_second,
        "explode_contributions_second_step": explode_second,
        "iteration_counts": iteration_counts,
        "iteration_counts_rows_zero": iteration_counts_rows_zero,
        "stripped_url_parts": stripped_url_parts,
        "stripped_annotated_ranks": stripped_annotated_ranks,
        "pagerank_rows_zero": _pages(),
        "pagerank_distinct_drop": _pages(semantics=DISTINCT_DROP),
        "pagerank_rows_zero_copies": _pages(PART_LINKS),
        "pagerank_distinct_drop_copies": _pages(PART_LINKS, semantics=DISTINCT_DROP),
        "pagerank_rows_zero_hub": _pages(HUB_LINKS, hot_links=HUB_SPREAD),
        "pagerank_distinct_drop_hub": _pages(HUB_LINKS, semantics=DISTINCT_DROP, hot_links=HUB_SPREAD),
        "triple_file_rows_zero": triple_file_rows_zero,
        "triple_file_distinct_drop": triple_file_distinct_drop,
        "pagerank_annotated": _saved(URL_LINKS, URL),
        "pagerank_distinct_drop_partitioned": _pages(semantics=DISTINCT_DROP, num_partitions=100),
        "pagerank_numbered_rows_zero": _pages(IRI_LINKS, numbered=True),
        "pagerank_numbered_distinct_drop": _pages(IRI_LINKS, semantics=DISTINCT_DROP, numbered=True),
        "page_numbers": page_numbers,
        "pagerank_blocks_distinct_drop": _pages(semantics=DISTINCT_DROP, block_size=BLOCK_SIZE),
        "pagerank_small_blocks_hub": _pages(HUB_LINKS, semantics=DISTINCT_DROP, block_size=SMALL_BLOCK),
        "pagerank_durable_rows_zero": _pages(durable=True),
        "placed_by_bucket": placed_by_bucket,
        "pagerank_iter3_d50": _pages(iterations=3, damping=0.5),
        "topk_numbered": lambda spark, sf: numbered(_pages(semantics=DISTINCT_DROP)(spark, sf), 5),
        "ranks_sorted": lambda spark, sf: sorted_ranks(_pages()(spark, sf)),
        "top5_rows_zero": lambda spark, sf: top_k(_pages()(spark, sf), 5),
        "top5_distinct_drop": lambda spark, sf: top_k(_pages(semantics=DISTINCT_DROP)(spark, sf), 5),
        "max_rank": max_rank,
        "partition_skew": partition_skew,
        "sink_csv_bzip2": _saved(IRI_LINKS, CSV),
        "sink_partitioned_csv": _saved(IRI_LINKS, URL),
        "sink_text": _saved(IRI_LINKS, TEXT, semantics=DISTINCT_DROP),
        "sink_csv_overwrite": _overwritten(IRI_LINKS, CSV),
        "sink_text_overwrite": _overwritten(IRI_LINKS, TEXT),
        "topk_report_lines": lambda spark, sf: report_lines(_pages(semantics=DISTINCT_DROP)(spark, sf), 5),
    }
