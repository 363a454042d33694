"""From link rows to a graph laid out for repeated joins on the source page.

A prepared graph is two tables:

* ``sources``: one row per page with outgoing links - ``page, degree, links,
  salts``;
* ``links``: the distinct links - ``source, target`` and, if some source is
  too large for one partition, ``salt``; or, as adjacency blocks, ``source``,
  ``salt`` and the list ``neighbours`` of the links of a block. Without hubs
  they are stored as ``lists``, one row per source, and come out of it.

Kept in memory or on disk (lists and blocks on disk alone), or in the reliable folder, both are hash-partitioned and sorted by page with
the same number of partitions. A rank table that comes out of an aggregation
by page has that partitioning too, so a ranking step moves only the summed
contributions; the links, by far the largest table, stay where they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from enum import Enum

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.session import (
    checkpoint_in_place,
    default_width,
    discard_checkpoint,
    ensure_checkpoint_dir,
    keep_in_place,
    small_batches,
)

# A source is never called hot below this many links: that many rows are an
# ordinary partition. Concerns the layout only; ranks do not depend on it.
MIN_HOT_LINKS = 100_000
# Rows of a partition at most, on average, unless the caller sets the number of partitions.
MAX_ROWS = 1_000_000
# Tables of hot sources are broadcast up to this size, measured on their rows.
MAX_BROADCAST_BYTES = 8 << 20
ROW_BYTES = 32  # besides the page itself
# Links that can still pass something on are stored anew if they are at most this share of all.
LIVE_SHARE = 0.3
# Rows are dealt by their source alone if no partition gets more than this many times the mean.
EVEN_SHARE = 2
# Where lists of links are kept, in batches of so many rows. A batch of Spark's default, 10,000 rows,
# is an array of megabytes, which takes up to twice that in a heap of small regions, unseen by the
# accounts by which Spark moves stored blocks to disk. Lists are read a few times in a run.
LISTS, LIST_ROWS = StorageLevel.DISK_ONLY, 1_000
PLAIN_TYPES = {"string", "bigint", "int", "smallint", "tinyint"}
HASH_DIGITS = 15  # of the md5 that puts a target into a block; 60 bits fit a BIGINT


class DegreeRule(Enum):
    """What the out-degree of a page counts."""

    ROWS = "rows"  # every input row, copies and rows without a target included
    DISTINCT = "distinct"  # distinct targets; rows lacking an end are no links


def project_links(triples: DataFrame) -> DataFrame:
    """The two link columns of a triple table."""
    return triples.select("source", "target")


def distinct_links(edges: DataFrame) -> DataFrame:
    """Each (source, target) pair once. Copies are combined before the shuffle."""
    return edges.dropDuplicates(["source", "target"]).select("source", "target")


def out_degree(edges: DataFrame, rule: DegreeRule = DegreeRule.ROWS) -> DataFrame:
    """``page, out_degree`` under either counting rule."""
    if rule is DegreeRule.ROWS:
        degrees = edges.groupBy("source").agg(F.count(F.lit(1)).alias("out_degree"))
    else:
        whole = edges.where("source IS NOT NULL AND target IS NOT NULL")
        degrees = distinct_links(whole).groupBy("source").agg(F.count("target").alias("out_degree"))
    return degrees.withColumnRenamed("source", "page")


@dataclass(frozen=True)
class LinkGraph:
    """Prepared graph; see the module text. Build it with ``prepare_graph``."""

    sources: DataFrame
    links: DataFrame
    width: int
    salted: bool
    stored: tuple[DataFrame, ...] = ()
    durable: bool = False
    # Checkpoints below the stored tables.
    written: tuple[DataFrame, ...] = ()
    # Rank of a source that a rank table lacks.
    unreached: float = 0.0
    # ``source, targets``: all links of a source in a row, from which ``links`` come.
    lists: DataFrame | None = None

    @property
    def kept(self) -> bool:
        return bool(self.stored)

    def ranked_sources(self, ranks: DataFrame | None, keep_unranked: bool) -> DataFrame:
        """``sources`` with a ``pagerank`` column.

        Without a rank table every source has the start rank 1. Sources the
        table lacks get the rank ``unreached``, or are left out if not ``keep_unranked``.
        """
        if ranks is None:
            return self.sources.withColumn("pagerank", F.lit(1.0))
        how = "left" if keep_unranked else "inner"
        joined = self.with_page_layout(ranks.select("page", "pagerank"), how)
        return joined.withColumn("pagerank", F.coalesce("pagerank", F.lit(self.unreached)))

    def with_page_layout(self, pages: DataFrame, how: str) -> DataFrame:
        """Join ``sources`` (left side) with a per-page table, on the page."""
        if self.kept:
            # Both sides already lie side by side; only ``pages`` is sorted.
            pages = pages.hint("merge")
        return self.sources.join(pages, "page", how)

    @property
    def keys(self) -> list[str]:
        """What the links are partitioned by."""
        return ["source", "salt"] if self.salted else ["source"]

    def keyed(self, pages: DataFrame) -> DataFrame:
        """``pages`` with the link keys in place of ``page`` and ``salts``.

        ``pages`` holds ``page`` and ``salts`` from ``sources`` and at most one
        row per page. A page whose links are spread over several salts is
        repeated once for each of them, so no key is hot on either side.
        """
        pages = pages.withColumnRenamed("page", "source")
        if self.salted:
            salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))
            pages = pages.withColumn("salt", salt)
            if self.kept:
                pages = pages.repartition(self.width, *self.keys)
        return pages.drop("salts").hint("merge") if self.kept else pages.drop("salts")

    def along_links(self, pages: DataFrame) -> DataFrame:
        """Every link with the columns of the page it leaves (inner join); links of a block come out of its row."""
        if self.lists is not None:
            rows = self.lists.join(self.keyed(pages), "source")
            others = [c for c in rows.columns if c not in ("source", "targets")]
            return rows.select("source", F.explode("targets").alias("target"), *others)
        rows = self.links.join(self.keyed(pages), self.keys).drop("salt")
        if "neighbours" not in rows.columns:
            return rows
        others = [c for c in rows.columns if c not in ("source", "neighbours")]
        return rows.select("source", F.explode("neighbours").alias("link"), *others).select("source", "link.target", *others)

    def leaving(self, reached: DataFrame, unreached: float) -> LinkGraph | None:
        """The part of a kept graph whose links leave pages of ``reached``, or None if that is most of it.

        ``reached`` holds ``page`` in the layout of ``sources``, so nothing is moved
        but the keys of salted links. The part is a checkpoint, so nothing leads back to
        the links of the graph, which are given up; if not ``durable`` it is also kept in memory, lists on disk.
        """
        pages = reached.select("page").hint("merge")
        sources = self.sources.join(pages, "page", "left_semi")
        count = F.coalesce(F.sum("links"), F.lit(0)).alias("links")
        if sources.agg(count).first()[0] > LIVE_SHARE * self.sources.agg(count).first()[0]:
            return None
        sources = checkpoint_in_place(sources)
        links = self.links if self.lists is None else self.lists
        links = checkpoint_in_place(links.join(self.keyed(sources.select("page", "salts")), self.keys, "left_semi"))
        _give_up(self.stored[1:], self.durable)
        written = (sources, links)
        if not self.durable:
            of_lists = self.lists is not None or "neighbours" in links.columns
            sources, links = sources.persist(), links.persist(LISTS) if of_lists else links.persist()
        part = replace(self, sources=sources, links=links, stored=(sources, links), written=written, unreached=unreached)
        return part if self.lists is None else replace(part, links=_listed(links), lists=links)

    def release(self) -> None:
        """Give up the stored tables."""
        _give_up(self.stored, self.durable)
        for table in self.written:
            discard_checkpoint(table)


def _give_up(tables: tuple[DataFrame, ...], durable: bool) -> None:
    for table in tables:
        if durable:
            discard_checkpoint(table)
        else:
            table.unpersist()


def prepare_graph(
    edges: DataFrame,
    rule: DegreeRule,
    num_partitions: int | None = None,
    hot_links: int | None = None,
    keep: bool = True,
    block_size: int | None = None,
    durable: bool = False,
) -> LinkGraph:
    """Lay out the links in ``edges`` (columns ``source, target``).

    ``num_partitions`` defaults to the shuffle width of the session, or more where
    rows without hubs would be more than ``MAX_ROWS`` in a partition. If it is
    more than that, no more partitions are made than hold ``MIN_HOT_LINKS`` links
    each; ``width`` is what came of it. A source
    with more than ``hot_links`` links is spread over several partitions by a
    salt taken from the target. ``keep`` stores both tables in memory and,
    beyond it, on disk (for many passes), and hot links default to the mean
    partition size, 100,000 at least. Without it they stay plain query plans
    (for a single pass): no job runs here, and links are only spread if
    ``hot_links`` is given. Lists and adjacency blocks are kept on disk alone. Stored blocks lost with an executor are computed
    again from the input; ``durable`` tables are written to the checkpoint folder
    once instead, keep their layout, and outlive any executor. ``block_size``
    (with ``keep``) makes adjacency blocks of the links: a row holds so many
    neighbours on average at most, by the same salt as hot links, and lies by
    page and block. For one exchange per step, jobs on a kept graph run
    with its width as that of shuffles (``session.shuffle_width``).

    A kept graph without ``hot_links`` and ``block_size`` reads the input twice: the
    first pass counts the rows that each partition would get by a hash of
    the source. Unless a hub makes one of them large, rows are moved once, by
    their source. Persist an input that is slow to read.
    """
    for name, value in (("num_partitions", num_partitions), ("hot_links", hot_links), ("block_size", block_size)):
        if value is not None and value < 1:
            raise ValueError(f"{name} must be 1 or more")
    if (block_size or durable) and not keep:
        raise ValueError("only kept graphs have blocks or are durable")
    width = num_partitions or default_width(edges.sparkSession)
    edges = edges.select("source", "target")
    if rule is DegreeRule.DISTINCT:
        edges = edges.where("source IS NOT NULL AND target IS NOT NULL")

    # Other types have values that are equal and differ, such as 0.0 and -0.0.
    plain = {kind for _, kind in edges.dtypes} <= PLAIN_TYPES
    if keep and plain and not hot_links and not block_size:
        even = _even_width(edges, width, num_partitions is None)
        if even:
            return _dealt_by_source(edges, rule, even, durable)

    # One pass gives distinct links and row counts. Hashing both ends keeps a
    # hub's links apart, and copies of one row are counted before the shuffle.
    pairs = edges.groupBy("source", "target").agg(F.count(F.lit(1)).alias("copies"))
    degree = F.sum("copies") if rule is DegreeRule.ROWS else F.count(F.lit(1))
    sources = (
        pairs.groupBy("source")
        .agg(degree.alias("degree"), F.count(F.lit(1)).alias("links"))
        .withColumnRenamed("source", "page")
    )
    keep_table = checkpoint_in_place if durable else DataFrame.persist
    if keep:
        pairs.persist()
        least = default_width(edges.sparkSession)
        if width > least:
            width = min(width, max(least, math.ceil(pairs.count() / MIN_HOT_LINKS)))
        sources = keep_table(sources.repartition(width, "page").sortWithinPartitions("page"))

    if not keep and hot_links is None:
        laid_out = sources.withColumn("salts", F.lit(1).cast("bigint"))
        return LinkGraph(laid_out, pairs.select("source", "target").where("source IS NOT NULL"), width, False)
    totals = sources.agg(F.sum("links").alias("links"), F.max("links").alias("largest")).first()
    limit = block_size or hot_links or max(MIN_HOT_LINKS, math.ceil((totals.links or 0) / width))
    salted = (totals.largest or 0) > limit
    salts = F.greatest(F.lit(1), F.ceil(F.col("links") / F.lit(limit))).cast("bigint")
    laid_out = sources.withColumn("salts", salts if salted else F.lit(1).cast("bigint"))

    links, keys = pairs.select("source", "target").where("source IS NOT NULL"), ["source"]
    if salted:
        hub_limit = math.ceil(totals.links / width)
        links, keys = _salted(links, laid_out.where("salts > 1"), hub_limit), ["source", "salt"]
    if keep:
        links = links.repartition(width, *keys)
        if block_size:
            # A struct, as lists leave out NULL targets.
            links = links.groupBy(*keys).agg(F.collect_list(F.struct("target")).alias("neighbours"))
        links = links.sortWithinPartitions(*keys)
        with small_batches(edges.sparkSession, LIST_ROWS):
            links = links.persist(LISTS) if block_size and not durable else keep_table(links)
            links.count()
        pairs.unpersist()
    return LinkGraph(laid_out, links, width, salted, (sources, links) if keep else (), durable)


def _even_width(edges: DataFrame, width: int, wider: bool) -> int | None:
    """The number of partitions, if a hash of the source deals the rows evenly; more than ``width`` if ``wider`` and needed."""
    least = default_width(edges.sparkSession)
    while True:
        # The hash is that of ``repartition``, so this counts its partitions.
        dealt = edges.groupBy(F.pmod(F.hash("source"), F.lit(width)).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
        sizes = dealt.agg(F.sum("rows").alias("rows"), F.max("rows").alias("largest")).first()
        rows = sizes.rows or 0
        fitting = max(width, math.ceil(rows / MAX_ROWS)) if wider else min(width, max(least, math.ceil(rows / MIN_HOT_LINKS)))
        if fitting == width:
            return width if (sizes.largest or 0) <= max(MIN_HOT_LINKS, EVEN_SHARE * rows / width) else None
        width = fitting


def _listed(lists: DataFrame) -> DataFrame:
    return lists.select("source", F.explode("targets").alias("target"))


def _dealt_by_source(edges: DataFrame, rule: DegreeRule, width: int, durable: bool) -> LinkGraph:
    """The kept graph of rows without hubs: moved and sorted once, and grouped as they lie."""
    rows = edges.repartition(width, "source").sortWithinPartitions("source")
    # Sets leave out NULL.
    targets, null = F.collect_set("target"), F.lit(None).cast(edges.schema["target"].dataType)
    targets = F.when(F.count_if(F.col("target").isNull()) > 0, F.array_append(targets, null)).otherwise(targets)
    grouped = rows.groupBy("source").agg(targets.alias("targets"), F.count(F.lit(1)).alias("rows"))
    grouped = grouped.sortWithinPartitions("source")
    count = F.size("targets").cast("bigint")
    degree = F.col("rows") if rule is DegreeRule.ROWS else count
    with small_batches(edges.sparkSession, LIST_ROWS):
        stored = checkpoint_in_place(grouped) if durable else keep_in_place(grouped, LISTS)
        sources = stored.select(F.col("source").alias("page"), degree.alias("degree"), count.alias("links"))
        sources = checkpoint_in_place(sources) if durable else keep_in_place(sources)
        sources.count()
    lists = stored.select("source", "targets").where("source IS NOT NULL")
    laid_out = sources.withColumn("salts", F.lit(1).cast("bigint"))
    return LinkGraph(laid_out, _listed(lists), width, False, (sources, stored), durable, lists=lists)


def broadcast_size(table: DataFrame, page: str) -> int:
    """Bytes that a table of one row per page takes, from its rows."""
    size = F.octet_length(F.col(page).cast("string")) + F.lit(ROW_BYTES)
    return table.agg(F.sum(size)).first()[0] or 0


def _salted(links: DataFrame, hot: DataFrame, hub_limit: int) -> DataFrame:
    """``source, target, salt``: links of a hot source spread by their target.

    Sources above ``hub_limit``, the mean partition size, are at most as many
    as there are partitions, so they can always be broadcast. If the table of
    all hot sources is too large for that, the others are joined by shuffle;
    none of them has more links than an average partition.
    """
    salt = F.pmod(F.xxhash64("target"), F.coalesce("salts", F.lit(1).cast("bigint")))
    return _with_hot(links, hot, "salts", hub_limit).select("source", "target", salt.alias("salt"))


def _with_hot(links: DataFrame, hot: DataFrame, name: str, hub_limit: int) -> DataFrame:
    """``links`` with the column ``name`` of their source from ``hot`` (``page, links, name``), else NULL."""
    hot = hot.where("page IS NOT NULL").withColumnRenamed("page", "source")
    if broadcast_size(hot, "source") <= MAX_BROADCAST_BYTES:
        return links.join(F.broadcast(hot.select("source", name)), "source", "left")
    hubs = F.broadcast(hot.where(F.col("links") > hub_limit).select("source", name))
    others = hot.where(F.col("links") <= hub_limit).select("source", name)
    return links.join(hubs, "source").unionByName(
        links.join(hubs, "source", "left_anti").join(others, "source", "left")
    )


def adjacency(edges: DataFrame, block_size: int, ranks: DataFrame | None = None) -> DataFrame:
    """``page, block, neighbours, degree``: the distinct targets of each page, sorted.

    A page's targets lie in ``ceil(degree / block_size)`` blocks, so that no row
    and no task has to hold the whole neighbourhood of a hub. A target's block
    is the number in the first 15 hex digits of its md5, modulo the blocks of
    the page; empty blocks give no row. ``degree`` is that of the whole page.
    With ``ranks`` there is a ``pagerank`` column too, and pages without a rank
    are left out. The input is read once: the distinct links are written to the
    checkpoint folder.
    """
    if block_size < 1:
        raise ValueError("block_size must be 1 or more")
    ensure_checkpoint_dir(edges.sparkSession)
    links = distinct_links(edges.where("source IS NOT NULL AND target IS NOT NULL")).checkpoint()
    degrees = links.groupBy(F.col("source").alias("page")).agg(F.count(F.lit(1)).alias("links"))
    degrees = degrees.withColumn("blocks", F.ceil(F.col("links") / F.lit(block_size)).cast("bigint"))
    large = degrees.where(F.col("links") > block_size)
    hub_limit = math.ceil(links.count() / default_width(edges.sparkSession))
    digits = F.substring(F.md5(F.col("target").cast("string").cast("binary")), 1, HASH_DIGITS)
    block = F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.coalesce("blocks", F.lit(1).cast("bigint")))
    dealt = _with_hot(links, large, "blocks", hub_limit).withColumn("block", block)
    lists = dealt.groupBy("source", "block").agg(F.sort_array(F.collect_set("target")).alias("neighbours"))
    pages, columns = degrees.withColumnRenamed("links", "degree"), ["degree"]
    if ranks is not None:
        pages, columns = pages.join(ranks.select("page", "pagerank"), "page"), ["degree", "pagerank"]
    # One row for each block of a page, so that the blocks of a hub meet theirs in many tasks.
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")
    whole = lists.withColumnRenamed("source", "page").join(pages.select("page", numbers, *columns), ["page", "block"])
    return whole.select("page", "block", "neighbours", *columns)
