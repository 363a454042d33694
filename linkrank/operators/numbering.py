"""Pages as consecutive numbers.

Page names are long and come back in every row of every step. A dictionary
gives each page a number: names are dealt by range and sorted, each partition
counts its own, and the counts before it are its offset. Links between numbers
then go through the iteration, and names are joined back once at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.operators.graph import MAX_BROADCAST_BYTES, MIN_HOT_LINKS, broadcast_size
from linkrank.session import default_width, discard_checkpoint, ensure_checkpoint_dir

# Pages of a partition up to which names are looked up in a hash table rather than merged.
MAX_HASHED_PAGES = 1_000_000
PLACE_BITS = 33  # of Spark's increasing ids, for the place in a partition


class PageNumbers:
    """``pages``: the columns ``page``, ``number`` (0 to n - 1 in the order of the pages) and ``rows``, how often it is an end of a row."""

    def __init__(self, edges: DataFrame, width: int | None = None) -> None:
        spark = edges.sparkSession
        self.width = width or default_width(spark)
        ensure_checkpoint_dir(spark)
        ends = edges.select(F.explode(F.array("source", "target")).alias("page"))
        counted = ends.where("page IS NOT NULL").groupBy("page").agg(F.count(F.lit(1)).alias("rows"))
        # A checkpoint, so that places stay the same whenever they are read.
        place = F.monotonically_increasing_id()
        self._placed = counted.repartitionByRange(self.width, "page").sortWithinPartitions("page").withColumn("place", place).checkpoint()
        part = F.shiftright("place", PLACE_BITS).alias("part")
        sizes = self._placed.groupBy(part).agg(F.count(F.lit(1)).alias("pages"))
        # One row for each partition.
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("part", F.coalesce(F.sum("pages").over(before), F.lit(0)).alias("offset"))
        inside = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
        self.pages = self._placed.withColumn("part", part).join(F.broadcast(offsets), "part").select("page", (F.col("offset") + inside).alias("number"), "rows")

    def links(self, edges: DataFrame) -> DataFrame:
        """``source, target`` of every row of ``edges`` as numbers; a NULL end stays NULL.

        Pages with more rows than an average partition are sent to all tasks, so
        no task gets all rows of a hub; at most two for each partition are that
        large. Should their names be longer than the bytes that may be sent,
        their rows are dealt by the other end too.
        """
        totals = self._placed.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("pages")).first()
        rows, self._hashed = totals.rows or 0, totals.pages <= MAX_HASHED_PAGES * self.width
        limit = max(MIN_HOT_LINKS, math.ceil(rows / 2 / self.width))
        hubs = self.pages.where(F.col("rows") > limit).select("page", "number")
        for end in ("source", "target"):
            edges = self._numbered(edges, end, hubs, limit)
        return edges.select("source", "target")

    def _numbered(self, edges: DataFrame, end: str, hubs: DataFrame, limit: int) -> DataFrame:
        own = lambda table: table.select(F.col("page").alias(end), F.col("number").alias("own"))
        replaced = lambda table: table.withColumn(end, F.col("own")).drop("own")
        looked_up = lambda table: table.hint("shuffle_hash") if self._hashed else table
        few = hubs.count()
        if not few:
            return replaced(edges.join(looked_up(own(self.pages)), end, "left"))
        rest = looked_up(own(self.pages.where(F.col("rows") <= limit)))
        if broadcast_size(hubs, "page") <= MAX_BROADCAST_BYTES:
            sent = F.broadcast(own(hubs))
            others = edges.join(F.broadcast(own(hubs).drop("own")), end, "left_anti")
            return replaced(edges.join(sent, end)).unionByName(replaced(others.join(rest, end, "left")))
        salted = own(hubs).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(self.width - 1))))
        other = "target" if end == "source" else "source"
        dealt = edges.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(self.width)).cast("int"))
        hot = dealt.join(salted, [end, "salt"]).drop("salt")
        others = edges.join(own(hubs).drop("own").hint("shuffle_hash"), end, "left_anti")
        return replaced(hot).unionByName(replaced(others.join(rest, end, "left")))

    def names(self, ranks: DataFrame, number: Column | None = None) -> DataFrame:
        """``ranks`` with the names of its numbered pages; NULL pages stay."""
        names = self.pages.select(F.col("number").alias("own"), F.col("page").alias("name"))
        joined = ranks.join(names, (number if number is not None else F.col("page")) == F.col("own"), "left")
        return joined.withColumn("page", F.col("name")).drop("own", "name")

    def release(self) -> None:
        discard_checkpoint(self._placed)
