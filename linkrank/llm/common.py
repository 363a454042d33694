"""What the training-data operators share: input, storage, hashing, graph components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.session import collect_garbage, discard_checkpoint, ensure_checkpoint_dir, remove, scratch_path

# A word is a run of anything but these six white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """``frame`` computed once, kept in the shared checkpoint folder, its lineage cut."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


class Shelf:
    """Tables that an operator keeps in the shared folder until its result is there."""

    def __init__(self) -> None:
        self._kept: list[DataFrame] = []
        self._paths: list[tuple[SparkSession, str]] = []

    def stored(self, frame: DataFrame) -> DataFrame:
        return self.taken(stored(frame))

    def taken(self, table: DataFrame) -> DataFrame:
        """A table that was stored elsewhere and is no longer needed after the result."""
        self._kept.append(table)
        return table

    def written(self, frame: DataFrame, name: str) -> DataFrame:
        """``frame`` computed once and read again from Parquet files."""
        spark = frame.sparkSession
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        self._paths.append((spark, path))
        return spark.read.parquet(path)

    def discard(self, table: DataFrame) -> None:
        """Give up a stored table before the others."""
        self._kept = [t for t in self._kept if t is not table]
        discard_checkpoint(table)

    def last(self, frame: DataFrame) -> DataFrame:
        """``frame`` stored, all other tables removed."""
        result = stored(frame)
        for table in self._kept:
            discard_checkpoint(table)
        for spark, path in self._paths:
            remove(spark, path)
        self._kept, self._paths = [], []
        return result


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal digits modulo ``modulus``; a null id counts as 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of an edge; component: its smallest node.

    ``edges`` has the long columns ``a`` and ``b``. Each round hooks every root
    to its smallest neighbour, flattens the trees by doubling, and relabels the
    edges, so that only edges between different roots are left. Nodes with very
    many edges are only ever the key of partial aggregations or of joins that
    Spark may split. Tables of a round go to the checkpoint folder and are
    removed once the next round has its own; the driver collects its garbage then,
    as a round is a dozen jobs.
    """
    shelf = Shelf()
    ordered = lambda a, b: [F.greatest(a, b).alias("high"), F.least(a, b).alias("low")]
    links = shelf.stored(edges.select(*ordered("a", "b")).where("high <> low").distinct())
    labels = shelf.stored(
        links.select(F.explode(F.array("high", "low")).alias("node")).distinct().withColumn("component", F.col("node"))
    )
    while not links.isEmpty():
        jumped = shelf.stored(
            links.groupBy(F.col("high").alias("root"))
            .agg(F.min("low").alias("parent"))
            .withColumn("grandparent", F.lit(None).cast("long"))
        )
        while True:
            parent = jumped.select("root", F.coalesce("grandparent", "parent").alias("parent"))
            above = parent.select(F.col("root").alias("parent"), F.col("parent").alias("grandparent"))
            jumped, before = shelf.stored(parent.join(above, "parent", "left")), jumped
            shelf.discard(before)
            if jumped.where("grandparent is not null").isEmpty():
                break
        parent = jumped.select("root", "parent")
        old = links, labels, jumped
        links = shelf.stored(
            _relabel(_relabel(links, parent, "high"), parent, "low")
            .select(*ordered("high", "low"))
            .where("high <> low")
            .distinct()
        )
        labels = shelf.stored(_relabel(labels, parent, "component"))
        for table in old:
            shelf.discard(table)
        collect_garbage(edges.sparkSession)
    return labels


def _relabel(table: DataFrame, parent: DataFrame, name: str) -> DataFrame:
    known = parent.select(F.col("root").alias(name), "parent")
    rest = [c for c in table.columns if c != name]
    return table.join(known, name, "left").select(*rest, F.coalesce("parent", name).alias(name))
