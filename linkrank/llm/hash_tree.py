"""Sharding by a hierarchical weighted hash tree, with column expressions only.

A key descends region, rack and shard. At each level every child draws
``ln(u) / weight`` with ``u`` from a hash of the key and the child's name, and
the largest draw wins: children are chosen in proportion to their weights, and
a changed weight moves keys only into or out of that child. A weight counts in
all levels above it, so movement stays in the subtrees whose weights change. A
new region holding one new shard takes keys into itself only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.common import stored

HASH_DIGITS = 13  # 52 bits, which a double holds exactly
SLOT_DIGITS = 3  # 4,096 buckets a shard
RUN = 10_000  # copies of a row that come back in one go


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def regular_tree(regions: int = 2, racks: int = 2, shards: int = 2) -> list[Shard]:
    """Equal weights; shards and racks are numbered through."""
    tree, rack, shard = [], 0, 0
    for region in range(regions):
        for _ in range(racks):
            for _ in range(shards):
                tree.append(Shard(region, rack, shard))
                shard += 1
            rack += 1
    return tree


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """``tree`` with one more shard in a region of its own."""
    new = Shard(*(max(getattr(s, level) for s in tree) + 1 for level in ("region", "rack", "shard")), weight)
    return [*tree, new]


def _draw(key: Column, level: str, name: int, weight: float) -> Column:
    digest = F.md5(F.concat(key, F.lit(f"/{level}/{name}")).cast("binary"))
    number = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
    return F.log((number + 0.5) / float(16**HASH_DIGITS)) / F.lit(weight)


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    draws = [
        F.struct(_draw(key, level, name, weight).alias("draw"), F.lit(-name).alias("name"))
        for name, weight in sorted(weights.items())
    ]
    return -F.array_max(F.array(*draws))["name"]


def _weights(tree: list[Shard], level: str, parent: str | None) -> dict[int | None, dict[int, float]]:
    found: dict[int | None, dict[int, float]] = {}
    for s in tree:
        if s.weight > 0:
            children = found.setdefault(getattr(s, parent) if parent else None, {})
            children[getattr(s, level)] = children.get(getattr(s, level), 0.0) + s.weight
    return found


def place(frame: DataFrame, key: Column, tree: list[Shard], name: str = "shard") -> DataFrame:
    """``frame`` with the integer column ``name``: the shard of ``key`` (a string; null counts as its own key).

    Shards of weight 0 get nothing; a tree without weight is an error. Columns
    of ``frame`` stay as they are, one called ``name`` excepted.
    """
    if not any(s.weight > 0 for s in tree):
        raise ValueError("the tree has no weight")
    key = F.coalesce(key, F.lit("null"))
    chosen, above = frame, None
    for level in ("region", "rack", "shard"):
        pick = None
        for parent, weights in _weights(tree, level, above).items():
            winner = _winner(key, level, weights)
            if parent is None:
                pick = winner
            else:
                inside = F.col(f"__{name}_{above}") == parent
                pick = F.when(inside, winner) if pick is None else pick.when(inside, winner)
        chosen, above = chosen.withColumn(f"__{name}_{level}", pick), level
    shard = F.col(f"__{name}_shard").cast("int")
    return chosen.withColumn(name, shard).drop(*(f"__{name}_{x}" for x in ("region", "rack", "shard")))


def number_slots(frame: DataFrame, order: list[Column], digest_of: Column) -> DataFrame:
    """``frame`` with ``slot``: numbers without a gap from 0 within each ``shard``.

    Rows are ordered by a bucket from the hash of ``digest_of`` and then by
    ``order``. Equal rows are counted first and take numbers in a row, so that
    a row of a third of all copies is one row for the sort; its copies come back
    by runs of ``RUN``, dealt to many tasks. Buckets are counted too, so that no
    task sorts a whole shard; the bucket offsets, at most 4,096 for each shard,
    are broadcast.
    """
    bucket = F.substring(F.md5(digest_of.cast("binary")), 1, SLOT_DIGITS)
    rows = stored(frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__bucket", bucket))
    counts = rows.groupBy("shard", "__bucket").agg(F.sum("__n").alias("__rows"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    earlier = Window.partitionBy("shard", "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    numbered = rows.withColumn("__inside", inside).join(F.broadcast(offsets), ["shard", "__bucket"])
    numbered = numbered.withColumn("__first", F.col("__offset") + F.col("__inside"))
    n = F.col("__n")
    once = numbered.where(n == 1).withColumn("slot", F.col("__first"))
    runs = numbered.where(n > 1).withColumn("__run", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / RUN))))
    runs = runs.repartition("shard", "__bucket", "__run")
    last = F.least(n, (F.col("__run") + 1) * RUN) - 1
    copies = runs.withColumn("__copy", F.explode(F.sequence(F.col("__run") * RUN, last))).withColumn("slot", F.col("__first") + F.col("__copy"))
    return once.select(*frame.columns, "slot").unionByName(copies.select(*frame.columns, "slot"))


def shard_documents(docs: DataFrame, tree: list[Shard] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as no bytes: size
    1, checksum 0. The id alone decides the shard, so equal ids share one and all
    null ids share one; their slots differ. Repeated rows get a slot each, one
    after the other. Texts may have any length; an empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    tree = tree or regular_tree()
    text = F.col("text").cast("binary")
    key = F.col("doc_id").cast("string")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = place(place(rows, key, tree), key, grown(tree), "grown_shard")
    digest_of = F.concat_ws("/", key, F.col("text_crc32").cast("string"), F.col("size").cast("string"))
    slots = number_slots(placed, [F.col(c).asc_nulls_first() for c in ("doc_id", "text_crc32", "size")], digest_of)
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
