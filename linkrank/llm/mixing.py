"""Mixing sources to target weights by hash thresholds, with column expressions only.

Every document has a 36-bit hash. Sizes are summed by source and the first 12
bits; the bucket in which a source's budget ends is split by the next 12 bits,
and the one in that by the last 12. The three bucket numbers are a threshold
for the hash, and documents are filtered by it: nothing is sorted, and each
refinement reads the boundary buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.common import WORD_PATTERN, stored

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
LEVELS, BITS = 3, 12
SALTS = 64  # a hot source meets its limits in so many tasks
ROW_BYTES, BROADCAST_BYTES = 100, 8 << 20


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in code-point order, null last, take ``weights`` in turn. Targets
    share the sum of all sizes by weight; one above ``max_repeats`` times its
    source stops there and the rest is shared again. With the sources ordered
    by cap / weight, those that stop are the first ones, so sums up to a source
    decide it. The table has one row for each source and is ordered in one task.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1)
    caps = totals.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_repeats).alias("cap"))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    later = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.col("caps_before")) / F.col("weights_from")
    placed = caps.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(earlier), F.lit(0)).alias("caps_before"),
        F.sum("weight").over(later).alias("weights_from"),
    ).withColumn("level", level)
    stops = placed.withColumn("stops", F.col("cap") <= F.col("level") * F.col("weight"))
    first_open = F.min_by(F.when(~F.col("stops"), F.col("level")), F.when(~F.col("stops"), F.col("cap") / F.col("weight")))
    shared = stops.withColumn("shared", first_open.over(everything))
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.col("shared") * F.col("weight"))
    return shared.select("source", "source_size", target.alias("target"))


def source_limits(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """What each source gives, from rows of ``source, size, hash``: a table with one row for each source.

    ``source_size, target``; ``whole``: how often the source is taken in full;
    ``prefix``: documents whose hash is below it are taken once more. The bucket
    of the last level is taken if that comes nearer to the target.
    """
    targets = source_targets(rows, weights, max_repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = targets.withColumn("whole", whole.cast("long"))
    budget = F.col("target") - F.col("whole") * F.col("source_size")
    limits = stored(state.withColumn("rest", budget).withColumn("prefix", F.lit(0).cast("long")))
    for level in range(LEVELS):
        limits = _refine(rows, limits, level)
    return limits


def with_copies(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` (``source, hash`` among their columns) with ``source_size, target, copies``.

    The limits are sent to the tasks if they take ``BROADCAST_BYTES`` at most;
    otherwise rows and limits meet by source and a salt from the hash.
    """
    copies = (F.col("whole") + (F.col("hash") < F.col("prefix")).cast("long")).alias("copies")
    named = limits.withColumnRenamed("source", "name")
    same = F.col("source").eqNullSafe(F.col("name"))
    used = limits.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    if used <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(named), same)
    else:
        salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = F.pmod(F.col("hash"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("spread", spread).join(salted, same & (F.col("spread") == F.col("salt")))
    return joined.select(*rows.columns, "source_size", "target", copies)


def _refine(rows: DataFrame, limits: DataFrame, level: int) -> DataFrame:
    """``limits`` with one more bucket number in ``prefix``; after the last level ``prefix`` is the threshold."""
    shift = BITS * (LEVELS - 1 - level)
    inside = rows
    if level:
        here = limits.select(F.col("source").alias("name"), "prefix")
        above = F.shiftright("hash", shift + BITS)
        inside = rows.join(here, F.col("source").eqNullSafe(F.col("name")) & (above == F.col("prefix"))).drop("prefix")
    bucket = F.shiftright("hash", shift)
    sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("bucket")
    running = sums.select(F.col("source").alias("name"), "bucket", "size", F.sum("size").over(upto).alias("upto"))
    over = running.join(limits, F.col("name").eqNullSafe(F.col("source"))).where(F.col("upto") > F.col("rest"))
    edge = over.groupBy("name").agg(
        F.min("bucket").alias("bucket"),
        F.min_by("upto", "bucket").alias("upto"),
        F.min_by("size", "bucket").alias("size"),
    )
    before = F.coalesce(F.col("upto") - F.col("size"), F.lit(0))
    past_all = (F.col("prefix") + 1) * F.lit(1 << BITS)  # no bucket ends the budget: all are below
    if level == LEVELS - 1:
        nearer = (F.col("upto") - F.col("rest") < F.col("rest") - before).cast("long")
        prefix = F.coalesce(F.col("bucket") + nearer, past_all)
    else:
        prefix = F.coalesce(F.col("bucket"), past_all)
    found = limits.join(edge, F.col("source").eqNullSafe(F.col("name")), "left")
    return stored(
        found.select("source", "source_size", "target", "whole", (F.col("rest") - before).alias("rest"), prefix.alias("prefix"))
    )


def words(text: Column) -> Column:
    """Number of words as a long; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """36 bits of the id's md5, or of the text's if the id is null."""
    name = F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary")), F.lit("null"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, LEVELS * BITS // 4), 16, 10).cast("long")


def _measured(docs: DataFrame) -> list[Column]:
    return ["source", words(F.col("text")).alias("size"), document_hash(F.col("doc_id"), F.col("text")).alias("hash")]


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``source, copies, hash`` for every row of ``docs``.

    ``taken`` is ``copies`` times the size in words. Null texts have size 0 and
    take 0 words; null sources are one source, the last; equal ids are taken or
    left together. A source without words has target 0.
    """
    rows = stored(docs.select("doc_id", *_measured(docs)))
    mixed = with_copies(rows, source_limits(rows, weights, max_repeats))
    taken = F.col("copies") * F.col("size")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "copies", "hash")


def mixed_corpus(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, with the columns of ``docs``."""
    rows = stored(docs.select(*_measured(docs)))
    limits = source_limits(rows, weights, max_repeats)
    held = docs.select(F.struct(*docs.columns).alias("document"), *_measured(docs)[::2])
    taken = with_copies(held, limits).where("copies > 0")
    repeated = taken.select("document", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select("document.*")
