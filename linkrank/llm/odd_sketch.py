"""Near-duplicate documents: banded MinHash, checked with odd sketches and on full sets.

1. Each document's shingle set gives ``SAMPLES`` MinHash values. Runs of ``ROWS``
   of them are the keys of bands; folded by parity into ``BITS`` bits, all of
   them are an odd sketch. The ones in the XOR of two sketches estimate the
   similarity, precisely where it is high.
2. Equal sets are one class, so copies cost nothing from here on.
3. Classes that share a band key are tied to one of them, the pivot, never to
   each other, and ties whose sketches differ too much are cut. The components
   of the ties are groups: two sets at the threshold miss each other's group
   with a chance of about (1 - 0.85**6)**40 = 6e-9.
4. Each class is compared with its nearest pivot and up to ``BLOCK`` other classes
   of that pivot, on full sets. What is linked so far is a part of its group; a
   group of near copies is mostly one part after that.
5. Pairs of different parts of a group are compared by sketches. The largest part
   and the other classes are split into blocks of ``BLOCK``, each pair of blocks
   but those within the largest part is a task of its own, so no task holds a
   group. Only classes that may have a link there are sent their texts, and their
   full sets decide. A task returns a spanning forest of its links, not the links.
6. Components of all links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import Shelf, connected_components, stored
from linkrank.llm.word_hashes import hash_words, mixed, shingle_set, signed
from linkrank.session import collect_garbage, smaller_broadcasts

SHINGLE = 5
BANDS, ROWS = 40, 6
SAMPLES = BANDS * ROWS
BITS = 512
TIE, MAY_LINK = 0.5, 0.6  # estimates below are cut; a link's is about 0.85 with a deviation of 0.03
LEAST_PERCENT = 80  # what bands and cuts are made for; below, links would be cut unseen
BLOCK = 512
BIN_ROWS = 256
# A table that joins broadcast passes the driver and stays there until its garbage is collected; a run has dozens.
BROADCAST_BYTES = 256 << 10
COLUMNS = 4096
_RANDOM = np.random.default_rng(8)
FACTORS = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
TASK = "component long, first int, second int, node long, part long, block int, sketch array<long>"
FEATURES = "doc_id long, digest long, n_shingles long, high long, low long, bands array<long>, sketch array<long>"


def most_bits(similarity: float) -> int:
    """Expected ones in the XOR of two sketches at ``similarity``."""
    return round(BITS / 2 * (1 - exp(-2 * 2 * SAMPLES * (1 - similarity) / BITS)))


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """``SAMPLES`` smallest hashes of each nonempty set."""
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    found = np.empty((len(sets), SAMPLES), np.uint64)
    for j in range(SAMPLES):
        found[:, j] = np.minimum.reduceat(values * FACTORS[j] + OFFSETS[j], starts)
    return found


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(len(samples), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(samples), 1), np.uint64)
    for r in range(ROWS):
        key = mixed(key + rows[:, :, r])
    return signed(key)


def fold(samples: np.ndarray) -> np.ndarray:
    """Odd sketches: every sample flips one of ``BITS`` bits. Eight longs each."""
    place = mixed(samples + np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(BITS)
    bits = np.zeros((len(samples), BITS), np.uint8)
    row = np.arange(len(samples))
    for j in range(SAMPLES):
        bits[row, place[:, j]] ^= 1
    return np.packbits(bits, axis=1).view(np.int64)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for whole in batches:
        for batch in (whole.iloc[i : i + 500] for i in range(0, len(whole), 500)):
            sets = [shingle_set(w, SHINGLE) for w in hash_words([t or "" for t in batch["text"]], lower=True)]
            filled = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [[] for _ in sets]
            sketch: list = [[] for _ in sets]
            high, low = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
            if filled:
                chosen = [sets[i] for i in filled]
                samples = minhash(chosen)
                for i, keys, bits in zip(filled, band_keys(samples).tolist(), fold(samples).tolist(), strict=True):
                    bands[i], sketch[i] = keys, bits
                starts = np.cumsum([0] + [len(s) for s in chosen[:-1]])
                values = np.concatenate(chosen)
                high[filled] = signed(np.add.reduceat(mixed(values), starts))
                low[filled] = signed(np.add.reduceat(mixed(values + np.uint64(1)), starts))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].to_numpy(),
                    "digest": batch["digest"].to_numpy(),
                    "n_shingles": [len(s) for s in sets],
                    "high": high,
                    "low": low,
                    "bands": bands,
                    "sketch": sketch,
                }
            )


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, counted on the shingles that occur more than once."""
    m = len(sets)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((m, m), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        dense = np.zeros((m, min(COLUMNS, int(shared.sum()) - first)), np.float32)
        dense[row[a:b], column[a:b] - first] = 1
        total += dense @ dense.T
    return total


def _roots(links: np.ndarray) -> np.ndarray:
    """Smallest index that each index reaches over a symmetric link matrix."""
    label = np.arange(len(links))
    while True:
        best = np.where(links, label[None, :], len(links)).min(axis=1)
        new = np.minimum(label, best)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def may_link(part: np.ndarray, block: np.ndarray, sketch: list) -> np.ndarray:
    """Which pairs of rows of one or two blocks lie in different parts and have sketches of a possible link."""
    bits = np.unpackbits(np.array(sketch, np.int64).view(np.uint8).reshape(len(part), -1), axis=1).astype(np.float32)
    ones = bits.sum(axis=1)
    differing = ones[:, None] + ones[None, :] - 2 * (bits @ bits.T)
    may = (differing <= most_bits(MAY_LINK)) & (part[:, None] != part[None, :])
    if len(set(block.tolist())) > 1:
        may &= block[:, None] != block[None, :]  # pairs within a block belong to the task of that block
    return may


def block_links(
    node: np.ndarray, part: np.ndarray, block: np.ndarray, sketch: list, texts: list[str], percent: int
) -> list[tuple[int, int]]:
    """A spanning forest of the links between the rows of one or two blocks."""
    may = may_link(part, block, sketch)
    rows = np.flatnonzero(may.any(axis=1))
    if not len(rows):
        return []
    sets = [shingle_set(w, SHINGLE) for w in hash_words([texts[i] for i in rows], lower=True)]
    size = np.array([len(s) for s in sets])
    overlap = _overlaps(sets).astype(np.int64)
    links = may[np.ix_(rows, rows)] & (100 * overlap >= percent * (size[:, None] + size[None, :] - overlap))
    root = _roots(links)
    names = node[rows]
    return [(int(names[i]), int(names[r])) for i, r in enumerate(root) if r != i]


def _tasks(group: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, task in group.groupby(["component", "first", "second"], sort=False):
        task = task.drop_duplicates("node")
        if len(task) > 1:
            yield task


def _linker(percent: int):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        edges: list[tuple[int, int]] = []
        for task in _tasks(group):
            numbers = (task[c].to_numpy() for c in ("node", "part", "block"))
            edges += block_links(*numbers, list(task["sketch"]), list(task["text"]), percent)
        return pd.DataFrame(edges, columns=["a", "b"])

    return link


def _survivors(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of each task that may have a link in it."""
    found = [
        task[may_link(task["part"].to_numpy(), task["block"].to_numpy(), list(task["sketch"])).any(axis=1)]
        for task in _tasks(group)
    ]
    return pd.concat([group.iloc[:0], *found])


def _binned(tasks: DataFrame) -> DataFrame:
    """``tasks`` with a ``bin`` for each of its tasks, about ``BIN_ROWS`` rows in each bin."""
    bins = max(1, tasks.count() // BIN_ROWS)
    return tasks.withColumn("bin", F.pmod(F.xxhash64("component", "first", "second"), F.lit(bins)))


def _links(shelf: Shelf, tasks: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links found by ``tasks`` of ``component, first, second, node, part, block, sketch``."""
    texts = rows.select(F.col("doc_id").alias("id"), F.col("digest").alias("of_text"), "text")
    of_class = classes.select("node", "doc_id", "digest")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of_text"))
    with_text = _binned(tasks).join(of_class, "node").join(texts, same).drop("doc_id", "digest", "id", "of_text")
    return shelf.stored(with_text.groupBy("bin").applyInPandas(_linker(percent), "a long, b long"))


def _pivots(shelf: Shelf, classes: DataFrame, ties: DataFrame) -> DataFrame:
    """Tasks that compare each class with its nearest pivot and others of that pivot."""
    nearest = ties.groupBy(F.col("a").alias("node")).agg(F.min(F.struct("differing", F.col("b").alias("pivot"))).alias("n"))
    near = nearest.select("node", F.col("n.pivot").alias("component"))
    sizes = near.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    others = near.join(sizes, "component").select(
        "component", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("first"), "node"
    )
    itself = sizes.select(
        "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("first"), F.col("component").alias("node")
    )
    tasks = others.unionByName(itself).join(classes.select("node", "sketch"), "node")
    first = F.col("first")
    return shelf.stored(
        tasks.select("component", "first", first.alias("second"), "node", F.col("node").alias("part"), first.alias("block"), "sketch")
    )


def _across_parts(shelf: Shelf, classes: DataFrame, groups: DataFrame, linked: DataFrame) -> DataFrame:
    """Tasks that compare the classes of different parts of a group, with the rows that may have a link there.

    The largest part has blocks of its own, after those of all others: pairs
    within it need no task. A group of one part gives no tasks at all.
    """
    parts = groups.join(linked.withColumnRenamed("component", "of_part"), "node", "left").select(
        "component", "node", F.coalesce("of_part", "node").alias("part")
    )
    counts = parts.groupBy("component", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("component").agg(
        F.max(F.struct("n", "part")).alias("main"), (F.sum("n") - F.max("n")).alias("n_others")
    )
    sizes = sizes.where("n_others > 0").select(
        "component",
        F.col("main.part").alias("main"),
        F.ceil(F.col("main.n") / BLOCK).cast("int").alias("main_blocks"),
        F.ceil(F.col("n_others") / BLOCK).cast("int").alias("blocks"),
    )
    in_main = F.col("part") == F.col("main")
    placed = parts.join(sizes, "component").join(classes.select("node", "sketch"), "node")
    placed = placed.withColumn(
        "block",
        F.when(in_main, F.col("blocks") + F.pmod(F.xxhash64("node"), F.col("main_blocks")))
        .otherwise(F.pmod(F.xxhash64("node"), F.col("blocks")))
        .cast("int"),
    )
    last = F.when(in_main, F.col("blocks")).otherwise(F.col("blocks") + F.col("main_blocks")) - 1
    members = placed.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    tasks = shelf.stored(
        members.select(
            "component", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
            "node", "part", "block", "sketch",
        )
    )
    return shelf.stored(_binned(tasks).groupBy("bin").applyInPandas(_survivors, f"{TASK}, bin long").drop("bin"))


def _ties(shelf: Shelf, classes: DataFrame) -> DataFrame:
    """``a, b, differing``: a class and the pivot of a band they share, with sketches that are alike."""
    keyed = classes.select("node", F.explode("bands").alias("band"))
    pivots = keyed.groupBy("band").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = shelf.stored(keyed.join(pivots, "band").where("node <> pivot").select("node", "pivot").distinct())
    sketches = classes.select("node", "sketch")
    of_pivot = sketches.select(F.col("node").alias("pivot"), F.col("sketch").alias("other"))
    differing = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("other")[i])) for i in range(BITS // 64)), F.lit(0))
    alike = pairs.join(sketches, "node").join(of_pivot, "pivot").withColumn("differing", differing)
    alike = alike.where(F.col("differing") <= most_bits(TIE))
    return shelf.stored(alike.select(F.col("node").alias("a"), F.col("pivot").alias("b"), "differing"))


def components(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, digest, n_shingles, component, component_id`` for every row of ``docs``.

    ``digest`` is the text's xxhash64 and with the id tells rows apart;
    ``component`` is a number for each group of linked documents, null for texts
    without words. The rest is as in ``near_duplicates``.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent is {percent}; bands and sketches are made for {LEAST_PERCENT} or more")
    with smaller_broadcasts(docs.sparkSession, BROADCAST_BYTES):
        return _components(docs, percent)


def _components(docs: DataFrame, percent: int) -> DataFrame:
    shelf = Shelf()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    features = shelf.stored(rows.mapInPandas(_features, FEATURES))
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    grouped = (
        features.where("n_shingles > 0")
        .groupBy("high", "low", "n_shingles")
        .agg(F.min(named).alias("first"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    )
    classes = shelf.stored(
        grouped.select("high", "low", "n_shingles", "first.doc_id", "first.digest", "bands", "sketch").withColumn(
            "node", F.monotonically_increasing_id()
        )
    )
    ties = _ties(shelf, classes)
    collect_garbage(docs.sparkSession)
    pairs = _links(shelf, _pivots(shelf, classes, ties), classes, rows, percent)
    collect_garbage(docs.sparkSession)
    linked = shelf.taken(connected_components(pairs))
    groups = shelf.taken(connected_components(ties.select("a", "b")))
    across = _across_parts(shelf, classes, groups, linked)
    collect_garbage(docs.sparkSession)
    if not across.isEmpty():
        known = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
        more = _links(shelf, across, classes, rows, percent)
        linked = shelf.taken(connected_components(known.unionByName(more)))
    result = classes.select("node", "high", "low", "n_shingles", F.col("doc_id").alias("smallest"))
    reached = linked.join(result, "node").groupBy("component").agg(F.min("smallest").alias("component_id"))
    by_node = linked.join(reached, "component").select("node", "component", "component_id")
    alone = F.col("component").isNull()
    final = shelf.stored(
        result.join(by_node, "node", "left").select(
            "high",
            "low",
            "n_shingles",
            F.coalesce("component", "node").alias("component"),
            F.when(alone, F.col("smallest")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )
    named_rows = features.select("doc_id", "digest", "high", "low", "n_shingles").join(final, ["high", "low", "n_shingles"], "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return shelf.last(named_rows.select("doc_id", "digest", "n_shingles", "component", component_id.alias("component_id")))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    sets of 5-word shingles (fewer words: one shingle). ``component_id`` is the
    smallest id that links reach; null ids count only if there is no other.
    Null, empty and blank texts are linked with nothing: their component is
    their own id. ``kept`` is whether the id is the component's. Repeated rows
    are kept and get the same result; other columns are ignored.
    """
    found = components(docs, percent).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each group of linked documents, with the columns of ``docs``.

    The row of the smallest id stays; of equal or null ids, that of the smaller
    text hash. Rows equal in id and text are one document. Texts without words stay.
    """
    found = components(docs, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest"))
    chosen = found.where("component is not null").groupBy("component").agg(first.alias("first"))
    kept = chosen.select("first.doc_id", "first.digest").unionByName(
        found.where("component is null").select("doc_id", "digest").distinct()
    )
    keys = stored(kept.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("unnamed"), F.coalesce("digest", F.lit(0)).alias("digest")))
    id_ = F.col("doc_id").cast("long")
    rows = docs.select(
        F.coalesce(id_, F.lit(0)).alias("id"),
        id_.isNull().alias("unnamed"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("digest"),
        F.struct(*docs.columns).alias("document"),
    )
    names = ["id", "unnamed", "digest"]
    return rows.join(keys, names, "left_semi").dropDuplicates(names).select("document.*")
