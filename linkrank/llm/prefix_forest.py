"""Nearest neighbours by largest inner product with a forest of hash-prefix trees.

Each tree gives a vector a string of ``BITS`` signs of random projections; the
longer the prefix two strings share, the nearer their vectors are likely to be.
To make inner products cosines, every vector is divided by the largest norm and
gets one more component that brings its length to 1 (0 in a query).

Rows are dealt into shards by a hash, so copies and groups of like vectors of
any size are spread evenly. A shard holds its rows' components once, and for
each tree the sorted array of their strings with the places of the rows; trees
carry strings and places only. A search goes through all shards twice:

1. A query descends every tree of a shard to its longest prefix match, whose
   length differs from tree to tree, and ascends the trees together, a sign at
   a time, until their ranges hold ``enough`` places. The best rows of the
   ranges are merged over the shards. That is where a query starts, not a
   promise.
2. The chance that two strings share a sign depends on the cosine only. So the
   ``k``-th cosine found, which is never above the true one, tells how far the
   trees must be ascended for a row at that cosine to share the query's prefix
   in some tree with a chance of ``CHANCE``. All shards are searched to that
   height, and the best rows of all ranges are merged. A query that has found
   fewer than ``k``, or whose ranges would hold half of all rows anyway,
   ascends to the root, which compares all rows.

The last level need not be ascended in all trees: a height is the sum of the
prefix lengths of all trees. This holds for every size of table and every kind
of vectors. Every row is indexed, nothing is fitted and no range is cut short.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.common import Shelf

TREES, BITS = 64, 32
ENOUGH = 512
CHANCE, SHARE = 0.9, 0.5
K = 20
# What a task takes of rows and of queries at most; small tables have this many shards.
SHARD_ROWS, BLOCK_QUERIES, TASK_BYTES, FEWEST_SHARDS = 65_536, 16_384, 32 << 20, 12
CHUNK = 4_096
# Single precision moves a cosine by less than this for each component.
ROUNDING = 1.2e-7
FOUND = "query_id long, vec_id long, score double"


@lru_cache(maxsize=2)
def projections(size: int) -> np.ndarray:
    """Directions of all signs of all trees, for vectors of ``size`` components."""
    return np.random.default_rng([3, size]).standard_normal((size, TREES * BITS), np.float32)


def strings(unit: np.ndarray) -> np.ndarray:
    """The strings of vectors of length 1, by tree and vector; the first sign is the highest bit."""
    found = np.empty((TREES, len(unit)), np.uint32)
    for at in range(0, len(unit), CHUNK):
        signs = unit[at : at + CHUNK].astype(np.float32) @ projections(unit.shape[1]) > 0
        packed = np.packbits(signs.reshape(-1, TREES, BITS), axis=2)
        found[:, at : at + CHUNK] = packed.view(">u4")[:, :, 0].T
    return found


def lengths(height: np.ndarray | int) -> np.ndarray:
    """Prefix length of every tree (last axis) at a height, which is their sum."""
    return (np.asarray(height)[..., None] + np.arange(TREES)) // TREES


def chance(cosine: np.ndarray | float, height: np.ndarray | int) -> np.ndarray:
    """Chance that a row at ``cosine`` of a query shares its prefix in one tree at least, at a height."""
    shared = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi
    return 1 - np.prod(1 - np.asarray(shared)[..., None] ** lengths(height), axis=-1)


def height_for(cosine: np.ndarray) -> np.ndarray:
    """The greatest height with a chance of ``CHANCE`` at each cosine.

    0, the root, where the cosine is unknown or the ranges would hold ``SHARE``
    of the rows that have nothing to do with the query (cosine 0) anyway.
    """
    known = np.isfinite(cosine)
    safe = np.where(known, cosine, 0.0)
    low, high = np.zeros(len(safe), int), np.full(len(safe), TREES * BITS)
    while (low < high).any():
        middle = (low + high + 1) // 2
        reached = chance(safe, middle) >= CHANCE
        low, high = np.where(reached, middle, low), np.where(reached, high, middle - 1)
    return np.where(known & (chance(0.0, low) < SHARE), low, 0)


class Shard:
    """Sorted strings of the rows of a shard, for all trees."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float) -> None:
        self.ids, self.vectors = ids, vectors
        self.single = len(np.unique(ids)) == len(ids)
        unit = vectors / largest
        self.rough = unit.astype(np.float32)
        extra = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1, keepdims=True)))
        codes = strings(np.hstack([unit, extra]))
        self.order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        self.codes = np.take_along_axis(codes, self.order, axis=1)

    def ranges(self, asked: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end in every tree's array (first axis) of the prefixes of queries."""
        free = np.uint64(BITS) - length.astype(np.uint64)
        low = (asked.astype(np.uint64) >> free) << free
        high = low + (np.uint64(1) << free) - np.uint64(1)
        start, end = np.empty(asked.shape, np.int64), np.empty(asked.shape, np.int64)
        for t, codes in enumerate(self.codes):
            start[t] = np.searchsorted(codes, low[t].astype(np.uint32), side="left")
            end[t] = np.searchsorted(codes, high[t].astype(np.uint32), side="right")
        return start, end

    def longest(self, asked: np.ndarray) -> np.ndarray:
        """Length of the longest prefix that each query shares with a row, by tree and query."""
        found = np.empty(asked.shape, np.int64)
        for t, codes in enumerate(self.codes):
            at = np.searchsorted(codes, asked[t])
            beside = [codes[np.clip(at + step, 0, len(codes) - 1)] ^ asked[t] for step in (-1, 0)]
            # The exponent of a difference is the number of its bits.
            found[t] = BITS - np.frexp(np.minimum(*beside).astype(np.float64))[1]
        return found

    def start(self, asked: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranges after the synchronous ascent from the longest prefix matches."""
        own = self.longest(asked)
        depth = own.max(axis=0)
        start, end = self.ranges(asked, np.minimum(own, depth))
        open_ = np.flatnonzero((end - start).sum(axis=0) < enough)
        while len(open_):
            depth[open_] -= 1
            some = np.minimum(own[:, open_], depth[open_])
            start[:, open_], end[:, open_] = self.ranges(asked[:, open_], some)
            held = (end[:, open_] - start[:, open_]).sum(axis=0)
            open_ = open_[(held < enough) & (depth[open_] > 0)]
        return start, end

    def best(self, query_id: int, vector: np.ndarray, start: np.ndarray, end: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows of a query's ranges, one for each id."""
        reached = np.zeros(len(self.ids), bool)
        spans = [order[a:b] for order, a, b in zip(self.order, start.tolist(), end.tolist(), strict=True) if a < b]
        if spans:
            reached[np.concatenate(spans)] = True
        reached[self.ids == query_id] = False
        rows = np.flatnonzero(reached)
        if self.single and len(rows) > k:
            near = self.rough[rows] @ (vector / np.linalg.norm(vector)).astype(np.float32)
            slack = 2 * ROUNDING * (len(vector) + 4)
            rows = rows[near >= np.partition(near, -k)[-k] - slack]
        # Equal vectors must have equal scores, so the sum is taken row by row.
        score = (self.vectors[rows] * vector).sum(axis=1)
        ids = self.ids[rows]
        order = np.lexsort((ids, -score))
        if not self.single:
            order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
        return ids[order[:k]], score[order[:k]]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _searched(largest: float, k: int, enough: int):
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """The best rows of one shard for a block of queries; ``height`` is null in the first search."""
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        shard = Shard(rows["vec_id"].to_numpy(), _matrix(rows["embedding"]), largest)
        parts = []
        for at in range(0, len(queries), CHUNK):
            some = queries.iloc[at : at + CHUNK]
            x = _matrix(some["embedding"])
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            asked = strings(np.hstack([unit, np.zeros((len(x), 1))]))
            if some["height"].isna().any():
                start, end = shard.start(asked, enough)
            else:
                start, end = shard.ranges(asked, lengths(some["height"].to_numpy(np.int64)).T)
            for i, query_id in enumerate(some["query_id"].tolist()):
                ids, score = shard.best(query_id, x[i], start[:, i], end[:, i], k)
                parts.append((np.full(len(ids), query_id), ids, score))
        return pd.DataFrame({c: np.concatenate(v) for c, v in zip(("query_id", "vec_id", "score"), zip(*parts, strict=True), strict=True)})

    return search


def heights(cosine: Column) -> Column:
    @F.pandas_udf("int")
    def found(cosine: pd.Series) -> pd.Series:
        return pd.Series(height_for(cosine.to_numpy(np.float64, na_value=np.nan)), dtype="int32")

    return found(cosine)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, enough: int = ENOUGH) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows found for each row of ``queries``.

    Both tables have ``vec_id`` and ``embedding``; others of their columns are
    ignored. A row is no candidate for a query of its own id. Rows with a null
    id or a vector that is null, empty, zero or not finite take no part. Vectors
    are compared with those of equal length only. Repeated rows count once, and
    rows of one id count as one, with their best score; equal scores go by id.
    Fewer than ``k`` candidates are all returned; an empty table gives no rows.
    Each of the true ``k`` is found with a chance of ``CHANCE`` or more;
    ``enough`` only says where queries start.
    """
    shelf = Shelf()
    usual = lambda t: t.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    )
    rows = shelf.stored(usual(vectors).distinct())
    asked = shelf.stored(usual(queries).distinct().withColumnRenamed("vec_id", "query_id"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    extent = [F.count(F.lit(1)), F.coalesce(F.sum(F.size("embedding")), F.lit(0)) * 8]
    parts = lambda n, size, most: max(-(-n // most), -(-size // TASK_BYTES))
    largest, *held = rows.agg(F.max(norm), *extent).first()
    largest = largest or 1.0
    shards = max(FEWEST_SHARDS, parts(*held, SHARD_ROWS))
    blocks = max(1, parts(*asked.agg(*extent).first(), BLOCK_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    key = ["dims", "shard", "block"]
    dealt = rows.select(
        F.size("embedding").alias("dims"), spread(shards, "vec_id", "embedding").alias("shard"), every(blocks).alias("block"),
        "vec_id", "embedding",
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def searched(asking: DataFrame) -> DataFrame:
        sent = asking.select(
            F.size("embedding").alias("dims"), every(shards).alias("shard"), spread(blocks, "query_id", "embedding").alias("block"),
            "query_id", "embedding", "height",
        )
        # Both sides may come from one table; new columns tell them apart.
        left, right = (side.select(*[F.col(c).alias(c) for c in side.columns]) for side in (dealt, sent))
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_searched(largest, k, enough), FOUND)
        merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = searched(asked.withColumn("height", F.lit(None).cast("int")))
    last = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("last"))
    # One id may ask with several vectors; each goes to its own height.
    cosine = F.col("last") / (norm * F.lit(largest))
    asking = shelf.stored(asked.join(last, "query_id", "left").select("query_id", "embedding", heights(cosine).alias("height")))
    return shelf.last(searched(asking).select("query_id", "rank", "vec_id", "score"))
