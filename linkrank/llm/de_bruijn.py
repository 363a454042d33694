"""Removal of repeated passages with a De Bruijn graph of word k-mers.

Edges are windows of ``WINDOW`` words. An edge's minimizer, the smallest hash
among its runs of ``CORE`` words, is the same wherever the edge occurs, so a
shuffle by minimizer brings all occurrences of an edge together. Neighbouring
edges mostly share it and travel as one row with their coordinates.

1. A task looks at some megabytes of text: an edge that occurs earlier in them
   is repeated, and only its first occurrence travels. So an edge in a third of
   all documents is a row for each such piece of text, not for each document.
2. Rows are sorted by minimizer and source coordinates and read as a stream:
   what is not an edge's first occurrence is repeated. Memory holds a batch and
   the edges of one minimizer.
3. Repeated edges that follow each other while their first occurrences follow
   each other too are an unbranched path. Paths are compacted where they are
   found, and then across rows and tasks on (document, source, distance).
4. Paths are joined to the documents and their words taken out.

Window hashes have 56 bits and are only compared under equal 64-bit minimizers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.common import stored
from linkrank.llm.word_hashes import hash_words, mixed, runs, signed

WINDOW, CORE = 20, 6
PIECE_BYTES = 4 << 20
NO_ID = (1 << 63) - 1  # a null id sorts last
SIGN = np.int64(-(1 << 63))
HEAD, HASH_BYTES = 20, 7  # of a record: document, digest and start; each window's hash
COORDINATES = ["doc", "digest", "start", "size", "source_doc", "source_digest", "source_start"]
PATHS = ", ".join(f"{c} long" for c in COORDINATES)
EDGES = "key long, record binary"  # packed: the shuffle carries them for most of the text


def _breaks(*follows: np.ndarray) -> np.ndarray:
    """Starts of runs: places whose step from the place before is not as it should be."""
    first = np.ones(len(follows[0]) + 1, bool)
    first[1:] = ~np.logical_and.reduce(follows)
    return np.flatnonzero(first)


def _step(values: np.ndarray, by: int) -> np.ndarray:
    return values[1:] - values[:-1] == by


def _sortable(values: np.ndarray, n_bytes: int = 8) -> np.ndarray:
    """Rows of bytes that compare like the numbers."""
    kind, sign = (np.int64, SIGN) if n_bytes == 8 else (np.int32, np.int32(-(1 << 31)))
    return (values.astype(kind) ^ sign).byteswap().view(np.uint8).reshape(-1, n_bytes)


def _plain(data: np.ndarray, at: np.ndarray, n_bytes: int = 8) -> np.ndarray:
    """The numbers whose sortable bytes start at the places ``at``."""
    kind, sign = (np.int64, SIGN) if n_bytes == 8 else (np.int32, np.int32(-(1 << 31)))
    raw = np.ascontiguousarray(data[at[:, None] + np.arange(n_bytes)])
    return (raw.view(kind).ravel().byteswap() ^ sign).astype(np.int64)


def _path_batch(values: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], COORDINATES)


def _pack(key: np.ndarray, head: np.ndarray, tail: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """Rows of a key and a record: a row of ``head``, then ``sizes`` bytes of ``tail``."""
    width = head.shape[1]
    ends = np.cumsum(sizes + width)
    starts = ends - sizes - width
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    rest = np.ones(len(data), bool)
    places = (starts[:, None] + np.arange(width)).ravel()
    data[places] = head.ravel()
    rest[places] = False
    data[rest] = tail
    offsets = np.zeros(len(sizes) + 1, np.int32)
    offsets[1:] = ends
    record = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), record], ["key", "record"])


def _edges_of(doc: np.ndarray, digest: np.ndarray, texts: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of edges that occur first in these texts, and paths of those that do not."""
    order = np.lexsort((digest, doc))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(doc[order]) != 0) | (np.diff(digest[order]) != 0)
    order = order[new]
    doc, digest = doc[order], digest[order]
    words = hash_words([texts[i] for i in order])
    length = np.array([len(w) for w in words])
    flat = np.concatenate(words)
    if len(flat) < WINDOW:
        return
    hashes = runs(flat, WINDOW)
    n = len(hashes)
    core = runs(flat, CORE)
    smallest = core[:n].copy()
    for j in range(1, WINDOW - CORE + 1):
        np.minimum(smallest, core[j : j + n], out=smallest)
    owner = np.repeat(np.arange(len(words)), length)
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    if not len(inside):
        return
    starts = np.concatenate([[0], np.cumsum(length)[:-1]])
    owner = owner[inside]
    place = inside - starts[owner]
    hashes, smallest = hashes[inside], smallest[inside]
    repeated, first = _first_seen(hashes)
    # In a loop of one word an edge follows itself; its source is the place before.
    loop = np.flatnonzero((hashes[1:] == hashes[:-1]) & (_step(owner, 0)) & (_step(place, 1))) + 1
    first[loop] = loop - 1
    again = np.flatnonzero(repeated)
    source = first[again]
    if len(again):
        at = _breaks(_step(owner[again], 0), _step(place[again], 1), _step(owner[source], 0), _step(place[source], 1))
        size = np.diff(np.append(at, len(again)))
        own, src = again[at], source[at]
        # A path that is known already has a negative start.
        numbers = [size, doc[owner[src]], digest[owner[src]], place[src]]
        head = [_sortable(doc[owner[own]]), _sortable(digest[owner[own]]), _sortable(~place[own], 4), *map(_sortable, numbers)]
        spread = mixed(doc[owner[own]].view(np.uint64) * np.uint64(31) + place[own].astype(np.uint64))
        yield _pack(signed(spread), np.hstack(head), np.zeros(0, np.uint8), np.zeros(len(at), np.int64))
    here = np.flatnonzero(~repeated)
    at = _breaks(_step(owner[here], 0), _step(place[here], 1), smallest[here][1:] == smallest[here][:-1])
    size = np.diff(np.append(at, len(here)))
    own = here[at]
    head = [_sortable(doc[owner[own]]), _sortable(digest[owner[own]]), _sortable(place[own], 4)]
    tail = hashes[here].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].ravel()
    yield _pack(signed(smallest[own]), np.hstack(head), tail, size * HASH_BYTES)


def _first_seen(hashes: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Whether an equal hash (of the same group) stands earlier, and where the first one stands."""
    order = np.argsort(hashes, kind="stable") if group is None else np.lexsort((hashes, group))
    same = np.zeros(len(order), bool)
    same[1:] = hashes[order][1:] == hashes[order][:-1]
    if group is not None:
        same[1:] &= group[order][1:] == group[order][:-1]
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    repeated, first = np.empty(len(order), bool), np.empty(len(order), np.int64)
    repeated[order], first[order] = same, order[leader]
    return repeated, first


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, digest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "digest"))
        texts = batch.column("text").to_pylist()
        start = held = 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= PIECE_BYTES or i == len(texts) - 1:
                yield from _edges_of(doc[start : i + 1], digest[start : i + 1], texts[start : i + 1])
                start, held = i + 1, 0


class _Seen:
    """First occurrences of the edges under the minimizer at which a batch ended."""

    def __init__(self) -> None:
        self.key: int | None = None
        self.hashes = np.zeros(0, np.uint64)
        self.where = np.zeros((0, 3), np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros((len(hashes), 3), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, self.where[at]

    def add(self, key: int, hashes: np.ndarray, where: np.ndarray) -> None:
        if key == self.key:
            hashes, where = np.concatenate([self.hashes, hashes]), np.concatenate([self.where, where])
        order = np.argsort(hashes)
        self.key, self.hashes, self.where = key, hashes[order], where[order]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of repeated edges from rows sorted by key and coordinates; paths found before pass through."""
    seen = _Seen()
    for batch in batches:
        record = batch.column("record")
        if not len(record):
            continue
        offsets = np.frombuffer(record.buffers()[1], np.int32)[record.offset : record.offset + len(record) + 1].astype(np.int64)
        data = np.frombuffer(record.buffers()[2], np.uint8, int(offsets[-1]))
        begin, keys = offsets[:-1], batch.column("key").to_numpy(zero_copy_only=False)
        doc, digest, start = _plain(data, begin), _plain(data, begin + 8), _plain(data, begin + 16, 4)
        known = start < 0
        if known.any():
            numbers = [_plain(data, begin[known] + HEAD + 8 * i) for i in range(4)]
            yield _path_batch([doc[known], digest[known], ~start[known], *numbers])
        here = np.flatnonzero(~known)
        if not len(here):
            continue
        size = (np.diff(offsets)[here] - HEAD) // HASH_BYTES
        row = np.repeat(here, size)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        padded = np.zeros((len(row), 8), np.uint8)
        padded[:, :HASH_BYTES] = data[(begin[row] + HEAD + HASH_BYTES * inside)[:, None] + np.arange(HASH_BYTES)]
        hashes = padded.view(np.uint64).ravel()
        key = keys[row]
        where = np.stack([doc[row], digest[row], start[row] + inside], axis=1)
        repeated, first = _first_seen(hashes, key)
        source = where[first]
        if seen.key is not None and (carried := np.flatnonzero(key == seen.key)).size:
            found, before = seen.find(hashes[carried])
            repeated[carried[found]] = True
            source[carried[found]] = before[found]
        fresh = ~repeated & (key == key[-1])
        seen.add(int(key[-1]), hashes[fresh], where[fresh])
        repeated &= (where != source).any(axis=1)  # the same row of the input twice is one occurrence
        again = np.flatnonzero(repeated)
        if not len(again):
            continue
        own, src = where[again], source[again]
        steps = [_step(a[:, c], 1 if c == 2 else 0) for a in (own, src) for c in range(3)]
        at = _breaks(*steps)
        size = np.diff(np.append(at, len(again)))
        own, src = own[at], src[at]
        yield _path_batch([own[:, 0], own[:, 1], own[:, 2], size, src[:, 0], src[:, 1], src[:, 2]])


def repeated_paths(texts: DataFrame) -> DataFrame:
    """Maximal repeated paths of ``doc, digest, text`` (``text`` not null): ``COORDINATES``.

    Words ``start`` to ``start + size + WINDOW - 1`` of a document also stand at
    ``source_start`` of the source, which comes earlier. ``digest`` tells
    documents of one id apart. Records sort by document and place, so the
    first occurrence of an edge comes first.
    """
    edges = texts.mapInArrow(_edges, EDGES)
    dealt = edges.repartition("key").sortWithinPartitions("key", "record")
    pieces = stored(dealt.mapInArrow(_paths, PATHS))
    distance = F.col("start") - F.col("source_start")
    line = Window.partitionBy("doc", "digest", "source_doc", "source_digest", "distance").orderBy("start", "size")
    reached = F.max(F.col("start") + F.col("size")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("start") > F.col("reached"), F.lit(True)).cast("long")
    numbered = (
        pieces.withColumn("distance", distance)
        .withColumn("reached", reached)
        .withColumn("path", F.sum(starts).over(line))
    )
    path = numbered.groupBy("doc", "digest", "source_doc", "source_digest", "distance", "path").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("stop")
    )
    return path.select(
        "doc", "digest", "start", (F.col("stop") - F.col("start")).alias("size"), "source_doc", "source_digest",
        (F.col("start") - F.col("distance")).alias("source_start"),
    )


def _kept(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for text, starts, sizes in batches:
        rows = []
        for value, at, n in zip(text, starts, sizes, strict=True):
            words = value.encode("utf-8", "replace").split() if value else []  # splits at the six white-space bytes
            total = len(words)
            if at is not None and len(at):
                change = np.zeros(total + 1, np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, np.asarray(at) + n + (WINDOW - 1), -1)
                gone = np.cumsum(change[:-1]) > 0
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            kept = b" ".join(words)
            rows.append((total, total - len(words), kept.decode("utf-8")))
        yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs``.

    A word goes if a window of ``WINDOW`` words that covers it also starts
    earlier: in a document of smaller id (null ids last; equal ids in the order
    of their texts' hashes) or further up. ``kept`` is the other words with
    single blanks. Null and empty texts have no words. A row that stands in the
    table twice is one document, and both rows get its result.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")
    rows = docs.select("doc_id", doc, F.xxhash64("text").alias("digest"), "text")
    shared = rows.groupBy("doc").agg((F.min("digest") != F.max("digest")).alias("shared")).where("shared")
    if shared.isEmpty():
        rows = rows.withColumn("digest", F.lit(0).cast("long"))  # ids alone tell the texts apart
    paths = repeated_paths(rows.where("text is not null").select("doc", "digest", "text"))
    by_doc = paths.groupBy("doc", "digest").agg(F.collect_list(F.struct("start", "size")).alias("paths"))
    kept = F.pandas_udf(_kept, "n_words long, n_removed long, kept string")
    joined = rows.join(by_doc, ["doc", "digest"], "left")
    result = joined.select("doc_id", kept("text", F.col("paths.start"), F.col("paths.size")).alias("r"))
    return result.select("doc_id", "r.*")
