"""Cross-tokenizer alignment with an identity map as the fast path.

Two tokenizers A (byte-level, .json) and B (pieces with byte fallback, .model)
cut the bytes of a blank and a text. Where tokens of both end, a group ends.
Tokens of both sides that share bytes are linked.

Most groups are one token of either side with the same bytes. For each A id the
B id of the same bytes is looked up beforehand (``identity``), so these groups
are counted in a vector as long as A's vocabulary. Only the links of other,
irregular groups go as id pairs through a shuffle.

Texts are cut into units that both tokenizers treat one by one (``units``), so
a task encodes and aligns every unit once, in a bounded table. One pass writes,
for each document, its distinct links with their counts, and sums of the links
for each task. The corpus-wide counts of links then come back two ways: those
of same bytes and the most frequent others as vectors (bounded by the
vocabulary and by ``HEAD``), all others by a join on the pair, in which no pair
has more links than the least frequent one of the vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import Shelf
from linkrank.llm.token_counts import byte_level_entries, calls, cuts_at_blanks, json_tokenizer
from linkrank.llm.units import Bounded, slices, units

CALL_CHARS = 1 << 18
HEAD = 1 << 18  # pairs whose counts are sent to the tasks
TASK_PAIRS = 1 << 20  # distinct irregular links whose counts a task holds before it passes them on
PIECE_BLANK = "▁"

ROWS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " same array<int>, same_n array<int>, pair array<long>, pair_n array<long>"
)


@dataclass
class Vocabularies:
    """Both tokenizers with the bytes of their ids."""

    a_path: str
    b_path: str

    def __post_init__(self) -> None:
        if not cuts_at_blanks(self.a_path):
            raise ValueError(f"{self.a_path} is no byte-level .json vocabulary")
        import sentencepiece

        self.a = json_tokenizer(self.a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=self.b_path)
        self.a_bytes = [e or b"" for e in byte_level_entries(self.a_path)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        if any(PIECE_BLANK in self.b.id_to_piece(i).lstrip(PIECE_BLANK) for i in range(self.b.get_piece_size())):
            raise ValueError(f"{self.b_path} has pieces that go on after a blank")
        self.a_length = np.array([len(e) for e in self.a_bytes], np.int64)
        self.b_length = np.array([len(e) for e in self.b_bytes], np.int64)
        self.identity = self._identity()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(PIECE_BLANK, " ").encode()

    def _identity(self) -> np.ndarray:
        """B's id for the bytes of each A id, -1 if there is none; a piece goes before a byte."""
        own: dict[bytes, int] = {}
        for i in sorted(range(len(self.b_bytes)), key=lambda i: (self.b.is_byte(i), i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                own.setdefault(self.b_bytes[i], i)
        return np.array([own.get(e, -1) if e else -1 for e in self.a_bytes], np.int64)


@dataclass
class Aligned:
    """What is known of units: counts, group texts, and links one unit after the other."""

    n_a: np.ndarray
    n_b: np.ndarray
    valid: np.ndarray
    groups: np.ndarray
    text: list[bytes]
    same_start: np.ndarray
    same: np.ndarray  # A ids of groups whose tokens have the same bytes
    pair_start: np.ndarray
    pair: np.ndarray  # links of the other groups, as A id * size of B + B id

    @classmethod
    def none(cls) -> Aligned:
        empty = np.zeros(0, np.int64)
        return cls(empty, empty, np.zeros(0, bool), empty, [], np.zeros(1, np.int64), empty, np.zeros(1, np.int64), empty)

    def joined(self, other: Aligned) -> Aligned:
        return Aligned(
            np.concatenate([self.n_a, other.n_a]),
            np.concatenate([self.n_b, other.n_b]),
            np.concatenate([self.valid, other.valid]),
            np.concatenate([self.groups, other.groups]),
            self.text + other.text,
            np.concatenate([self.same_start, self.same_start[-1] + other.same_start[1:]]),
            np.concatenate([self.same, other.same]),
            np.concatenate([self.pair_start, self.pair_start[-1] + other.pair_start[1:]]),
            np.concatenate([self.pair, other.pair]),
        )


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _grouped(ids: np.ndarray, group: np.ndarray, n_groups: int) -> list[str]:
    """The decimal ids of each group, joined by commas."""
    start = _starts(np.bincount(group, minlength=n_groups)).tolist()
    text = list(map(str, ids.tolist()))
    return [text[i] if j == i + 1 else ",".join(text[i:j]) for i, j in zip(start, start[1:], strict=False)]


class Aligner:
    """Aligns units with both tokenizers and keeps what it found in a bounded table."""

    def __init__(self, vocabularies: Vocabularies, table_bytes: int | None = None) -> None:
        self.v, self.table_bytes = vocabularies, table_bytes
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = Aligned.none()
        self.bound = Bounded(self.table_bytes)

    def numbers(self, keys: set[str]) -> None:
        """Learn units that are not known yet; a unit's key lacks its opening blank."""
        missing = list(keys.difference(self.known))
        parts = [self.table]
        odd = [k for k in missing if not k or k[-1].isspace() or PIECE_BLANK in k]
        ordinary = [k for k in missing if k and not k[-1].isspace() and PIECE_BLANK not in k]
        for some in calls([len(k) for k in ordinary], CALL_CHARS):
            part = self._align(ordinary[some])
            if part is None:
                odd += ordinary[some]
            else:
                self._number(ordinary[some])
                parts.append(part)
        for k in odd:
            part = self._align([k]) if PIECE_BLANK not in k else None
            self._number([k])
            parts.append(part or self._without_tokens())
        whole = parts[0]
        if len(parts) > 1:
            whole = _all(parts)
        self.table = whole
        self.bound.add(missing, 12)

    def _number(self, keys: list[str]) -> None:
        for k in keys:
            self.known[k] = len(self.known)

    @staticmethod
    def _without_tokens() -> Aligned:
        nothing, no = np.zeros(1, np.int64), np.zeros(0, np.int64)
        return Aligned(nothing, nothing, np.zeros(1, bool), nothing, [b""], np.zeros(2, np.int64), no, np.zeros(2, np.int64), no)

    def _align(self, keys: list[str]) -> Aligned | None:
        """Units in one call of either tokenizer; None if their bytes or their ends are not those of the tokens."""
        v = self.v
        text = "".join([" " + k for k in keys])
        raw = text.encode()
        ends = np.cumsum([len(k.encode()) + 1 for k in keys]).astype(np.int64)
        ids_a = np.array(v.a.encode_batch([text], add_special_tokens=False)[0].ids, np.int64)
        ids_b = np.array(v.b.encode(text[1:]), np.int64)
        for ids, entries in ((ids_a, v.a_bytes), (ids_b, v.b_bytes)):
            if b"".join([entries[i] for i in ids.tolist()]) != raw:
                return None
        end_a, end_b = np.cumsum(v.a_length[ids_a]), np.cumsum(v.b_length[ids_b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        if not (cuts[np.searchsorted(cuts, ends).clip(max=len(cuts) - 1)] == ends).all():
            return None
        n = len(keys)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        size_a, size_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        first_a, first_b = _starts(size_a)[:-1], _starts(size_b)[:-1]
        regular = (size_a == 1) & (size_b == 1) & (v.identity[ids_a[first_a]] == ids_b[first_b])
        unit_of = np.searchsorted(ends, cuts)
        # A link is a stretch of bytes between ends of either side.
        every = np.union1d(end_a, end_b)
        every = every[~regular[np.searchsorted(cuts, every)]]
        link = ids_a[np.searchsorted(end_a, every)] * len(v.b_bytes) + ids_b[np.searchsorted(end_b, every)]
        sides = [f"{x}|{y}" for x, y in zip(_grouped(ids_a, group_a, len(cuts)), _grouped(ids_b, group_b, len(cuts)), strict=True)]
        groups = np.bincount(unit_of, minlength=n)
        start = _starts(groups).tolist()
        return Aligned(
            np.bincount(np.searchsorted(ends, end_a), minlength=n),
            np.bincount(np.searchsorted(ends, end_b), minlength=n),
            np.ones(n, bool),
            groups,
            [";".join(sides[i:j]).encode() for i, j in zip(start, start[1:], strict=False)],
            _starts(np.bincount(unit_of[regular], minlength=n)),
            ids_a[first_a[regular]],
            _starts(np.bincount(np.searchsorted(ends, every), minlength=n)),
            link,
        )


def _all(parts: list[Aligned]) -> Aligned:
    """``parts`` one after the other, joined two by two so that nothing is copied often."""
    while len(parts) > 1:
        parts = [parts[i].joined(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _rows_of(start: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all entries of ``chosen`` units, and how many each has."""
    size = start[chosen + 1] - start[chosen]
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(start[chosen], size) + inside, size


def _lists(owner: np.ndarray, values: np.ndarray, n: int, space: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each of ``n`` owners with their counts: starts, values, counts."""
    both, counts = np.unique(owner * space + values, return_counts=True)
    return _starts(np.bincount(both // space, minlength=n)), both % space, counts


def aligned_documents(docs: DataFrame, a_path: str, b_path: str, table_bytes: int | None = None, task_pairs: int | None = None) -> DataFrame:
    """A row of ``ROWS`` for each row of ``docs``, and rows without a number that hold sums of a task's links."""
    task_pairs = task_pairs or TASK_PAIRS

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        v = Vocabularies(a_path, b_path)
        aligner = Aligner(v, table_bytes)
        wide = len(v.b_bytes)
        vector = np.zeros(len(v.a_bytes), np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held = 0
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for some in slices(texts):
                if aligner.bound.full():
                    aligner.forget()
                rows = [units(t) if t else [] for t in texts[some]]
                aligner.numbers(set().union(*rows))
                table, n = aligner.table, len(rows)
                get = aligner.known.__getitem__
                unit = np.array([get(u) for r in rows for u in r], np.int64)
                owner = np.repeat(np.arange(n), [len(r) for r in rows])
                good = np.bincount(owner, ~table.valid[unit], n) == 0
                kept = good[owner]
                unit, owner = unit[kept], owner[kept]
                at, size = _rows_of(table.same_start, unit)
                same_of, same = np.repeat(owner, size), table.same[at]
                vector += np.bincount(same, minlength=len(vector))
                at, size = _rows_of(table.pair_start, unit)
                pair_of, pair = np.repeat(owner, size), table.pair[at]
                total = lambda x: np.bincount(owner, x[unit], n).astype(np.int64)  # noqa: B023, E731
                hashes, upto = [], _starts(np.bincount(owner, minlength=n)).tolist()
                numbers = unit.tolist()
                for i, j in zip(upto, upto[1:], strict=False):
                    hashes.append(hashlib.sha256(b";".join([table.text[u] for u in numbers[i:j]])).hexdigest() if j > i else "")
                links = np.bincount(same_of, minlength=n) + np.bincount(pair_of, minlength=n)
                same_start, same_ids, same_n = _lists(same_of, same, n, len(v.a_bytes))
                pair_start, pair_ids, pair_n = _lists(pair_of, pair, n, len(v.a_bytes) * wide)
                yield _batch(
                    np.arange(row, row + n), ids[some.start : some.stop], total(table.n_a), total(table.n_b), total(table.groups), links, hashes,
                    (same_start, same_ids, same_n), (pair_start, pair_ids, pair_n),
                )
                row += n
                found, back = np.unique(pair_ids, return_inverse=True)
                held.append((found, np.bincount(back, pair_n, len(found)).astype(np.int64)))
                n_held += len(found)
                if n_held > task_pairs:
                    held = [_summed(held)]
                    n_held = len(held[0][0])
                    if n_held > task_pairs // 2:
                        yield _sums(*held[0], False)
                        held, n_held = [], 0
        if held:
            yield _sums(*_summed(held), False)
        at = np.flatnonzero(vector)
        yield _sums(at, vector[at], True)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, ROWS)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


NO_LIST = (np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _sums(keys: np.ndarray, counts: np.ndarray, same: bool) -> pa.RecordBatch:
    entries = (np.array([0, len(keys)]), keys, counts)
    nothing = pa.nulls(1, pa.int64())
    # Sums of a task may pass an int, so those of same bytes travel in the wide columns too, as negative keys.
    return _batch(nothing, nothing, *[nothing] * 4, pa.nulls(1, pa.string()), NO_LIST, (entries[0], -1 - keys if same else keys, counts))


def _batch(row, doc_id, n_a, n_b, n_groups, n_links, hashes, same, pair) -> pa.RecordBatch:
    lists = []
    for (start, values, counts), kind in ((same, pa.int32()), (pair, pa.int64())):
        for x in (values, counts):
            lists.append(pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(x, kind)))
    plain = [x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in (row, doc_id, n_a, n_b, n_groups, n_links)]
    names = [c.split()[0] for c in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([*plain, pa.array(hashes, pa.string()), *lists], names=names)


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, head: int | None = None, table_bytes: int | None = None, task_pairs: int | None = None
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    ``a_path`` names a byte-level .json file, ``b_path`` a sentencepiece model;
    both have to lie on every machine. Null and empty texts, and texts whose
    tokens don't join to the bytes of a blank and the text (a text with U+2581,
    which B reads as a blank) have no tokens: zeros and an empty hash. Texts of
    any length are aligned whole. Repeated rows and null ids are rows of their
    own; ties for a B id's highest count are all best; an empty table gives no
    rows; other columns, whatever their names, are ignored. ``head`` bounds the
    pairs whose counts are sent to the tasks, ``table_bytes`` and ``task_pairs``
    what a task holds; none of them changes results.
    """
    spark = docs.sparkSession
    head = HEAD if head is None else head
    shelf = Shelf()
    v = Vocabularies(a_path, b_path)
    wide, identity = len(v.b_bytes), v.identity
    del v
    table = shelf.written(aligned_documents(docs, a_path, b_path, table_bytes, task_pairs), "alignment")
    sums = table.where("row is null").select(F.explode(F.arrays_zip("pair", "pair_n")).alias("e")).select(F.col("e.pair").alias("pair"), F.col("e.pair_n").alias("n"))
    total = lambda rows: rows.groupBy("pair").agg(F.sum("n").alias("n"))
    # The vectors of the tasks: as many sums as A has ids, at most.
    vector = {-1 - r["pair"]: r["n"] for r in total(sums.where("pair < 0")).collect()}
    same = [(int(a) * wide + int(identity[a]), int(n)) for a, n in sorted(vector.items())]
    same_rows = spark.createDataFrame(same, "pair long, n long")
    pairs = shelf.stored(total(total(sums.where("pair >= 0")).unionByName(same_rows)))
    b = F.pmod(F.col("pair"), F.lit(wide)).alias("b")
    best = np.zeros(wide, np.int64)
    for r in pairs.groupBy(b).agg(F.max("n").alias("n")).collect():  # one row for each id of B, at most
        best[r["b"]] = r["n"]
    keys = F.broadcast(spark.createDataFrame([(p,) for p, _ in same], "pair long"))
    of_same = np.zeros(len(identity), np.int64)
    for r in pairs.join(keys, "pair").collect():  # one row for each id of A, at most
        of_same[r["pair"] // wide] = r["n"]
    # The most frequent pairs: from the lowest power of two on that at most ``head`` pairs reach.
    reach = {r["power"]: r["pairs"] for r in pairs.groupBy((F.length(F.bin("n")) - 1).alias("power")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    power, sent = max(reach, default=0) + 1, 0
    while power > 0 and sent + reach.get(power - 1, 0) <= head:
        power -= 1
        sent += reach.get(power, 0)
    frequent = pairs.where(F.col("n") >= F.lit(2**power)).toArrow()
    order = np.argsort(frequent["pair"].to_numpy())
    head_key, head_n = frequent["pair"].to_numpy()[order], frequent["n"].to_numpy()[order]
    counts = spark.sparkContext.broadcast((head_key, head_n, of_same, best, identity))
    rare = sum(n for p, n in reach.items() if p < power)

    plain = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    names = [c.split()[0] for c in plain.split(", ")]

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, key_n, same_n, top, own = counts.value
        for batch in batches:
            n = batch.num_rows
            n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for values, times, is_same in (("same", "same_n", True), ("pair", "pair_n", False)):
                owner, value, time = _entries(batch, values, times)
                if is_same:
                    number, target = same_n[value], own[value]
                else:
                    found = _find(key, value)
                    owner, value, time, found = owner[found >= 0], value[found >= 0], time[found >= 0], found[found >= 0]
                    number, target = key_n[found], value % wide
                np.add.at(count_sum, owner, number * time)
                np.add.at(n_best, owner, np.where(number == top[target], time, 0))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(n_best), pa.array(count_sum)], names=[*names, "n_best", "count_sum"])

    rows = table.where("row is not null")
    result = rows.mapInArrow(known, f"{plain}, n_best long, count_sum long")
    if rare:

        def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key = counts.value[0]
            for batch in batches:
                owner, value, time = _entries(batch, "pair", "pair_n")
                left = _find(key, value) < 0
                row = batch.column("row").to_numpy()[owner[left]]
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(value[left]), pa.array(time[left])], names=["row", "pair", "times"])

        tops = F.broadcast(spark.createDataFrame([(i, int(n)) for i, n in enumerate(best) if n], "b int, top long"))
        numbered = pairs.where(F.col("n") < F.lit(2**power)).join(tops, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("is_best"))
        tail = (
            rows.mapInArrow(others, "row long, pair long, times long")
            .join(numbered, "pair")
            .groupBy("row")
            .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
        )
        more = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
        result = result.join(tail, "row", "left").select(*names, more("n_best", "more_best"), more("count_sum", "more_sum"))
    return shelf.last(result.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def _entries(batch: pa.RecordBatch, values: str, times: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row in the batch, value and count of every list entry."""
    column = batch.column(values)
    size = np.asarray(column.value_lengths().fill_null(0))
    return np.repeat(np.arange(batch.num_rows), size), column.flatten().to_numpy().astype(np.int64), batch.column(times).flatten().to_numpy().astype(np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted one in sorted ``keys``, -1 if it is not there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)
