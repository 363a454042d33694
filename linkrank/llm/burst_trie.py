"""Conversation prefix trie by bursting.

Every turn becomes an entry of ``ENTRY`` bytes: a digest of role and text and
the text's length. A conversation is the string of its entries, equal ones are
counted once, and a prefix of a string is a node of the trie.

All strings start in one container under the root. A container with more than
``container_limit`` different strings bursts: its node becomes a trie head, and
its strings go to containers by their next turn. A round only counts strings by
container and sends the few oversized containers back, so no string moves.
At last the containers are dealt to partitions as shards and sorted, and every
shard is swept once with a stack as deep as its longest conversation, which
gives the nodes with their sums. The heads are summed up from below, level by
level, from one row for each container.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import Shelf

ENTRY, DIGEST = 20, 16
SHARED = 5  # conversations that share a beginning: those up to the next multiple
LONGEST_SHARED = 9
# A level has at most so many heads; containers of fewer strings never burst.
HEADS, LEAST_LIMIT = 16_384, 2_000
ID_BITS = 10  # conversation ids are joined to texts by blocks of so many ids first
NODES = (
    "container binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string, top boolean"
)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_entry(role: Column, text: Column) -> Column:
    """``ENTRY`` bytes for a turn; a null role or text counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * (ENTRY - DIGEST), "0")
    return F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), size))


def original_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, own``: the entries of each conversation by turn, null first; equal turns by their digest."""
    entries = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), turn_entry(F.col("role"), F.col("text")).alias("entry")).alias("at")
    )
    own = F.transform(F.array_sort(F.collect_list("at"), _by_turn), lambda x: x["entry"])
    return entries.groupBy("conv_id").agg(_joined(own).alias("own"))


def _by_turn(a: Column, b: Column) -> Column:
    before = F.lit(-1)
    after = F.lit(1)
    return (
        F.when(a["turn"].isNull() & b["turn"].isNotNull(), before)
        .when(a["turn"].isNotNull() & b["turn"].isNull(), after)
        .when(a["turn"] < b["turn"], before)
        .when(a["turn"] > b["turn"], after)
        .when(a["entry"] < b["entry"], before)
        .when(a["entry"] > b["entry"], after)
        .otherwise(F.lit(0))
    )


def _joined(entries: Column) -> Column:
    # Hex digits: array_join takes strings only.
    return F.unhex(F.array_join(F.transform(entries, lambda e: F.hex(e)), ""))


def rebuilt_sequences(turns: DataFrame, shelf: Shelf) -> DataFrame:
    """``conv_id, seq``: the first turns of the conversation each one shares, then its own after as many."""
    own = shelf.stored(original_sequences(turns))
    shared = (F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(LONGEST_SHARED)) * ENTRY).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % SHARED
    first = own.where(F.col("conv_id") % SHARED == 0).select(F.col("conv_id").alias("base"), F.substring("own", 1, ENTRY * (LONGEST_SHARED - 1)).alias("first"))
    both = own.withColumn("base", base).withColumn("shared", shared).join(first, "base", "left")
    beginning = F.coalesce(F.substring(F.col("first"), F.lit(1), F.col("shared")), F.lit(b""))
    rest = F.substring(F.col("own"), F.col("shared") + 1, F.octet_length("own"))
    return both.select("conv_id", F.concat(beginning, rest).alias("seq"))


def distinct_sequences(rebuilt: DataFrame) -> DataFrame:
    """``seq, n, first_conv, ends_sha256`` of each different string.

    The hash is taken over the ids in order, so one string's ids pass through
    one task, in sorted blocks of text and never held as a whole.
    """
    key = F.sha2("seq", 256).alias("key")
    block = F.shiftright("conv_id", ID_BITS).alias("block")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    blocks = rebuilt.groupBy(key, block).agg(ids.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b",")
                    digest.update(ids.encode())
            yield _pairs(done)
        yield _pairs([] if key is None else [(key, digest.hexdigest())])

    ends = blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(hashed, "key string, ends_sha256 string")
    once = rebuilt.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_conv"))
    return once.withColumn("key", F.sha2("seq", 256)).join(ends, "key").drop("key")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["key", "ends_sha256"])


def _prefix(seq: Column, depth: int) -> Column:
    return F.unhex(F.substring(F.sha2(F.substring(seq, 1, ENTRY * depth), 256), 1, 2 * DIGEST))


def burst(strings: DataFrame, limit: int, shelf: Shelf) -> tuple[list[DataFrame], list[DataFrame]]:
    """Containers and heads by depth: strings with ``container, above``, and ``container`` of oversized ones.

    ``above`` is the head that the container hangs under. At most one in
    ``limit`` strings is the cause of a head, which bounds what is sent to all tasks.
    """
    containers, heads = [], []
    open_, depth = strings.withColumn("above", F.lit(None).cast("binary")), 0
    while True:
        keyed = open_.withColumn("container", _prefix(F.col("seq"), depth))
        oversized = shelf.stored(keyed.groupBy("container").agg(F.count(F.lit(1)).alias("strings")).where(F.col("strings") > limit).select("container"))
        if oversized.isEmpty():
            containers.append(keyed.withColumn("depth", F.lit(depth)))
            return containers, heads
        heads.append(oversized)
        few = F.broadcast(oversized)
        containers.append(keyed.join(few, "container", "left_anti").withColumn("depth", F.lit(depth)))
        bursting = keyed.join(few, "container", "left_semi")
        depth += 1
        longer = F.octet_length("seq") >= ENTRY * depth
        # A string that ends at a head stays with it, as a container of its own without a depth.
        containers.append(bursting.where(~longer).withColumn("above", F.col("container")).withColumn("depth", F.lit(None).cast("int")))
        open_ = shelf.stored(bursting.where(longer).withColumn("above", F.col("container")).drop("container"))


class _Open:
    """A node on the sweep's stack."""

    __slots__ = ("depth", "size", "conv_id", "n", "children", "leaves", "saved", "ends")

    def __init__(self, depth: int, size: int) -> None:
        self.depth, self.size = depth, size
        self.conv_id: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends = EMPTY_SHA

    def count(self, conv_id: int, n: int) -> None:
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)
        self.n += n


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted containers, each given when its last string has passed.

    A node's smallest member is only known when it closes, and then its parent
    is still open; so a node waits for its parent in the parent's list, and a
    container's nodes are given when its top closes - in slices if they are
    many: the parent's id only needs the strings that are still to come where
    the parent is open, and these wait as short rows.
    """
    out: list[tuple] = []
    waiting: list[list[tuple]] = []  # for each open node: closed children without their parent's id
    stack: list[_Open] = []
    container, seq = None, b""

    def close(depth: int) -> None:
        while stack and stack[-1].depth > depth:
            node = stack.pop()
            own = waiting.pop()
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.size
            for row in own:
                out.append((*row[:3], node.conv_id, *row[4:]))
            row = (container, node.depth, node.conv_id, None, node.n, node.children, leaves, saved, node.ends)
            if stack:
                above = stack[-1]
                above.count(node.conv_id, node.n)
                above.children += 1
                above.leaves += leaves
                above.saved += saved
                waiting[-1].append((*row, False))
            else:
                out.append((*row, True))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("container", "depth", "seq", "n", "first_conv", "ends_sha256")]
        for key, top, own, n, first, ends in zip(*columns, strict=True):
            if key != container:
                close(-1)
                container = key
                stack.append(_Open(top, int.from_bytes(own[top * ENTRY - ENTRY + DIGEST : top * ENTRY], "big") if top else 0))
                waiting.append([])
                shared = top
            else:
                shared, limit = top, min(len(own), len(seq)) // ENTRY
                while shared < limit and own[shared * ENTRY : shared * ENTRY + ENTRY] == seq[shared * ENTRY : shared * ENTRY + ENTRY]:
                    shared += 1
                close(shared)
            for depth in range(shared + 1, len(own) // ENTRY + 1):
                stack.append(_Open(depth, int.from_bytes(own[depth * ENTRY - ENTRY + DIGEST : depth * ENTRY], "big")))
                waiting.append([])
            stack[-1].count(first, n)
            stack[-1].ends = ends
            seq = own
        yield _nodes(out)
        out.clear()
    close(-1)
    yield _nodes(out)


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), *[pa.int64()] * 6, pa.string(), pa.bool_()]
    names = [c.split()[0] for c in NODES.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def prefix_trie(turns: DataFrame, container_limit: int | None = None) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored.
    Null roles and texts are empty; a null turn comes first; turns of equal
    number, repeated rows among them, follow by the digest of role and text;
    rows without a conversation id take no part. A conversation left without
    turns ends at the root. An empty table gives no nodes. Texts may have any
    length; a conversation's turns take 20 bytes each in one row.
    ``container_limit`` is the number of different strings from which on a
    container bursts; results don't depend on it.
    """
    shelf = Shelf()
    rebuilt = shelf.stored(rebuilt_sequences(turns, shelf))
    strings = shelf.stored(distinct_sequences(rebuilt))
    shelf.discard(rebuilt)
    limit = container_limit or max(LEAST_LIMIT, -(-strings.count() // HEADS))
    containers, heads = burst(strings, limit, shelf)
    every = containers[0]
    for c in containers[1:]:
        every = every.unionByName(c)
    every = shelf.stored(every)
    swept = shelf.stored(
        every.where("depth is not null")
        .select("container", "depth", "seq", "n", "first_conv", "ends_sha256")
        .repartition("container")
        .sortWithinPartitions("container", "seq")
        .mapInArrow(sweep, NODES)
    )
    # One row for each container under its head, and one for the strings that end at the head itself.
    hangs = every.where("depth is not null").groupBy("container").agg(F.first("above").alias("above"))
    tops = swept.where("top").join(hangs, "container")
    ended = every.where("depth is null")
    found = [swept.where("not top").drop("top", "container")]
    level = None
    for depth in reversed(range(len(heads))):
        size = F.conv(F.hex(F.substring("seq", ENTRY * depth - ENTRY + DIGEST + 1, ENTRY - DIGEST)), 16, 10).cast("long") if depth else F.lit(0).cast("long")
        parts = [
            tops.where(F.col("depth") == depth + 1).select("above", "conv_id", "n_convs", F.lit(1).cast("long").alias("children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends")),
            ended.where(F.octet_length("seq") == ENTRY * depth).select("above", F.col("first_conv").alias("conv_id"), F.col("n").alias("n_convs"), *[F.lit(0).cast("long").alias(c) for c in ("children", "n_leaves", "saved_tokens")], F.col("ends_sha256").alias("ends")),
        ]
        if level is not None:
            parts.append(level.select("above", "conv_id", "n_convs", F.lit(1).cast("long").alias("children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends")))
        sums = parts[0]
        for p in parts[1:]:
            sums = sums.unionByName(p)
        sums = sums.groupBy(F.col("above").alias("container")).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("children").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"), F.max("ends").alias("ends"),
        )
        # Where a head hangs and how long its last text is, from any of its strings.
        kept = every.where(F.octet_length("seq") >= ENTRY * depth).withColumn("container", _prefix(F.col("seq"), depth))
        kept = kept.join(F.broadcast(heads[depth]), "container", "left_semi")
        about = kept.groupBy("container").agg(F.max(size).alias("size"), F.max(_prefix(F.col("seq"), depth - 1) if depth else F.lit(None).cast("binary")).alias("above"))
        level = shelf.stored(
            sums.join(about, "container").select(
                "container", "above", F.lit(depth).alias("depth"), "conv_id", "n_convs", "n_children", "n_leaves",
                (F.col("below") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"),
            )
        )
        heads[depth] = level
    # The tops of containers and the heads get their parents' ids; a level of heads is small enough for every task.
    for depth in range(len(heads) + 1):
        hanging = tops.where(F.col("depth") == depth).drop("top", "parent_conv_id")
        if depth < len(heads):
            hanging = hanging.unionByName(heads[depth])
        if depth:
            parents = heads[depth - 1].select(F.col("container").alias("above"), F.col("conv_id").alias("parent_conv_id"))
            hanging = hanging.join(F.broadcast(parents), "above")
        else:
            hanging = hanging.withColumn("parent_conv_id", F.lit(None).cast("long"))
        found.append(hanging.drop("container", "above"))
    nodes = found[0]
    for f in found[1:]:
        nodes = nodes.unionByName(f)
    return shelf.last(
        nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )
