"""A trie of conversation prefixes, folded up by time-forward processing.

*Trie.*  Every distinct sequence of first turns is a node, named by a chained
128-bit hash.  Conversations become rows of (conversation, depth, node) in one
pass over sorted rows, so a conversation of any length streams through a task.
The nodes are the groups of these rows, combined inside the map tasks.

*Shards.*  A node with more than one in ``SHARES`` of all rows belongs to the top,
which therefore has fewer than ``SHARES`` nodes.  The subtree below a node that is
the first on its path outside the top is a shard.  At most one in ``SHARES`` of all
rows goes through a shard's root, whatever a third of the conversations begin with.

*Time-forward processing.*  A shard's nodes are sorted externally (by Spark) by
level, deepest first.  A node takes from a priority queue what its children sent,
finishes its subtree's totals and sends them on to its parent, which comes later
in this order.  The queue holds at most ``QUEUE`` messages in memory; beyond that
it writes sorted runs next to Spark's own spill files and merges them.  A shard's
root sends its totals to the top: they are summed per parent, and the top is
folded in the same way, across the shard roots.

*Ends.*  The ids of the conversations that end at a node are sorted and joined in
blocks by many tasks; a node's blocks are then hashed in order, so a node where
a third of all conversations end costs one task a stream of bytes, not of rows.

Defined results.  Turns are ordered by number, missing first, then by role and
text, so repeated rows are turns of their own.  Missing role or text: empty.
Rows without a conversation id belong to no conversation and are left out.  A
conversation without turns ends at the root.  An empty table has no conversation
and no node: an empty result.  Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voicetide.llm import base

#: Largest share of the rows in a shard, as one in so many; bounds the top, too.
SHARES = 10_000
#: Messages a queue holds in memory.
QUEUE = 200_000
#: Turns taken from the shared beginning, and conversations that share one.
TAKEN, FAMILY = 6, 100
#: Range of ids joined to one text before a node's ids are hashed.
BLOCK_IDS = 4096

PATH = "conv_id long, depth long, node binary, parent binary, length long, last boolean"
TOTALS = "node binary, parent binary, n_children long, n_leaves long, saved long, is_root boolean"
ENDS = "node binary, ends_sha256 string"
ROOT = bytes(16)


def turn_key(role: Column, text: Column) -> Column:
    """A 128-bit hash of (role, text); the role's length keeps the two apart."""
    sized = F.concat(F.length(role.cast("binary")).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.md5(sized.cast("binary")))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, length): the turns in order, from 1."""
    role, text = base.text_col("role"), base.text_col("text")
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"), turn_key(role, text).alias("key"),
        F.length(text).cast("long").alias("length"), role.alias("_role"), F.md5(text.cast("binary")).alias("_text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    return rows.withColumn("pos", F.row_number().over(order).cast("long")).select("conv_id", "pos", "key", "length")


def rebuilt(own: DataFrame) -> DataFrame:
    """Turns of conversations that share the beginning of their family's first one.

    Conversation c takes the first h turns of c - c % 100, where h is the crc32 of
    its id modulo 6, and goes on with its own turns after its first h.  At most five
    turns of a conversation are copied to at most 100 others.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % TAKEN
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    ids = own.select("conv_id").distinct().select("conv_id", first.alias("first"), taken.alias("h"))
    # the heads of the families: (first, beginning), one row each
    heads = own.filter((F.col("pos") < TAKEN) & (F.col("conv_id") % FAMILY == 0)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "length"))).alias("beginning")
    )
    begun = ids.join(heads.withColumnRenamed("conv_id", "first"), "first", "left").select(
        "conv_id", "h",
        F.expr("coalesce(slice(beginning, 1, cast(h as int)), array())").alias("beginning"),
    )
    copied = begun.select("conv_id", F.explode("beginning").alias("t")).select(
        "conv_id", F.lit(0).alias("part"), "t.pos", "t.key", "t.length"
    )
    kept = own.filter(F.col("pos") > taken).select("conv_id", F.lit(1).alias("part"), "pos", "key", "length")
    # a row per conversation, so that one without turns stays
    roots = ids.select(
        "conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(ROOT).alias("key"),
        F.lit(0).cast("long").alias("length"),
    )
    return roots.unionByName(copied).unionByName(kept)


def paths(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, length, last) of every prefix of every conversation.

    ``rows`` has (conv_id, part, pos, key, length) with one row of part -1 a conversation.
    """
    base.importable(rows.sparkSession)
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    names = [f.split()[0] for f in PATH.split(", ")]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Any] | None = None  # the last row so far; whether it ends is known by the next
        for batch in batches:
            out = []
            ids, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for conv, part, key, length in zip(ids, parts, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if part < 0:
                    row = [conv, 0, ROOT, None, 0, True]
                else:
                    node = hashlib.blake2b(held[2] + key, digest_size=16).digest()
                    row = [conv, held[1] + 1, node, held[2], length, True]
                    held[5] = False
                if held is not None:
                    out.append(held)
                held = row
            yield batch_of(out)
        yield batch_of([held] if held is not None else [])

    def batch_of(out: list[list]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    ordered = rows.select("conv_id", "part", "pos", "key", "length").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "part", "pos").mapInArrow(chain, PATH)


class Queue:
    """A priority queue that spills: messages (place, node, totals) come out by place and node.

    In memory it is a heap of at most ``most`` messages.  A full heap is written as a
    sorted run to a file without a name in Spark's own spill folder, which ends with
    the task; runs are read back as they are merged.
    """

    def __init__(self, most: int):
        self.most = most
        self.heap: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.ahead: list[tuple] = []  # the next message of each run, with the run's number

    def push(self, message: tuple) -> None:
        if len(self.heap) >= self.most:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        folder = (os.environ.get("SPARK_LOCAL_DIRS") or "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder)
        self.heap.sort()
        for start in range(0, len(self.heap), 1024):
            pickle.dump(self.heap[start : start + 1024], file)
        file.seek(0)
        self.heap = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file: Any) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    part = pickle.load(file)
                except EOFError:
                    return
                yield from part

    def _advance(self, run: int) -> None:
        message = next(self.runs[run], None)
        if message is not None:
            heapq.heappush(self.ahead, (message, run))

    def take(self, place: int, node: bytes) -> Iterator[tuple]:
        """Remove all messages to this node, which must be the smallest addressed."""
        while self.heap and self.heap[0][:2] == (place, node):
            yield heapq.heappop(self.heap)
        while self.ahead and self.ahead[0][0][:2] == (place, node):
            message, run = heapq.heappop(self.ahead)
            self._advance(run)
            yield message

    def __len__(self) -> int:
        return len(self.heap) + len(self.ahead)


def fold(nodes: DataFrame, queue: int = QUEUE) -> DataFrame:
    """Totals of the subtrees of each shard: number of children and of leaves, sum of ``value``.

    ``nodes`` has (shard, depth, node, parent, value, is_root, n_children, n_leaves, saved), the last
    three being what children outside the shard have sent, sorted within tasks by shard,
    depth from the deepest, and node.
    """
    base.importable(nodes.sparkSession)
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    names = [f.split()[0] for f in TOTALS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        messages = Queue(queue)
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(1, 9)]
            for depth, node, parent, value, is_root, children, leaves, saved in zip(*columns, strict=True):
                for _, _, more_leaves, more_saved in messages.take(-depth, node):
                    children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
                leaves, saved = leaves if children else 1, saved + value
                out.append((node, parent, children, leaves, saved, is_root))
                if not is_root:
                    messages.push((-(depth - 1), parent, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 6, types, strict=True)], names
            )
        if len(messages):
            raise ValueError("messages to nodes that aren't in their shard")

    columns = ("shard", "depth", "node", "parent", "value", "is_root", "n_children", "n_leaves", "saved")
    return nodes.select(*columns).mapInArrow(run, TOTALS)


def ends(rows: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids of the conversations that end there, ascending."""
    base.importable(rows.sparkSession)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    parts = (
        rows.filter("last").groupBy("node", F.floor(F.col("conv_id") / block_ids).alias("block"))
        .agg(joined.alias("ids"))
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for this, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if this != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = this, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield batch_of(out)
        yield batch_of([(node, state.hexdigest())] if node is not None else [])

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["node", "ends_sha256"])

    ordered = parts.repartition("node").sortWithinPartitions("node", "block")
    return ordered.select("node", "ids").mapInArrow(digest, ENDS)


def trie(rows: DataFrame, shares: int = SHARES, queue: int = QUEUE) -> DataFrame:
    """One row per node.  ``rows`` are turns as ``rebuilt`` returns them."""
    walked = base.written(paths(rows), "paths")
    n_rows = walked.count()
    # nodes with more than one in ``shares`` of the rows: fewer than ``shares`` of them
    top = base.written(
        walked.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(n_rows // shares, 1)).select("node"),
        "top",
    )
    marked = walked.join(F.broadcast(top.withColumn("top", F.lit(True))), "node", "left").withColumn(
        "top", F.coalesce("top", F.lit(False))
    )
    along = Window.partitionBy("conv_id")
    outside = F.min(F.when(~F.col("top"), F.struct("depth", "node"))).over(along)["node"]
    sharded = marked.withColumn("shard", F.when(~F.col("top"), outside))
    nodes = base.written(
        sharded.groupBy("node").agg(
            F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("length").alias("length"),
            F.first("shard").alias("shard"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        ),
        "nodes",
    )
    valued = nodes.select(
        "shard", "depth", "node", "parent", ((F.col("n_convs") - 1) * F.col("length")).alias("value"),
    )
    nothing = {c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved")}
    below = valued.filter("shard IS NOT NULL").withColumns(
        {"is_root": F.col("shard") == F.col("node"), **nothing}
    ).repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "node")
    folded = base.written(fold(below, queue), "folded")
    # what shard roots send, summed per parent: at most as many rows as the top has nodes
    sent = folded.filter("is_root").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
    )
    above = (
        valued.filter("shard IS NULL").join(sent, "node", "left").fillna(0, list(nothing))
        .withColumns({"shard": F.lit(ROOT), "is_root": F.col("depth") == 0})
        .repartition(1).sortWithinPartitions(F.desc("depth"), "node")
    )
    totals = folded.unionByName(fold(above, queue)).select("node", "n_children", "n_leaves", "saved")
    # parents in the top may have very many children: these few rows go to every task
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.select("node", "parent", "depth", "conv_id", "n_convs", F.lit(0).alias("_in"))
    mine = known.join(F.broadcast(top.withColumnRenamed("node", "parent").withColumn("_hot", F.lit(True))), "parent", "left")
    hot = parents.join(F.broadcast(top.withColumnRenamed("node", "parent")), "parent")
    placed = (
        mine.filter("_hot").join(F.broadcast(hot), "parent", "left")
        .unionByName(mine.filter("_hot IS NULL").join(parents, "parent", "left"))
    )
    return placed.join(totals, "node").join(ends(walked), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, shares: int = SHARES, queue: int = QUEUE) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    own = base.written(turns(conversations), "turns")
    return trie(rebuilt(own), shares, queue)
