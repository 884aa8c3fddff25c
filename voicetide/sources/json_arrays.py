"""JSON arrays read by many tasks: one file is cut at record boundaries.

Spark's text reader splits a file at any byte that ends a piece; here ``}`` does, so
every piece but the last ends where an object may end.  Whether it does depends on all
that comes before: on open brackets, and on whether a string is open.

1. Each block of a file is scanned for both cases, a string open at its start or not:
   how it changes the depth, the least depth, and whether it ends in a string.
2. A window per file over these few rows gives each block the state it begins in.
3. Each block is scanned again from that state.  Records inside it are whole; a record
   across blocks leaves one part in each, and the parts are joined by the block in which
   it began.

Text is read through Spark alone, so any store works.  Blocks meet their state by a join
of a written table of one row per block, which Spark broadcasts if it is small; the order
of pieces is restored after it in either case.  The records are written to the shared
folder, so the scans happen once.

Defined results.  An empty array or an empty file gives no record.  What is no object, and
the last record of an array without end (it may be cut in a value), come as texts that are
not JSON: readers fail or set them aside.  Brackets, quotes and escapes in strings, nested arrays and records longer
than a block are whole.  Compressed files are one block each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voicetide.session import fresh_path, importable, materialise

ESCAPED = re.compile(rb"\\.", re.DOTALL)
END = b"}"


def change(piece: bytes) -> tuple[int, int, int]:
    """Of a piece and the ``}`` after it: whether a string opens or closes, and the change of
    depth if it begins outside of strings, or inside."""
    if b"\\" in piece:
        piece = ESCAPED.sub(b"", piece)
    parts = piece.split(b'"')
    flips = (len(parts) - 1) & 1

    def depth(begins: int) -> int:
        outside = b"".join(parts[begins::2])
        opened = outside.count(b"{") + outside.count(b"[") - outside.count(b"]")
        return opened - (begins == flips)

    return flips, depth(0), depth(1)


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: (file, block, flips, d0, d1, m0, m1)."""
    found: dict[tuple, list] = {}
    for batch in batches:
        for file, block, piece in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
            # flips, then depth and least depth at an object's end for both cases
            state = found.setdefault((file, block), [0, 0, 0, None, None])
            flips, *by_state = change(piece)
            before = state[0]
            state[0] ^= flips
            for case in (0, 1):
                state[1 + case] += by_state[before ^ case]
                if state[0] == case:
                    low = state[3 + case]
                    state[3 + case] = state[1 + case] if low is None else min(low, state[1 + case])
    rows = [(*key, *state) for key, state in found.items()]
    names = ["file", "block", "flips", "d0", "d1", "m0", "m1"]
    types = [pa.string(), *[pa.int64()] * 6]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    yield pa.RecordBatch.from_arrays(columns, names=names)


class Block:
    """The records of one block, from the state it begins in."""

    def __init__(self, file: str, block: int, inside: int, depth: int, owner: int | None, last: bool):
        self.file, self.block, self.inside, self.depth, self.last = file, block, inside, depth, last
        self.first = owner is None
        self.owner = owner if not self.first and (inside or depth > 1) else None
        self.open = self.owner is not None
        self.closed = False
        self.parts: list[bytes] = []
        # a record that the latest piece of a file's last block closed
        self.held: tuple | None = None

    def row(self, text: bytes, owner: int | None = None) -> tuple:
        return self.file, self.block, owner, text

    def gap(self, text: bytes, more: bool) -> Iterator[tuple]:
        """What lies between records; anything but the array's own signs is no JSON."""
        found = b"".join(text.split())
        wanted = (b"[" if more else b"[]") if self.first else (b"," if more else b"]")
        if self.closed:
            wanted = b""
        if found != wanted:
            yield self.row(b"[" + found)
        self.closed = self.closed or not more
        self.first = False

    def feed(self, piece: bytes) -> Iterator[tuple]:
        flips, *by_state = change(piece)
        self.depth += by_state[self.inside]
        self.inside ^= flips
        if self.held:
            yield self.held
            self.held = None
        if not self.open:
            at = piece.find(b"{")
            yield from self.gap(piece if at < 0 else piece[:at], at >= 0)
            if at < 0:
                return
            self.open, piece = True, piece[at:]
        self.parts.append(piece)
        if not self.inside and self.depth <= 1:
            found = self.row(END.join(self.parts) + END, self.owner)
            if self.last:
                self.held = found
            else:
                yield found
            self.open, self.owner, self.parts = False, None, []

    def end(self) -> Iterator[tuple]:
        if self.held:
            # the last piece of a file need not have an end of its own
            yield (*self.held[:3], self.held[3][: -len(END)])
        elif self.open:
            text = END.join(self.parts) + (b"" if self.last else END)
            yield self.row(text, self.block if self.owner is None else self.owner)
        elif self.last and not self.closed:
            yield self.row(b"[")


def records_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, owner, text): whole records have no owner, parts the block of their record."""
    names = ["file", "block", "owner", "text"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    now: Block | None = None
    for batch in batches:
        out: list[tuple] = []
        for file, block, piece, inside, depth, owner, last in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            if now is None or (now.file, now.block) != (file, block):
                out.extend(now.end() if now else ())
                now = Block(file, block, inside, depth, owner, last)
            out.extend(now.feed(piece))
        yield made(out)
    if now:
        yield made(list(now.end()))


def block_states(pieces: DataFrame) -> DataFrame:
    """The state in which each block begins, and the block in which its open record began."""
    found = pieces.select("file", "block", "piece").mapInArrow(
        summaries, "file string, block long, flips long, d0 long, d1 long, m0 long, m1 long"
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def so_far(column: str):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    inside = found.withColumn("inside", so_far("flips") % 2)
    by_case = {name: F.when(F.col("inside") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0")) for name in "dm"}
    depth = inside.withColumns(by_case).withColumn("depth", so_far("d"))
    # what is open at the end of these began in them: a record ends there, or none is open at the start
    closed = (F.col("inside") == 0) & (F.col("depth") <= 1)
    begins = (F.col("depth") + F.col("m") <= 1) | closed | F.lag("block").over(order).isNull()
    return depth.withColumn("begins", begins).select(
        "file", "block", "inside", "depth",
        F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(before).alias("owner"),
        F.lead("block").over(order).isNull().alias("last"),
    )


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): the text of every element of the JSON arrays at ``path``, a file or a folder."""
    importable(spark)
    pieces = spark.read.text(path, lineSep=END.decode()).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"), F.monotonically_increasing_id().alias("at"),
    )
    states = materialise(block_states(pieces), "json-blocks")
    placed = pieces.join(states, ["file", "block"]).sortWithinPartitions("file", "block", "at")
    found = placed.select("file", "block", "piece", "inside", "depth", "owner", "last").mapInArrow(
        records_of, "file string, block long, owner long, text binary"
    )
    stored = fresh_path(spark, "json-records")
    found.withColumn("whole", F.col("owner").isNull()).write.partitionBy("whole").parquet(stored)
    rows = spark.read.schema("file string, block long, owner long, text binary, whole boolean").parquet(stored)
    parts = F.sort_array(F.collect_list(F.struct("block", "text")))
    # parts end at an ASCII sign, so each is text by itself
    joined = rows.filter(~F.col("whole")).groupBy("file", "owner").agg(
        F.array_join(F.transform(parts, lambda p: p["text"].cast("string")), "").alias("record")
    )
    whole = rows.filter("whole").select("file", F.col("text").cast("string").alias("record"))
    return whole.union(joined.select("file", "record"))
