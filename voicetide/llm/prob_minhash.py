"""MinHash near-dedup by ProbMinHash: probability Jaccard of weighted word shingles.

*Signature.*  Each shingle of five words, weighted by its count, sends arrivals
of a Poisson process of that rate; each arrival falls into a random register,
and a register keeps the first.  Arrivals are drawn up to a time by which all
registers are surely filled, so most shingles of a long text cost one draw; if a
register is empty still, the time is doubled.  Two registers agree with
probability J_P, the probability Jaccard of the texts.

*Candidates.*  Equal texts are one node.  Nodes that agree in a band of
registers share a bucket.  First each node is compared with its buckets'
leaders (the smallest node), which is linear and joins a group of near copies of
any size.  Nodes outside their leader's component are then compared with all of
their bucket, in tiles, by signature and text; a tile returns links only, one
per component.  So no link is lost to the star, and no pairs are written.

*Verification.*  Pairs whose registers rule out the threshold (six standard
errors: a pair at the threshold is lost with probability 3e-8, far below the
bands' 5e-5) are left out, the others' J_P is computed from the texts.  Links join
components; a group's documents share the smallest id as ``class_id``.

Defined results.  Null texts and texts without words link with nothing and stay.
Texts of fewer than five words are one shingle.  Rows with the same text and id
are one document.  A missing id counts as larger than any other.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.llm import base
from voicetide.llm.graph import components
from voicetide.llm.merge_dropout import mix

WORDS = 5
THRESHOLD = 0.8
#: 25 bands of 5: a pair at the threshold is missed with probability 5e-5.
BANDS, BAND_ROWS = 25, 5
REGISTERS = 128
#: Standard errors by which the estimate may fall short of the threshold.
ERRORS = 6.0
#: Arrivals drawn at first, per register, beyond the logarithm of their number.
MARGIN = 4.0
TILE_ROWS = 512
CACHE_WORDS = 500_000


class Words(dict):
    """Word -> 64-bit hash; filled on demand and bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def word_hashes() -> Words:
    return base.kept(("word hashes",), Words)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a text's distinct shingles, in order, and their counts."""
    found = (text or "").encode("utf-8", "replace").split()
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0)
    known = word_hashes()
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = max(len(hashes) - WORDS + 1, 1)
    total = np.full(n, np.uint64(len(found[:WORDS])))
    for i in range(min(WORDS, len(hashes))):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(total, return_counts=True)


def signature(ids: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The element kept in each register (ProbMinHash1); ids must not be empty."""
    rate = weights.astype(float)
    span = registers * (math.log(registers) + MARGIN) / rate.sum()
    while True:
        times, elements = _arrivals(ids, rate, span)
        order = np.argsort(times[0], kind="stable")
        register = times[1][order]
        filled, first = np.unique(register, return_index=True)
        if len(filled) == registers:
            return elements[order][first]
        span *= 2


def _arrivals(
    ids: np.ndarray, rate: np.ndarray, span: float, registers: int = REGISTERS
) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """((times, registers), elements) of all arrivals before ``span``."""
    at, number = np.zeros(len(ids)), 0
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    golden = np.uint64(0x9E3779B97F4A7C15)
    stream = mix(ids + golden)
    # most elements of a long text have no arrival in time: one draw each; else all at once
    most = span * float(rate.max())
    width = 1 if most < 0.5 else int(min(most + 4 * math.sqrt(most) + 4, 4096))
    while len(ids):
        numbers = np.arange(number + 1, number + width + 1, dtype=np.uint64) * golden
        bits = mix(stream[:, None] + numbers)
        uniform = ((bits >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        times = at[:, None] - np.cumsum(np.log(uniform), axis=1) / rate[:, None]
        row, column = np.nonzero(times < span)
        register = mix(bits[row, column] + np.uint64(1)) % np.uint64(registers)
        out.append((times[row, column], register.astype(np.int64), ids[row]))
        more = times[:, -1] < span
        ids, stream, rate, at = ids[more], stream[more], rate[more], times[more, -1]
        number += width
        width = int(min(max(4, registers * 8 // max(len(ids), 1)), 256))
    times, register, elements = (np.concatenate(c) for c in zip(*out, strict=True))
    return (times, register), elements


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets: the sum over common elements d of
    1 / sum_e max(x_e / x_d, y_e / y_d).  Sorting by x_e / y_e makes the inner sums
    prefix sums."""
    if not len(x[0]) or not len(y[0]):
        return 0.0
    both, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    u, v = x[1][i].astype(float), y[1][j].astype(float)
    only_x, only_y = x[1].sum() - u.sum(), y[1].sum() - v.sum()
    ratio = u / v
    order = np.argsort(ratio)
    # elements of a ratio at least d's count by x, the others by y
    from_right = np.append(np.cumsum(u[order][::-1])[::-1], 0.0)
    from_left = np.append(0.0, np.cumsum(v[order]))
    at = np.searchsorted(ratio[order], ratio, side="left")
    return float((1 / ((only_x + from_right[at]) / u + (only_y + from_left[at]) / v)).sum())


def bands(signed: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signed[i : BANDS * BAND_ROWS : BAND_ROWS])
    return keys.view(np.int64)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands, sig): ``sig`` packs the low halves of the registers."""

    def make(texts: list[str | None]) -> tuple[None, list[list]]:
        keys, packed = [], []
        for text in texts:
            ids, counts = shingles(text)
            if len(ids):
                signed = signature(ids, counts)
                keys.append(bands(signed).tolist())
                packed.append(signed.astype("<u4").tobytes())
            else:
                keys.append([])
                packed.append(b"")
        return None, [keys, packed]

    rows = docs.select("doc_id", "text", text_key(base.text_col()).alias("key"))
    return base.add_columns(
        rows, make, "bands array<long>, sig binary", ["text"], ["doc_id", "key"]
    )


def _agreement(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Shares of equal registers of signatures, row by row."""
    x = np.frombuffer(b"".join(a), "<u4").reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), "<u4").reshape(len(b), -1)
    return (x == y).mean(axis=1)


def least_agreement(threshold: float) -> float:
    return threshold - ERRORS * math.sqrt(threshold * (1 - threshold) / REGISTERS)


def promising(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose registers don't rule out the threshold."""
    sigs = nodes.select("node", "sig")
    joined = (
        pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")
    )
    least = least_agreement(threshold)

    def make(a: list[bytes], b: list[bytes]) -> tuple[None, list[np.ndarray]]:
        return None, [_agreement(a, b) >= least]

    marked = base.add_columns(joined, make, "near boolean", ["sig_a", "sig_b"], ["a", "b"])
    return marked.filter("near").select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose texts reach the threshold; ``texts`` has (node, text)."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().toDF("node")
    some = base.written(texts.join(wanted, "node", "left_semi"), "texts")
    joined = (
        pairs.join(some.toDF("a", "text_a"), "a").join(some.toDF("b", "text_b"), "b")
    )

    def make(a: list[str], b: list[str]) -> tuple[None, list[list[bool]]]:
        known: dict[str, tuple] = {}

        def bag(text: str) -> tuple:
            if text not in known:
                if len(known) > 64:
                    known.clear()
                known[text] = shingles(text)
            return known[text]

        return None, [
            [probability_jaccard(bag(x), bag(y)) >= threshold for x, y in zip(a, b, strict=True)]
        ]

    marked = base.add_columns(joined, make, "near boolean", ["text_a", "text_b"], ["a", "b"])
    return marked.filter("near").select("a", "b")


def packed_bags(texts: DataFrame) -> DataFrame:
    """(node, bag): shingle hashes, then their counts as 32-bit floats."""

    def make(found: list[str]) -> tuple[None, list[list[bytes]]]:
        bags = (shingles(t) for t in found)
        return None, [[ids.tobytes() + n.astype("<f4").tobytes() for ids, n in bags]]

    return base.add_columns(texts, make, "bag binary", ["text"], ["node"])


def _bag(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 12
    return np.frombuffer(packed, "<u8", n), np.frombuffer(packed, "<f4", n, 8 * n)


def tile_links(tile: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of the asking nodes of a tile to other components, one per component.

    A node's candidates in this tile are tried from the most similar signature
    on until one is verified, so a component gets one link or is ruled out.  A
    pair is looked at in the first bucket it shares only.
    """
    asks, other = tile[tile["asks"]], tile[~tile["asks"]]
    a, b = [], []
    if len(asks) and len(other):
        least, here = least_agreement(threshold), tile["bucket"].iloc[0]
        sigs = np.frombuffer(b"".join(other["sig"]), "<u4").reshape(len(other), -1)
        keys = np.array(other["bands"].to_list())
        nodes, parts = other["node"].to_numpy(), other["component"].to_numpy()
        packed, bags = other["bag"].to_list(), {}
        for row in asks.itertuples(index=False):
            agreement = (sigs == np.frombuffer(row.sig, "<u4")).mean(axis=1)
            mine = np.asarray(row.bands)
            first = mine[(keys == mine).argmax(axis=1)] == here
            found = np.flatnonzero((agreement >= least) & (parts != row.component) & first)
            own, linked = _bag(row.bag), set()
            for i in found[np.argsort(-agreement[found], kind="stable")].tolist():
                if parts[i] in linked:
                    continue
                if i not in bags:
                    bags[i] = _bag(packed[i])
                if probability_jaccard(own, bags[i]) >= threshold:
                    linked.add(parts[i])
                    a.append(min(nodes[i], row.node))
                    b.append(max(nodes[i], row.node))
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def tiled(rows: DataFrame) -> DataFrame:
    """(bucket, node, component, tile, asker_tile, asks): the members of open buckets, dealt
    so that every asking node meets every node of its bucket in one (tile, asker_tile), and
    that none of these holds more than about twice ``TILE_ROWS`` rows.
    """

    def parts(n: str) -> Column:
        return F.ceil(F.col(n) / TILE_ROWS).cast("int")

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("node"), parts(n)).cast("int")

    def places(n: str, place: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), parts(n) - 1), place)

    def at(tile: Column, asker_tile: Column, asks: bool) -> Column:
        found = F.struct(
            tile.alias("tile"), asker_tile.alias("asker_tile"), F.lit(asks).alias("asks")
        )
        return found.cast("struct<tile:int,asker_tile:int,asks:boolean>")

    mine = places("askers", lambda t: at(own("size"), t, False))
    asked = places("size", lambda t: at(t, own("askers"), True))
    return rows.select(
        "bucket", "node", "component",
        F.explode(F.when(F.col("apart"), F.concat(mine, asked)).otherwise(mine)).alias("_t"),
    ).select("bucket", "node", "component", "_t.*")


def left_over(
    members: DataFrame, nodes: DataFrame, texts: DataFrame, reached: DataFrame, threshold: float
) -> DataFrame | None:
    """Links inside buckets that the stars left in several components; None if there are
    no such buckets.

    ``members`` has (bucket, node, leader, size).  Only nodes outside their
    leader's component ask; both sides are dealt in tiles of bounded size, and a pair
    of tiles returns links only.
    """
    of = reached.toDF("node", "component")
    leaders = reached.toDF("leader", "leader_component")
    placed = (
        members.filter("size > 2").join(of, "node", "left").join(leaders, "leader", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("apart", F.col("component") != F.coalesce("leader_component", "leader"))
    )
    open_ = placed.groupBy("bucket").agg(F.count_if("apart").alias("askers")).filter("askers > 0")
    rows = base.written(placed.join(open_, "bucket"), "open")
    if rows.isEmpty():
        return None
    wanted = rows.select("node").distinct()
    content = base.written(
        packed_bags(texts.join(wanted, "node", "left_semi")).join(
            nodes.select("node", "sig", "bands"), "node"
        ),
        "bags",
    )

    def compare(found: pd.DataFrame) -> pd.DataFrame:
        return tile_links(found, threshold)

    return (
        tiled(rows).join(content, "node").groupBy("bucket", "tile", "asker_tile")
        .applyInPandas(compare, "a long, b long").distinct()
    )


def groups(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): ``rows`` has (doc_id, key) of every row, ``nodes`` has
    (key, component) of every distinct text that has words."""
    signed = base.written(sign(docs), "signed")
    nodes = base.written(
        signed.filter(F.size("bands") > 0).groupBy("key")
        .agg(F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = (
        buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
    )
    members = base.written(buckets.join(shared, "bucket"), "members")
    star = members.filter("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")
    ).distinct()
    texts = (
        docs.select(text_key(base.text_col()).alias("key"), "text").groupBy("key")
        .agg(F.first("text").alias("text")).join(nodes.select("key", "node"), "key")
        .select("node", "text")
    )
    first = base.written(promising(star, nodes, threshold), "candidates")
    links = base.written(verified(first, texts, threshold), "links")
    reached = components(links)
    rest = left_over(members, nodes, texts, reached, threshold)
    if rest is not None:
        # written: the components read their links several times
        reached = components(links.union(base.written(rest, "rest")))
    placed = nodes.select("key", "node").join(reached, "node", "left")
    return signed.select("doc_id", "key"), placed.select(
        "key", F.coalesce("component", "node").alias("component")
    )


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``key``, ``class_id``, ``kept``."""
    rows, nodes = groups(docs, threshold)
    nodes = base.written(nodes, "components")
    placed = base.written(rows.join(nodes, "key", "left"), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), "key")
    # copies are one row per task before they meet
    first = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("_f"))
    # written, so that the join with it can split a large group over several tasks
    chosen = placed.join(base.written(first, "first"), "component", "left")
    mine = F.col("_f.id").eqNullSafe(F.col("doc_id")) & (F.col("_f.key") == F.col("key"))
    return chosen.select(
        "doc_id", "key",
        F.when(F.col("_f").isNull(), F.col("doc_id")).otherwise(F.col("_f.id")).alias("class_id"),
        F.when(F.col("_f").isNull(), F.lit(True)).otherwise(mine).alias("kept"),
    )


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents ``classify`` keeps, with the columns they came with, each once."""
    verdicts = base.written(classify(docs, threshold), "verdicts")
    gone = verdicts.filter(~F.col("kept")).select("doc_id", "key").distinct()
    key = base.free_name(docs, "_key")
    rows = docs.withColumn(key, text_key(base.text_col()))

    def same(other: DataFrame) -> Column:
        return (rows[key] == other["key"]) & rows["doc_id"].eqNullSafe(other["doc_id"])

    stay = rows.join(gone, same(gone), "left_anti")
    # rows that repeat id and text are one document
    repeated = (
        verdicts.filter("kept AND class_id IS NOT DISTINCT FROM doc_id").groupBy("doc_id", "key")
        .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id", "key")
    )
    if repeated.isEmpty():
        return stay.drop(key)
    id_, k = base.free_name(stay, "_id"), base.free_name(stay, "_k")
    again = stay.join(
        repeated.toDF(id_, k),
        (stay[key] == F.col(k)) & stay["doc_id"].eqNullSafe(F.col(id_)), "left",
    )
    once = again.filter(F.col(k).isNotNull()).dropDuplicates(["doc_id", key])
    return again.filter(F.col(k).isNull()).union(once).drop(key, id_, k)
