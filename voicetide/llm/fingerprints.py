"""Document fingerprints: a homomorphic multiset hash of paragraphs.

*Fingerprint.*  A text's paragraphs are its lines.  Each is hashed to a wide
vector, and the fingerprint is the sum of these vectors, lane by lane, modulo a
power of two.  So it doesn't depend on the paragraphs' order, equal multisets of
paragraphs have equal fingerprints, and a paragraph is inserted or deleted by
adding or subtracting its vector, without the rest of the text.  The vector has
two parts:

* ``WIDE`` lanes modulo 2**64 from an extendable-output hash of the paragraph.
  They tell texts apart.
* ``NARROW`` lanes modulo 2**32, where every run of ``GRAM`` characters of the
  paragraph adds one or minus one to one lane.  They tell how alike two texts
  are: 2 x.y / (x.x + y.y) estimates the share of common runs, with a standard
  error of about 1 / sqrt(NARROW).

*Neighbours in order.*  The edited text ends with the beginning of the next
document.  Ranges of ids are cut from a pass over ids alone; each range gets a
copy of the first row of the next range, so that one shuffle of the texts is
enough and no range needs another.  The edited fingerprint is updated from the
text's own: the paragraphs behind the edit are deleted and the new ones inserted.

Defined results.  Null text: empty text, one empty paragraph.  Missing ids come
last; rows with the same id are ordered by the hash of their text, so a repeated
row follows itself.  A single document is its own next.  Texts of any length are
hashed in pieces of ``PIECE`` characters.  An empty table gives an empty result.
Columns other than ``doc_id`` and ``text`` aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import json

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voicetide.llm import base
from voicetide.llm.merge_dropout import mix

#: Lanes modulo 2**64 and modulo 2**32.
WIDE, NARROW = 32, 128
#: Characters of a run; characters hashed at once.
GRAM = 8
PIECE = 1 << 18
#: Documents of a range, and the most ranges (their first ids are sent to the tasks).
RANGE_ROWS = 2000
MAX_RANGES = 10_000

BASE = 0x9E3779B97F4A7C15


class Fingerprint:
    """A sum of paragraph vectors."""

    def __init__(self, wide: np.ndarray | None = None, narrow: np.ndarray | None = None):
        self.wide = np.zeros(WIDE, "<u8") if wide is None else wide
        self.narrow = np.zeros(NARROW, "<i4") if narrow is None else narrow

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        return cls().insert(text.split("\n"))

    @classmethod
    def from_text(cls, packed: str) -> Fingerprint:
        raw = base64.b64decode(packed)
        return cls(np.frombuffer(raw, "<u8", WIDE), np.frombuffer(raw, "<i4", NARROW, 8 * WIDE))

    def insert(self, paragraphs: list[str]) -> Fingerprint:
        wide, narrow = vectors(paragraphs)
        return Fingerprint(self.wide + wide, self.narrow + narrow)

    def delete(self, paragraphs: list[str]) -> Fingerprint:
        wide, narrow = vectors(paragraphs)
        return Fingerprint(self.wide - wide, self.narrow - narrow)

    def text(self) -> str:
        return base64.b64encode(self.wide.tobytes() + self.narrow.tobytes()).decode()

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and bool(
            (self.wide == other.wide).all() and (self.narrow == other.narrow).all()
        )

    def likeness(self, other: Fingerprint) -> float:
        """Estimated share of common character runs; 1 for equal multisets."""
        if self == other:
            return 1.0
        x, y = self.narrow.astype(float), other.narrow.astype(float)
        size = x @ x + y @ y
        return float(min(max(2 * (x @ y) / size, 0.0), 1.0)) if size else 0.0


def vectors(paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the paragraphs' vectors, in both parts."""
    if not paragraphs:
        return np.zeros(WIDE, "<u8"), np.zeros(NARROW, "<i4")
    wide, narrow = np.zeros(WIDE, "<u8"), np.zeros(NARROW, np.int64)
    shorts: list[bytes] = []
    for start in range(0, len(paragraphs), 4096):
        some = paragraphs[start : start + 4096]
        digests = [hashlib.shake_128(p.encode("utf-8", "surrogatepass")).digest(8 * WIDE) for p in some]
        wide += np.frombuffer(b"".join(digests), "<u8").reshape(len(some), WIDE).sum(axis=0, dtype="<u8")
        # a paragraph shorter than a run is one run
        shorts += [d[:8] for p, d in zip(some, digests, strict=True) if len(p) < GRAM]
    _count(np.frombuffer(b"".join(shorts), "<u8"), narrow)
    long = [p for p in paragraphs if len(p) >= GRAM]
    if long:
        joined = "\n".join(long)
        for start in range(0, len(joined), PIECE):
            _count(runs(joined[start : start + PIECE + GRAM - 1]), narrow)
    return wide, narrow.astype("<i4")


def runs(text: str) -> np.ndarray:
    """Hashes of all runs of ``GRAM`` characters within a line, by doubling."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("<u8")
    if len(code) < GRAM:
        return np.zeros(0, "<u8")
    total, size, factor = code, 1, BASE
    while size < GRAM:
        total = total[: len(total) - size] * np.uint64(factor) + total[size:]
        size, factor = 2 * size, factor * factor % 2**64
    breaks = np.concatenate([[0], np.cumsum(code == 10)])
    return total[breaks[GRAM:] == breaks[:-GRAM]]


def _count(hashes: np.ndarray, narrow: np.ndarray) -> None:
    mixed = mix(hashes)
    lane = (mixed % np.uint64(2 * NARROW)).astype(np.int64)
    both = np.bincount(lane, minlength=2 * NARROW)
    narrow += both[:NARROW] - both[NARROW:]


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def edited_fingerprint(own: Fingerprint, text: str, new: str) -> Fingerprint:
    """The fingerprint of ``new`` from that of ``text``: what both begin with stays."""
    kept = len(text) - len(text) // 4
    line = text.rfind("\n", 0, kept) + 1
    return own.delete(text[line:].split("\n")).insert(new[line:].split("\n"))


def _place(cuts: list[str], kind: str) -> Column:
    """The range of an id: the number of cuts up to it less one, by binary search.
    Missing ids have a range of their own behind the others."""
    known = F.from_json(F.lit(json.dumps(cuts)), "array<string>").cast(f"array<{kind}>")
    steps = [1 << i for i in reversed(range(max(len(cuts), 1).bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.try_element_at(known, at + step) <= F.col("doc_id"), at + step).otherwise(at),
    )
    return F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(F.greatest(found - 1, F.lit(0)))


def followed(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text, next): every document with the text of the next one by ``doc_id``."""
    ids = docs.select("doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = min(max(-(-ids.count() // range_rows), 1), MAX_RANGES)
    firsts = (
        ids.filter("doc_id IS NOT NULL").repartitionByRange(ranges, "doc_id")
        .groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("id")).orderBy("id")
    )
    # one id for each of at most MAX_RANGES ranges reaches the driver
    cuts = [r[0] for r in firsts.select(F.col("id").cast("string")).collect()]
    rows = docs.select("doc_id", base.text_col().alias("text")).withColumn("range", _place(cuts, kind))
    key = F.md5(F.col("text").cast("binary"))
    # a row per range, which goes to the end of the range before, the first one's to the last
    order = Window.orderBy("begins")
    heads = base.written(
        rows.groupBy(F.col("range").alias("begins")).agg(F.min("doc_id").alias("first_id")).select(
            "begins", "first_id",
            F.coalesce(F.lag("begins").over(order), F.max("begins").over(Window.partitionBy())).alias("ends"),
        ),
        "ranges",
    )
    begins = (F.col("range") == F.col("begins")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    tails = (
        rows.join(F.broadcast(heads), begins).groupBy("ends")
        .agg(F.min(F.struct(key.alias("key"), "text")).alias("_f"))
        .select(
            F.lit(None).cast(kind).alias("doc_id"), F.col("_f.text").alias("text"),
            F.col("ends").alias("range"), F.lit(True).alias("tail"),
        )
    )
    both = rows.withColumn("tail", F.lit(False)).unionByName(tails)
    within = Window.partitionBy("range").orderBy("tail", F.col("doc_id").asc_nulls_last(), key)
    following = both.withColumn("next", F.lead("text").over(within))
    return following.filter(~F.col("tail")).select("doc_id", "text", "next")


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row per document: its own, its edited text's and its next document's likeness."""

    def make(texts: list[str], following: list[str]) -> tuple[None, list[list]]:
        last: tuple[str, Fingerprint] | None = None

        def of(text: str) -> Fingerprint:
            nonlocal last
            if last is None or last[0] != text:
                last = text, Fingerprint.of(text)
            return last[1]

        rows = []
        for text, after in zip(texts, following, strict=True):
            own, new = of(text), edited(text, after)
            changed = edited_fingerprint(own, text, new)
            rows.append((
                len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own.text(),
                changed.text(), own.likeness(changed), own.likeness(of(after)),
            ))
        return None, [list(c) for c in zip(*rows, strict=True)]

    added = (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return base.add_columns(followed(docs), make, added, ["text", "next"], ["doc_id"])
