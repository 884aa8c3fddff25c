"""SentencePiece merge encoding with seeded merge-dropout, and lossless decoding.

Encoding runs the merge agenda of a byte-fallback merge model: the best adjacent
pair (highest score, then leftmost) is taken from the agenda and merged, but
each candidate that comes up is skipped for good with probability ``dropout``.
The decision is a keyed hash of (seed, variant, number of the candidate), and an
occurrence's variant is a keyed hash of (seed, text key, position), one of
``VARIANTS``.  So equal seeds and keys give equal pieces on any cluster, and
other seeds other segmentations.  With dropout 0 the result is the model's own.

No piece crosses the beginning of a run of spaces, so words are encoded apart.
Words of equal length run their agendas in step, one array operation for all of
them; each (word, variant) is encoded once per slice, and once for all variants
that skip none of its candidates.

Defined results.  Null or empty text: no pieces, decoded as empty text.  A
literal word mark in the text is spelled in bytes, as all characters outside the
vocabulary are, so every text decodes to itself.  Missing keys: as the hash of
null.  Repeated rows: the same pieces.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.llm import base
from voicetide.llm.vocab import SPACE, KeyTable, Pieces, default_pieces, pieces

DROPOUT = 0.1
SEED = 2024
VARIANTS = 1024
#: Candidates whose decisions are tabulated, and the symbols of a word that can't exceed
#: them: n symbols bring up at most 3 (n - 1) candidates.
TABLE = 64
ARRAY_LENGTH = 22
ARRAY_WORDS = 50_000
CACHE_WORDS = 300_000
#: Stands for a literal word mark; no valid text holds it.
LITERAL = "\udfff"
NONE = np.iinfo(np.int32).max
_GOLDEN = 0x9E3779B97F4A7C15


def mix(value: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def keyed(seed: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit hashes of (seed, first, second)."""
    golden = np.uint64(_GOLDEN)
    start = mix(np.array([seed % 2**64], np.uint64) + golden)
    inner = mix(start + first.astype(np.uint64) * golden)
    return mix(inner + (second.astype(np.uint64) + np.uint64(1)) * golden)


class Encoder:
    """The merges of one vocabulary with the decisions of one seed."""

    def __init__(self, vocabulary: Pieces, dropout: float, seed: int):
        self.vocabulary, self.dropout, self.seed = vocabulary, dropout, seed
        ids = vocabulary.ids
        by_score = sorted(ids.values(), key=lambda i: (-vocabulary.score[i], i))
        self.piece_at = np.array(by_score, np.int64)
        self.rank = {piece: r for r, piece in enumerate(by_score)}
        self.pairs: dict[tuple[int, int], int] = {}
        for text, piece in ids.items():
            for cut in range(1, len(text)):
                left, right = ids.get(text[:cut]), ids.get(text[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = self.rank[piece]
        keys = np.array([a << 32 | b for a, b in self.pairs], np.uint64)
        self.table = KeyTable(keys, np.array(list(self.pairs.values()), np.int32))
        self.limit = min(int(dropout * 2.0**64), 2**64 - 1) if dropout > 0 else 0
        variant, number = np.divmod(np.arange(VARIANTS * TABLE), TABLE)
        self.skips = self.decide(variant, number).reshape(VARIANTS, TABLE)
        self.first_skip = np.where(self.skips.any(1), self.skips.argmax(1), TABLE)
        inner = any(SPACE in t.lstrip(SPACE) for t in ids)
        if inner:
            raise ValueError("a piece holds a space after another character")
        apart = "" if any("\n" in t for t in ids) else "\n"
        self.units = re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + (f"|{apart}" if apart else ""))
        self.plain: dict[str, tuple[int, bytes]] = {}
        self.raw = [t.replace(SPACE, " ").encode() for t in vocabulary.text]
        for i, byte in vocabulary.byte_of.items():
            self.raw[i] = byte

    def decide(self, variant: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether the candidate of this number is skipped in this variant."""
        return keyed(self.seed, variant, number) < np.uint64(self.limit)

    def variants(self, key: int, n: int) -> np.ndarray:
        """The variants of a text's first n words."""
        hashes = keyed(self.seed + 1, np.array([key % 2**64], np.uint64), np.arange(n))
        return (hashes % np.uint64(VARIANTS)).astype(np.int64)

    def spell(self, char: str) -> list[int]:
        return self.vocabulary.fallback(SPACE if char == LITERAL else char)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of two symbols each; ``NONE`` where there is none."""
        both = (left >= 0) & (right >= 0)
        found = self.table.find(
            (np.maximum(left, 0).astype(np.uint64) << np.uint64(32))
            | np.maximum(right, 0).astype(np.uint64)
        )
        return np.where(both & (found >= 0), found, NONE).astype(np.int32)

    def in_step(
        self, words: list[str], variants: np.ndarray | None
    ) -> tuple[list[bytes], np.ndarray]:
        """(packed ids, candidates that came up) of words of one length.

        Without ``variants`` no candidate is skipped.
        """
        n, length = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes, at = np.unique(chars, return_inverse=True)
        ids = np.array([self.vocabulary.ids.get(chr(c), -2 - c) for c in codes.tolist()], np.int64)
        symbol = np.full((n, length + 1), -1, np.int64)  # the last column is the end
        symbol[:, :length] = ids[at].reshape(n, length)
        after = np.tile(np.arange(1, length + 2), (n, 1))
        before = np.tile(np.arange(-1, length), (n, 1))
        agenda = np.full((n, length + 1), NONE, np.int32)
        if length > 1:
            agenda[:, : length - 1] = self._find(
                symbol[:, : length - 1].ravel(), symbol[:, 1:length].ravel()
            ).reshape(n, -1)
        dead = np.zeros((n, length + 1), bool)
        dead[:, length] = True
        came_up = np.zeros(n, np.int64)
        rows, number = np.arange(n), 0
        while True:
            spot = agenda[rows].argmin(axis=1)
            best = agenda[rows, spot]
            open_ = best < NONE
            rows, spot, best = rows[open_], spot[open_], best[open_]
            if not len(rows):
                break
            came_up[rows] += 1
            if variants is not None:
                skip = self.skips[variants[rows], number]
                agenda[rows[skip], spot[skip]] = NONE
                r, j, merged = rows[~skip], spot[~skip], best[~skip]
            else:
                r, j, merged = rows, spot, best
            gone = after[r, j]
            follow = after[r, gone]
            symbol[r, j] = self.piece_at[merged]
            dead[r, gone] = True
            agenda[r, gone] = NONE
            after[r, j] = follow
            inside = follow < length
            before[r[inside], follow[inside]] = j[inside]
            agenda[r, j] = np.where(
                inside, self._find(symbol[r, j], symbol[r, np.minimum(follow, length)]), NONE
            )
            prior = before[r, j]
            has = prior >= 0
            r, j, prior = r[has], j[has], prior[has]
            agenda[r, prior] = self._find(symbol[r, prior], symbol[r, j])
            number += 1
        return self._pack(symbol, ~dead), came_up

    def _pack(self, symbol: np.ndarray, alive: np.ndarray) -> list[bytes]:
        sizes = alive.sum(axis=1)
        values = symbol[alive]
        if (values < 0).any():  # spell the characters outside the vocabulary
            spelled = {c: self.spell(chr(-2 - c)) for c in np.unique(values[values < 0]).tolist()}
            owner = np.repeat(np.arange(len(sizes)), sizes)
            extra = np.array([len(spelled[v]) if v < 0 else 1 for v in values.tolist()])
            sizes = np.bincount(owner, extra, len(sizes)).astype(np.int64)
            values = np.fromiter(
                chain.from_iterable(spelled[v] if v < 0 else (v,) for v in values.tolist()), np.int64
            )
        packed = values.astype("<i4").tobytes()
        ends = (np.cumsum(sizes) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def one(self, word: str, variant: int | None) -> tuple[bytes, int]:
        """The same for a single word of any length, with a heap as agenda."""
        ids, n = self.vocabulary.ids, len(word)
        symbol = [ids.get(c, -2 - ord(c)) for c in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            rank = self.pairs.get((symbol[i], symbol[j]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbol[i], symbol[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        came_up, known = 0, np.zeros(0, bool)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if symbol[i] == left else n
            if j >= n or symbol[j] != right:
                continue  # one of the two was merged meanwhile
            if variant is not None:
                if came_up >= len(known):
                    numbers = np.arange(len(known), 2 * len(known) + TABLE)
                    more = self.decide(np.full(len(numbers), variant), numbers)
                    known = np.concatenate([known, more])
                skip = bool(known[came_up])
            else:
                skip = False
            came_up += 1
            if skip:
                continue
            symbol[i], symbol[j] = int(self.piece_at[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        out: list[int] = []
        i = 0
        while i < n:
            out.extend([symbol[i]] if symbol[i] >= 0 else self.spell(chr(-2 - symbol[i])))
            i = after[i]
        return np.array(out, "<i4").tobytes(), came_up

    def encode_words(
        self, words: list[str], variants: np.ndarray | None
    ) -> tuple[list[bytes], np.ndarray]:
        packed: list[bytes] = [b""] * len(words)
        came_up = np.zeros(len(words), np.int64)
        groups: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            groups.setdefault(len(word), []).append(i)
        for length, members in groups.items():
            if length > ARRAY_LENGTH:
                for i in members:
                    variant = None if variants is None else int(variants[i])
                    packed[i], came_up[i] = self.one(words[i], variant)
                continue
            for first in range(0, len(members), ARRAY_WORDS):
                part = members[first : first + ARRAY_WORDS]
                chosen = None if variants is None else variants[part]
                made, up = self.in_step([words[i] for i in part], chosen)
                came_up[part] = up
                for i, ids in zip(part, made, strict=True):
                    packed[i] = ids
        return packed, came_up

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        marked = text.replace(SPACE, LITERAL).replace(" ", SPACE)
        return self.units.findall(SPACE + marked)

    def encode(self, texts: list[str | None], keys: list[int]) -> list[bytes]:
        """Packed little-endian int32 ids of whole texts."""
        split = [self.split(t) for t in texts]
        codes: dict[str, int] = {}
        at = np.fromiter(
            (codes.setdefault(w, len(codes)) for w in chain.from_iterable(split)), np.int64
        )
        names = list(codes)
        if len(self.plain) > CACHE_WORDS:
            self.plain.clear()
        missing = [w for w in names if w not in self.plain]
        made, up = self.encode_words(missing, None)
        known = dict(zip(missing, zip(up.tolist(), made, strict=True), strict=True))
        plain = [known[w] if w in known else self.plain[w] for w in names]
        self.plain |= known
        ids = [packed for _, packed in plain]
        out = [ids[i] for i in at.tolist()]
        if self.limit and len(at):
            variants = np.concatenate(
                [self.variants(k, len(w)) for k, w in zip(keys, split, strict=True)]
            )
            candidates = np.array([n for n, _ in plain], np.int64)
            # a word longer than the table may still be skipped beyond it
            hit = np.flatnonzero(
                (self.first_skip[variants] < candidates[at]) | (candidates[at] > TABLE)
            )
            both, place = np.unique(at[hit] * VARIANTS + variants[hit], return_inverse=True)
            word, variant = np.divmod(both, VARIANTS)
            varied, _ = self.encode_words([names[i] for i in word.tolist()], variant)
            for i, p in zip(hit.tolist(), place.tolist(), strict=True):
                out[i] = varied[p]
        ends = np.cumsum([len(w) for w in split]).tolist()
        return [b"".join(out[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces and byte pieces are bytes in a row."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def encoder(path: str, dropout: float, seed: int) -> Encoder:
    """One per task: the cache of words outlives a slice."""
    return base.kept(("encoder", path, dropout, seed), lambda: Encoder(pieces(path), dropout, seed))


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, packed)]) // 4
    values = np.frombuffer(b"".join(packed), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode(
    docs: DataFrame,
    keep: list[str],
    key: Column | None = None,
    dropout: float = DROPOUT,
    seed: int = SEED,
    path: str | None = None,
) -> DataFrame:
    """The columns ``keep``, ``pieces``, and ``lossless``: whether they decode to the text.

    ``key`` (a long) varies segmentations by text.
    """
    path = path or default_pieces()
    name = base.free_name(docs, "_key")
    rows = docs.withColumn(name, F.xxhash64("doc_id") if key is None else key)

    def make(texts: list[str | None], keys: list[int]) -> tuple[None, list]:
        coder = encoder(path, dropout, seed)
        packed = coder.encode(texts, keys)
        same = [
            coder.decode(np.frombuffer(p, "<i4").tolist()) == (t or "")
            for p, t in zip(packed, texts, strict=True)
        ]
        return None, [_lists(packed), same]

    return base.add_columns(rows, make, "pieces array<int>, lossless boolean", ["text", name], keep)


def decode(rows: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the text of ``pieces``."""
    path = path or default_pieces()

    def make(found: list[list[int] | None]) -> tuple[None, list[list[str]]]:
        return None, [[encoder(path, 0.0, 0).decode(ids or []) for ids in found]]

    return base.add_columns(rows, make, "decoded string", ["pieces"], keep)
