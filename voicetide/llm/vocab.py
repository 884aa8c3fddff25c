"""The pieces of a SentencePiece file, and lookups of many keys at once."""

from __future__ import annotations

import functools

import numpy as np

SPACE = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class KeyTable:
    """uint64 keys -> int32 values by open addressing, for whole arrays of keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 8).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        keys = keys.astype(np.uint64)
        slots = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            # the first key of each free slot gets it, the others move on
            free = self.values[slots[left]] < 0
            _, first = np.unique(slots[left[free]], return_index=True)
            placed = left[free][first]
            self.keys[slots[placed]] = keys[placed]
            self.values[slots[placed]] = values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where a key is not in the table."""
        slots = self._slot(keys)
        found = self.values[slots]
        wrong = np.flatnonzero((self.keys[slots] != keys) & (found >= 0))
        found[wrong] = -1
        at = slots[wrong]
        while len(wrong):
            at = (at + 1) & ((1 << self.bits) - 1)
            value = self.values[at]
            hit = (self.keys[at] == keys[wrong]) & (value >= 0)
            found[wrong[hit]] = value[hit]
            on = ~hit & (value >= 0)
            wrong, at = wrong[on], at[on]
        return found


class Pieces:
    """Pieces with their scores; byte pieces stand for characters outside the vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.text: list[str] = [model.id_to_piece(i) for i in range(self.size)]
        self.score = np.array([model.get_score(i) for i in range(self.size)])
        self.byte_id = [-1] * 256
        self.ids: dict[str, int] = {}
        for i, piece in enumerate(self.text):
            if model.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
        self.byte_of = {i: bytes([b]) for b, i in enumerate(self.byte_id)}
        self.longest = max(map(len, self.ids))

    def fallback(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode("utf-8", "replace")]


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One per worker process."""
    return Pieces(path)
