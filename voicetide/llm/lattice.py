"""Sums over all segmentations of words into subword pieces, for many words at once.

Words of equal length are one array: piece lookups, the forward and the backward
recursion (in log space) run over all of them position by position.  Longer
words go through the same recursion one by one.

Log probabilities come as one array of twice the vocabulary's size: first for
pieces inside a word, then for those that end it.  Pieces that begin a word and
all others are two distributions, so the probabilities of all words sum to one.
"""

from __future__ import annotations

import functools
import math

import numpy as np

from voicetide.llm.vocab import SPACE, KeyTable, Pieces, pieces

#: Words up to this length (with the mark) share arrays; more words than this are cut in parts.
ARRAY_LENGTH = 24
ARRAY_WORDS = 20_000
#: A mark inside a word would read as a word's beginning; this stands for it.
FOREIGN_MARK = ""
_STEP = np.uint64(0xD1342543DE82EF95)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """The lookup of all substrings among the pieces, by a rolling 64-bit hash."""

    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        by_text = vocabulary.ids
        keys = np.array([self._key(p) for p in by_text], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces have the same hash")
        self.table = KeyTable(keys, np.array(list(by_text.values()), np.int32))

    @staticmethod
    def _key(piece: str) -> int:
        value = 0
        for char in piece:
            value = (value * int(_STEP) + (ord(char) + 1) * int(_MIX)) & 0xFFFFFFFFFFFFFFFF
        return value

    def arcs(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Per length l the piece ids [word, start], and the characters [word, position]."""
        n, length = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, length)
        mixed = (chars.astype(np.uint64) + np.uint64(1)) * _MIX
        key, found = np.zeros((n, length), np.uint64), []
        for size in range(1, min(length, self.vocabulary.longest) + 1):
            key = key[:, : length - size + 1] * _STEP + mixed[:, size - 1 :]
            found.append(self.table.find(key.ravel()).reshape(key.shape))
        return found, chars


@functools.lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(pieces(path))


def _marked(word: bytes) -> str:
    return SPACE + word.decode("utf-8", "replace").replace(SPACE, FOREIGN_MARK)


def by_length(words: list[bytes]) -> tuple[dict[int, list[int]], list[str]]:
    marked = [_marked(w) for w in words]
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(marked):
        groups.setdefault(len(word), []).append(i)
    return groups, marked


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    stack = np.stack(terms)
    top = stack.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(stack - safe).sum(axis=0))


def _spelled(lat: Lattice, char: str, ends: bool) -> list[int]:
    """Positions of the byte pieces of a character; the last one may end the word."""
    ids = lat.vocabulary.fallback(char)
    return [*ids[:-1], ids[-1] + lat.vocabulary.size] if ends else ids


def _weights(lat: Lattice, arcs: list[np.ndarray], chars: np.ndarray, log_p: np.ndarray) -> list:
    """Log probabilities of the arcs; a character outside the vocabulary is spelled in bytes."""
    size, length = lat.vocabulary.size, chars.shape[1]
    inside, ending = np.append(log_p[:size], -np.inf), np.append(log_p[size:], -np.inf)
    weights = [inside[a] for a in arcs]
    for n, (weight, ids) in enumerate(zip(weights, arcs, strict=True), 1):
        weight[:, length - n] = ending[ids[:, length - n]]
    for code in np.unique(chars[arcs[0] < 0]):
        here = (arcs[0] < 0) & (chars == code)
        for at, ends in ((slice(0, -1), False), (slice(-1, None), True)):
            spelled = sum(log_p[i] for i in _spelled(lat, chr(code), ends))
            weights[0][:, at][here[:, at]] = spelled
    return weights


def _forward(weights: list[np.ndarray], length: int) -> list[np.ndarray]:
    alpha = [np.zeros(len(weights[0]))]
    for end in range(1, length + 1):
        alpha.append(_log_sum([
            alpha[end - size] + weights[size - 1][:, end - size]
            for size in range(1, min(end, len(weights)) + 1)
        ]))
    return alpha


def _backward(weights: list[np.ndarray], length: int) -> list[np.ndarray]:
    beta = [np.zeros(0)] * length + [np.zeros(len(weights[0]))]
    for start in reversed(range(length)):
        beta[start] = _log_sum([
            beta[start + size] + weights[size - 1][:, start]
            for size in range(1, min(length - start, len(weights)) + 1)
        ])
    return beta


def log_likelihood(words: list[bytes], models: list[np.ndarray], path: str) -> np.ndarray:
    """Natural logs of the summed probability of all segmentations: [word, model]."""
    lat, out = lattice(path), np.zeros((len(words), len(models)))
    groups, marked = by_length(words)
    for length, members in groups.items():
        if length > ARRAY_LENGTH:
            for i in members:
                out[i] = [_one(lat, marked[i], log_p)[0][-1] for log_p in models]
            continue
        for first in range(0, len(members), ARRAY_WORDS):
            part = members[first : first + ARRAY_WORDS]
            arcs, chars = lat.arcs([marked[i] for i in part])
            for k, log_p in enumerate(models):
                out[part, k] = _forward(_weights(lat, arcs, chars, log_p), length)[-1]
    return out


def expected_counts(
    words: list[bytes], weight: np.ndarray, log_p: np.ndarray, path: str
) -> np.ndarray:
    """How often each piece is used, expected over all segmentations of the words."""
    lat, total = lattice(path), np.zeros(len(log_p))
    groups, marked = by_length(words)
    for length, members in groups.items():
        if length > ARRAY_LENGTH:
            for i in members:
                _one_count(lat, marked[i], float(weight[i]), log_p, total)
            continue
        for first in range(0, len(members), ARRAY_WORDS):
            part = members[first : first + ARRAY_WORDS]
            arcs, chars = lat.arcs([marked[i] for i in part])
            weights = _weights(lat, arcs, chars, log_p)
            alpha, beta = _forward(weights, length), _backward(weights, length)
            share = weight[part]
            pieces_, uses = [], []
            for size, ids in enumerate(arcs, 1):
                for start in range(length - size + 1):
                    used = np.flatnonzero(ids[:, start] >= 0)
                    log_use = (
                        alpha[start][used] + weights[size - 1][used, start]
                        + beta[start + size][used] - alpha[-1][used]
                    )
                    pieces_.append(
                        ids[used, start] + (start + size == length) * lat.vocabulary.size
                    )
                    uses.append(np.exp(log_use) * share[used])
            total += np.bincount(np.concatenate(pieces_), np.concatenate(uses), len(total))
            # no other arc covers a character outside the vocabulary
            row, at = np.nonzero(arcs[0] < 0)
            for r, position, code in zip(row, at, chars[row, at], strict=True):
                for i in _spelled(lat, chr(code), position == length - 1):
                    total[i] += share[r]
    return total


def _arcs(lat: Lattice, word: str, start: int, log_p: np.ndarray) -> list[tuple[int, list[int], float]]:
    vocabulary, found = lat.vocabulary, []
    for size in range(1, min(vocabulary.longest, len(word) - start) + 1):
        i = vocabulary.ids.get(word[start : start + size])
        ends = start + size == len(word)
        if i is not None:
            at = [i + ends * vocabulary.size]
        elif size == 1:
            at = _spelled(lat, word[start], ends)
        else:
            continue
        found.append((size, at, float(sum(log_p[k] for k in at))))
    return found


def _add(a: float, b: float) -> float:
    top, low = max(a, b), min(a, b)
    return top if low == -math.inf else top + math.log1p(math.exp(low - top))


def _one(lat: Lattice, word: str, log_p: np.ndarray) -> tuple[list[float], list]:
    alpha, arcs = [0.0] + [-math.inf] * len(word), []
    for start in range(len(word)):
        arcs.append(_arcs(lat, word, start, log_p))
        for size, _, weight in arcs[-1]:
            alpha[start + size] = _add(alpha[start + size], alpha[start] + weight)
    return alpha, arcs


def _one_count(lat: Lattice, word: str, share: float, log_p: np.ndarray, total: np.ndarray) -> None:
    alpha, arcs = _one(lat, word, log_p)
    beta = [-math.inf] * len(word) + [0.0]
    for start in reversed(range(len(word))):
        for size, ids, weight in arcs[start]:
            beta[start] = _add(beta[start], weight + beta[start + size])
            use = math.exp(alpha[start] + weight + beta[start + size] - alpha[-1])
            for i in ids:
                total[i] += share * use
