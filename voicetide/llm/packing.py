"""Packing by power-of-two decomposition.

A document of n tokens becomes n // 2048 pieces of 2048 and one piece for each
set bit of the rest, longest first.  Every piece is a sequence of its own:
sequences hold tokens of one document only, all have a power of two as length,
and nothing is padded.  Batches are formed within a bucket of equal lengths
(``write_buckets``), so no batch is padded either.

Defined results.  Null or empty text: the end id alone, one piece of length 1.
Repeated rows and repeated or missing ids: each row is a document of its own.
An empty table gives an empty result.  Memory: one document's ids at a time and
a word cache of at most ``CACHE_WORDS``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicetide.llm import base

MAX_TOKENS = 2048
END_ID = 1
CACHE_WORDS = 800_000
#: What a piece at the end of a word ends with in this vocabulary.
WORD_END = "</w>"
PIECES = "start long, length long, doc_tokens long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of whole texts, through a cache of words.

    The tokenizer drops white space and never merges across it, and it cuts
    between a letter and the mark after it, so a text's ids are those of its
    words one after another.  Its ids are kept packed (little-endian uint32).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.cache: dict[bytes, bytes] = {}
        self.marks = {m: self._direct([m.decode()])[0] for m in (b".", b",")}

    def _direct(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only: each is one word to the tokenizer as well, so they go
        through it as one text, and pieces that end a word tell them apart."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(ends) != len(words):
            return self._direct(words)
        packed, ends = ids.tobytes(), ends.tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    @staticmethod
    def words(text: str) -> list[bytes]:
        raw = text.encode("utf-8", "replace")
        # lower case is the tokenizer's own first step, but special tokens are
        # looked up before it, so texts that may hold one keep their case
        return (raw if b"<|" in raw else raw.lower()).split()

    def learn(self, words: set[bytes]) -> None:
        """Puts all words into the cache, in one call of the tokenizer."""
        cache = self.cache
        missing = [w for w in words if w not in cache]
        if len(cache) + len(missing) > CACHE_WORDS:
            cache.clear()
            missing = list(words)
        bare: dict[bytes, bytes] = {}
        plain: set[bytes] = set()
        for word in missing:
            # b"word," is b"word" and b"," when a plain letter stands before the mark
            if word[-1:] in self.marks and word[-2:-1].isalpha():
                bare[word] = word[:-1]
                if word[:-1] not in cache:
                    plain.add(word[:-1])
            else:
                plain.add(word)
        letters, others = [], []
        for word in plain:
            text = word.decode()
            (letters if text.isalpha() else others).append((word, text))
        for group, encode in ((letters, self._letters), (others, self._direct)):
            ids = encode([t for _, t in group])
            cache.update(zip([w for w, _ in group], ids, strict=True))
        for word, stem in bare.items():
            cache[word] = cache[stem] + self.marks[word[-1:]]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        split = [self.words(t or "") for t in texts]
        for first in range(0, len(split), 256):
            part = split[first : first + 256]
            self.learn(set().union(*part))
            get = self.cache.__getitem__
            for words in part:
                yield b"".join(map(get, words))


def word_ids(path: str) -> WordIds:
    """One per task: the cache outlives a batch."""
    return base.kept(("word ids", path), lambda: WordIds(path))


def lengths(n: int, most: int = MAX_TOKENS) -> list[int]:
    """Powers of two, at most ``most``, that add up to n; longest first."""
    found = [most] * (n // most)
    rest = n % most
    found += [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    return found


def pieces(
    docs: DataFrame, tokenizer: str | None = None, most: int = MAX_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """All pieces of all documents: the other columns of ``docs`` and ``PIECES``.

    ``ids`` are packed little-endian unsigned 32-bit numbers; ``sequence_id``
    is unique and ``offset`` is 0, as a piece fills its sequence; ``bucket`` is
    the binary logarithm of its length.
    """
    if most & (most - 1):
        raise ValueError("the longest length must be a power of two")
    path = tokenizer or default_tokenizer()
    added = T.StructType.fromDDL(PIECES)
    own = {f.name for f in added} | {"text", "sequence_id", "offset", "bucket"}
    keep = [c for c in docs.columns if c.lower() not in own]  # a clashing column gives way
    end = end_id.to_bytes(4, "little")

    def make(texts: list[str | None]) -> tuple[list[int], list[list]]:
        parents: list[int] = []
        out: list[list] = [[], [], [], []]
        for row, ids in enumerate(word_ids(path).encode(texts)):
            ids += end
            total, start = len(ids) // 4, 0
            for length in lengths(total, most):
                values = (start, length, total, ids[4 * start : 4 * (start + length)])
                for column, value in zip(out, values, strict=True):
                    column.append(value)
                parents.append(row)
                start += length
        return parents, out

    made = base.add_columns(docs, make, added, ["text"], keep)
    return made.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, a folder per length; a hot bucket gives several files."""
    packed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    """Per piece: where it lies, and the crc32 of its ids instead of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )
