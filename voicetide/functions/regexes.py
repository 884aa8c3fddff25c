"""Regex counting and classification as native expressions.

Patterns ignore case the Unicode way.  For plain ASCII patterns that costs a
slow case conversion per character and alternative, so they take a faster
route with the same matches: the four non-ASCII characters that fold to an
ASCII letter are replaced first (``fold``), the pattern then ignores ASCII
case only, and a look-ahead on the first characters rejects most positions
before any alternative is tried.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from voicetide.config import Taxonomy

#: Case-insensitive, Unicode case folding, ``.`` stops at ``\n`` only.
FLAGS = "(?iud)"
ASCII_FLAGS = "(?id)"

# Characters outside ASCII that fold to an ASCII letter.
FOLDS = {"İ": "i", "ı": "i", "ſ": "s", "K": "k"}

_PLAIN = re.compile(r"[A-Za-z0-9 @,;:'/_.?*+()|-]+")
_GUARD_LENGTH = 3
_GROUP_FROM, _GROUP_LETTERS = 8, 5


def fold(text: Column) -> Column:
    """Text with the special characters of ``FOLDS`` replaced."""
    for special, letter in FOLDS.items():
        text = F.replace(text, F.lit(special), F.lit(letter))
    return text


def _alternatives(pattern: str) -> list[str]:
    """Top-level alternatives of a pattern without escapes or classes."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(pattern):
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "|" and depth == 0:
            parts.append(pattern[start:i])
            start = i + 1
    return [*parts, pattern[start:]]


def _literal_prefix(alternative: str) -> str:
    prefix = re.match(r"[A-Za-z0-9 @,;:'/_-]*", alternative).group()
    follows = alternative[len(prefix):len(prefix) + 1]
    return prefix[:-1] if follows in ("?", "*", "+") and follows else prefix


def _guard(pattern: str) -> str:
    """A look-ahead every match must satisfy, or nothing."""
    prefixes = [_literal_prefix(a)[:_GUARD_LENGTH].lower() for a in _alternatives(pattern)]
    length = min(len(p) for p in prefixes)
    classes = []
    for i in range(length):
        letters = "".join(sorted({p[i] for p in prefixes})).replace("-", "\\-")
        classes.append(f"[{letters}]")
    return f"(?={''.join(classes)})" if classes else ""


def _arranged(pattern: str) -> str:
    """The same alternation, tried in a few groups with a look-ahead each.

    Alternatives that start with different letters never match at the same
    place, so only the order among equal first letters has to be kept.
    """
    alternatives = _alternatives(pattern)
    first = {a: _literal_prefix(a)[:1].lower() for a in alternatives}
    letters = sorted(set(first.values()))
    if letters[0] == "" or len(alternatives) <= _GROUP_FROM:
        return pattern
    groups = []
    for start in range(0, len(letters), _GROUP_LETTERS):
        chosen = letters[start:start + _GROUP_LETTERS]
        part = "|".join(a for a in alternatives if first[a] in chosen)
        groups.append(f"{_guard(part)}(?:{part})")
    return "|".join(groups)


@dataclass(frozen=True)
class Lexicon:
    """A list of patterns as one alternation.

    The order inside it decides between overlapping patterns.  ``regex`` is to
    be matched against the folded text if ``folded`` is set.
    """

    regex: str
    folded: bool

    @classmethod
    def of(cls, patterns: Iterable[str] | str) -> Lexicon:
        joined = patterns if isinstance(patterns, str) else "|".join(patterns)
        if _PLAIN.fullmatch(joined) and "(?" not in joined:
            return cls(f"{ASCII_FLAGS}{_guard(joined)}(?:{_arranged(joined)})", True)
        return cls(FLAGS + joined, False)


def count_hits(text: Column, folded: Column, patterns: Sequence[str] | str) -> Column:
    """Non-overlapping matches of the whole alternation; null text counts 0."""
    lexicon = Lexicon.of(patterns)
    hits = F.regexp_count(folded if lexicon.folded else text, F.lit(lexicon.regex))
    return F.coalesce(hits, F.lit(0))


def has_hit(text: Column, folded: Column, patterns: Sequence[str] | str) -> Column:
    lexicon = Lexicon.of(patterns)
    return F.coalesce((folded if lexicon.folded else text).rlike(lexicon.regex), F.lit(False))


def bucket_hits(text: Column, folded: Column, taxonomy: Taxonomy) -> Column:
    """Array of (hits, -position, bucket) for the buckets that match.

    Most texts may match no bucket at all: where all lexicons take the fast route, one
    search over all of them, which ends with its first match, spares those texts the counts.
    """
    scored = [
        F.struct(
            count_hits(text, folded, bucket.patterns).alias("hits"),
            F.lit(-position).alias("rank"),
            F.lit(bucket.key).alias("bucket"),
        )
        for position, bucket in enumerate(taxonomy.buckets)
    ]
    found = F.filter(F.array(*scored), lambda s: s["hits"] > 0)
    if not all(Lexicon.of(bucket.patterns).folded for bucket in taxonomy.buckets):
        return found
    every = [p for bucket in taxonomy.buckets for p in bucket.patterns]
    none = F.array().cast("array<struct<hits:int,rank:int,bucket:string>>")
    return F.when(has_hit(text, folded, every), found).otherwise(none)


def best_bucket(matched: Column, taxonomy: Taxonomy) -> Column:
    """Most hits, ties to the earliest bucket, the default when none match."""
    return F.coalesce(F.array_max(matched)["bucket"], F.lit(taxonomy.default.key))


def match_confidence(matched: Column) -> Column:
    found = F.size(matched)
    return (
        F.when(found == 1, F.lit(1.0)).when(found > 1, F.lit(0.8)).otherwise(F.lit(0.5))
    )


def sentiment_of(balance: Column) -> Column:
    """Label for negative hits minus positive hits."""
    return (
        F.when(balance > 0, F.lit("Negative"))
        .when(balance < 0, F.lit("Positive"))
        .otherwise(F.lit("Neutral"))
    )
