"""Scalar helpers: falsy-coalesce, shares, growth, display strings."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a full strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def first_truthy(cols: Sequence[Column], default: Any, empty: Any = "") -> Column:
    """First value that is neither null nor ``empty``; ``default`` otherwise."""
    return F.coalesce(*[F.nullif(c, F.lit(empty)) for c in cols], F.lit(default))


def first_nonzero(cols: Sequence[Column]) -> Column:
    return first_truthy(cols, default=0, empty=0).cast("bigint")


def null_to_zero_sum(cols: Sequence[Column]) -> Column:
    """Additive score where a missing part counts as zero."""
    total = F.lit(0).cast("bigint")
    for c in cols:
        total = total + F.coalesce(c, F.lit(0))
    return total


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(WHITESPACE))


def fill_text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def share_pct(part: Column, whole: Column) -> Column:
    """Percent with one digit, half-even; 0 when the whole is 0."""
    return F.coalesce(F.bround(F.try_divide(part, whole) * 100, 1), F.lit(0.0))


def growth_pct(before: Column, after: Column, zero_base: str = "null") -> Column:
    """Percent change with one digit.

    ``zero_base`` says what a zero base means: ``"null"`` gives null,
    ``"clamp"`` divides by 1 instead.
    """
    if zero_base == "null":
        base = before
    elif zero_base == "clamp":
        base = F.greatest(before, F.lit(1))
    else:
        raise ValueError(f"zero_base must be 'null' or 'clamp', not {zero_base!r}")
    return F.bround(F.try_divide(after - before, base) * 100, 1)


def signed_pct_label(before: Column, after: Column) -> Column:
    """``+x.x%`` string, ``N/A`` when the base is zero."""
    pct = F.try_divide(after - before, before) * 100
    text = F.concat(
        F.when(pct >= 0, F.lit("+")).otherwise(F.lit("")),
        F.bround(pct, 1).cast("decimal(20,1)").cast("string"),
        F.lit("%"),
    )
    return F.coalesce(text, F.lit("N/A"))


def growth_label(growth: Column, unit: str = "% MoM") -> Column:
    """``New`` for no or zero growth, otherwise the signed number."""
    # through a decimal, as a large double prints in scientific notation
    number = F.concat(growth.cast("decimal(38,1)").cast("string"), F.lit(unit))
    return (
        F.when(growth.isNull() | (growth == 0), F.lit("New"))
        .when(growth > 0, F.concat(F.lit("+"), number))
        .otherwise(number)
    )


def number_label(value: Column) -> Column:
    """Whole number with thousands separators; anything else unchanged."""
    return F.coalesce(F.format_number(value.try_cast("bigint"), 0), value.cast("string"))


def snippet(col: Column, length: int) -> Column:
    return F.substring(col, 1, length)


def day_label(date: Column) -> Column:
    """``yyyy-MM-dd``; the cast needs no time zone, unlike a date format."""
    return F.substring(date.cast("string"), 1, 10)


def second_label(date: Column) -> Column:
    return F.substring(date.cast("string"), 1, 19)


def plain_label(label: Column) -> Column:
    """Bucket label without its ``A. `` prefix."""
    return F.element_at(F.split(label, r"\. ", 2), -1)


def title_case(col: Column) -> Column:
    """Every run of letters with a capital first letter."""
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def month_name(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "MMMM"), F.lit("Unknown"))


def month_number(date: Column) -> Column:
    return F.coalesce(F.month(date), F.lit(0))
