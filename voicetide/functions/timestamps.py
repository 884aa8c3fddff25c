"""Polymorphic timestamps to naive UTC (TIMESTAMP_NTZ).

A landed timestamp is a JSON number (epoch seconds) or a string.  The JSON
type decides, so a numeric *string* is never read as an epoch.  Results do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Layout of microblog timestamps, weekday already removed.
MICROBLOG_FORMAT = "MMM d HH:mm:ss xx yyyy"

#: Other layouts by shape.  The value has no weekday and ends in an offset.
GENERAL_FORMATS = {
    r"(?i)^\d{4}-\d{1,2}-\d{1,2} .*[ap]m$": "yyyy-M-d h:mm[:ss][ ]a xx",
    r"(?i)^[a-z]{3} \d{1,2},? \d{4} .*[ap]m$": "MMM d[,] yyyy h:mm[:ss][ ]a xx",
    r"(?i)^[a-z]{4,9} \d{1,2},? \d{4} .*[ap]m$": "MMMM d[,] yyyy h:mm[:ss][ ]a xx",
    r"(?i)^\d{1,2}/\d{1,2}/\d{4} .*[ap]m$": "M/d/yyyy h:mm[:ss][ ]a xx",
    r"^\d{1,2} [A-Za-z]{3} ": "d MMM yyyy[ HH:mm[:ss]] xx",
    r"^\d{1,2} [A-Za-z]{4,9} ": "d MMMM yyyy[ HH:mm[:ss]] xx",
    r"^[A-Za-z]{3} \d{1,2},? \d{4}": "MMM d[,] yyyy[ HH:mm[:ss]] xx",
    r"^[A-Za-z]{4,9} \d{1,2},? \d{4}": "MMMM d[,] yyyy[ HH:mm[:ss]] xx",
    r"^[A-Za-z]{3} \d{4}$": "MMM yyyy xx",
    r"^[A-Za-z]{4,9} \d{4}$": "MMMM yyyy xx",
    r"^\d{8}$": "yyyyMMdd xx",
    r"^\d{4}/": "yyyy/M/d[ HH:mm[:ss]] xx",
    r"^\d{4}\.": "yyyy.M.d[ HH:mm[:ss]] xx",
    r"^\d{1,2}/": "M/d/yyyy[ HH:mm[:ss]] xx",
    r"^\d{1,2}-\d{1,2}-\d{4}": "M-d-yyyy[ HH:mm[:ss]] xx",
}

# Years 1 to 9999, in epoch seconds.
_EPOCH_MIN, _EPOCH_MAX = -62135596800, 253402300799


def _instant_to_utc(instant: Column) -> Column:
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))


def epoch_to_utc(seconds: Column) -> Column:
    in_range = seconds.between(_EPOCH_MIN, _EPOCH_MAX)
    return _instant_to_utc(F.timestamp_seconds(F.when(in_range, seconds)))


def text_to_utc(text: Column) -> Column:
    """Parse a timestamp string; null when nothing fits."""
    value = F.trim(text)
    # the year of a dashed date is no offset
    dashed = value.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$")
    zoned = value.rlike(r"(?i)(z|utc|gmt|[+-]\d{2}:?\d{2})$") & ~dashed
    iso = F.when(zoned, _instant_to_utc(F.try_to_timestamp(value))).otherwise(
        value.try_cast("timestamp_ntz")
    )
    plain = F.regexp_replace(value, r"^(?i)(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    microblog = F.try_to_timestamp(plain, F.lit(MICROBLOG_FORMAT))
    offset = F.regexp_replace(
        F.when(zoned, plain).otherwise(F.concat(plain, F.lit(" +0000"))),
        r"(?i)\s(gmt|utc|z)$", " +0000",
    )
    layout = F.lit(None).cast("string")
    for shape, pattern in reversed(GENERAL_FORMATS.items()):
        layout = F.when(plain.rlike(shape), F.lit(pattern)).otherwise(layout)
    other = F.coalesce(microblog, F.try_to_timestamp(offset, layout))
    is_iso = value.rlike(r"^\d{4}-\d{1,2}($|-\d{1,2})") & ~value.rlike(r"(?i)[ap]m$")
    return F.when(is_iso, iso).otherwise(_instant_to_utc(other))


def variant_is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def variant_text(value: Column) -> Column:
    """String form of a variant; null for a missing or JSON-null value."""
    return F.try_variant_get(value, "$", "string")


def truthy_variant(value: Column) -> Column:
    """The variant itself, or null when it is JSON null, ``""`` or 0."""
    zero = ~variant_is_text(value) & (F.try_variant_get(value, "$", "double") == 0)
    falsy = F.is_variant_null(value) | (variant_text(value) == "") | F.coalesce(zero, F.lit(False))
    return F.when(~F.coalesce(falsy, F.lit(False)), value)


def variant_to_utc(value: Column) -> Column:
    """Timestamp of a variant that holds a number or a string."""
    return F.when(variant_is_text(value), text_to_utc(variant_text(value))).otherwise(
        epoch_to_utc(F.try_variant_get(value, "$", "double"))
    )


def coerce_timestamp(col: Column) -> Column:
    """Bad dates become null (for text columns read back from CSV)."""
    return text_to_utc(col.cast("string"))
