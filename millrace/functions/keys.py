"""Partition keys computed from the columns that feeds are delivered under.

Every function gives NULL for text that is not a real date or hour, so that the row can be kept
under the NULL partition and reported.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_TS_FORMATS = ("yyyyMMddHH", "yyyy-MM-dd-HH", "yyyyMMdd", "yyyy-MM-dd")
DATE_FORMATS = ("yyyyMMdd", "yyyy-MM-dd")

# Patterns of text that Spark casts to a timestamp as it stands.
CASTABLE = (
    "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
)


def shape_of(pattern: str) -> str:
    """A regular expression for texts that a numeric date pattern could read.

    A failed parse costs far more than this test, because it is an exception inside Spark; so a
    pattern is tried only on text of its shape. A fraction may have 1 to 9 digits.
    """
    shape = ""
    for letters, literal in _runs(pattern):
        if not letters:
            shape += re.escape(literal)
        else:
            one = r"\d{1,2}" if len(letters) == 1 else rf"\d{{{len(letters)}}}"
            shape += r"\d{1,9}" if letters[0] == "S" else one
    return f"^{shape}$"


def standard_text(text: Column, pattern: str) -> Column | None:
    """Text of a fixed-width pattern rearranged to ``yyyy-MM-dd HH:mm:ss.SSSSSS``, as far as the
    pattern goes. None for patterns with fields of varying width.

    Spark casts such text several times faster than it parses by a pattern, and by the same rules.
    """
    if pattern in CASTABLE:
        return text
    pieces: dict[str, Column] = {}
    start = 1
    for letters, literal in _runs(pattern):
        if len(letters) == 1:
            return None
        if letters:
            pieces[letters[0]] = F.substr(text, F.lit(start), F.lit(len(letters)))
        start += len(letters) + len(literal)
    if not {"y", "M", "d"} <= set(pieces):
        return None
    parts = [pieces["y"], F.lit("-"), pieces["M"], F.lit("-"), pieces["d"]]
    if "H" in pieces:
        zeros = F.lit("00")
        parts += [F.lit(" "), pieces["H"], F.lit(":"), pieces.get("m", zeros), F.lit(":"), pieces.get("s", zeros)]
    if "S" in pieces:
        parts += [F.lit("."), pieces["S"]]
    return F.concat(*parts)


def _runs(pattern: str) -> list[tuple[str, str]]:
    """A pattern as (letters of one field, "") and ("", literal text) pairs."""
    found = re.findall(r"'([^']*)'|(([A-Za-z])\3*)|([^A-Za-z'])", pattern)
    return [(field, quoted or other) for quoted, field, _, other in found]


def parse_timestamp(text: Column, formats: tuple[str, ...]) -> Column:
    """The first format that fits the text."""

    def read(pattern: str) -> Column:
        standard = standard_text(text, pattern)
        return F.try_to_timestamp(text, F.lit(pattern)) if standard is None else standard.try_cast("timestamp")

    return F.coalesce(*[F.when(text.rlike(shape_of(f)), read(f)) for f in formats])


def parse_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    def read(pattern: str) -> Column:
        standard = standard_text(text, pattern)
        return F.try_to_date(text, pattern) if standard is None else standard.try_cast("date")

    return F.coalesce(*[F.when(text.rlike(shape_of(f)), read(f)) for f in formats])


def hour_from_text(date_ts: Column, formats: tuple[str, ...] = DATE_TS_FORMATS) -> Column:
    """Hour or day text to a timestamp at the start of its hour."""
    return F.date_trunc("HOUR", parse_timestamp(date_ts, formats))


def date_from_text(date_ts: Column, formats: tuple[str, ...] = DATE_TS_FORMATS) -> Column:
    """Hour or day text to its date."""
    return F.to_date(parse_timestamp(date_ts, formats))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    zero = F.lit(0)
    midnight = F.try_make_timestamp_ntz(
        year.try_cast("int"), month.try_cast("int"), day.try_cast("int"), zero, zero, zero
    )
    return F.to_date(midnight)


def month_from_parts(year: Column, month: Column) -> Column:
    """The first day of a month."""
    return date_from_parts(year, month, F.lit(1))


def hour_from_date_and_bucket(event_date: Column, hour_bucket: Column) -> Column:
    """A date text and an hour number 0 to 23 to a timestamp."""
    day = parse_date(event_date)
    zero = F.lit(0)
    return F.try_make_timestamp(
        F.year(day), F.month(day), F.day(day), hour_bucket.try_cast("int"), zero, zero
    )
