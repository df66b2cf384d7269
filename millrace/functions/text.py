"""Text clean-up used by the cleansing jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(value: Column) -> Column:
    trimmed = F.trim(value)
    return F.when(trimmed != "", trimmed)


def normal_text(value: Column) -> Column:
    """Trimmed, single-spaced, lower case; blank text becomes NULL."""
    return blank_to_null(F.lower(F.regexp_replace(value, r"\s+", " ")))


def normal_email(value: Column) -> Column:
    return blank_to_null(F.lower(value))


def digits(value: Column) -> Column:
    """Only the digits of a text, NULL when it has none."""
    kept = F.regexp_replace(value, r"[^0-9]", "")
    return F.when(kept != "", kept)


def address_hash(parts: list[Column]) -> Column:
    """A key for one postal address, NULL when every part is blank.

    Parts are joined through JSON, so that a missing part and an empty neighbour cannot collide.
    """
    normal = [normal_text(p) for p in parts]
    named = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(normal)])
    return F.when(F.coalesce(*normal).isNotNull(), F.sha2(F.to_json(named), 256))
