"""Casts that yield null for what does not fit."""

from __future__ import annotations

from pyspark.sql import Column

_WHOLE = ("int", "long")


def to_type(value: Column, kind: str) -> Column:
    """Text to ``kind``.

    Whole numbers take the way over a decimal, so that ``12.0`` is 12 as it
    would be for a number read as such, and long keys keep all their digits.
    """
    return value.try_cast("decimal(38,6)").try_cast(kind) if kind in _WHOLE else value.try_cast(kind)
