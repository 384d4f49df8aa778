"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seasongrid.config import ENTRANT_KEY_STRIDE


def entrant_key(year: Column, number: Column, stride: int = ENTRANT_KEY_STRIDE) -> Column:
    """Season and start number in one long, unique for any number that is not negative.

    Numbers at or above ``stride`` would meet keys of another season; theirs are
    negative, with the number before the season.
    """
    year, number, width = year.cast("long"), number.cast("long"), F.lit(stride).cast("long")
    return F.when(number >= width, -(number * F.lit(10_000).cast("long") + year)).otherwise(year * width + number)


def team_key(name: Column, year: Column) -> Column:
    """Trimmed team name, a dash and the season; null if either is null."""
    return F.concat(F.trim(name), F.lit("-"), year.cast("string"))


def name_or_number(name: Column, number: Column) -> Column:
    """A join key for names that spreads null names over the start numbers.

    A null name never equals anything, but an outer join still sends all null
    keys to one task.  The prefix keeps the stand-in from meeting a real name.
    """
    return F.coalesce(name, F.concat(F.lit("\u0000"), number.cast("string")))
