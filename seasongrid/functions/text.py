"""Text clean-up, defaults and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def default_if_blank(value: Column, default: Column | str) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(is_blank(value), fallback).otherwise(value)


def hex_colour(value: Column, default: str) -> Column:
    """A landed colour has no leading ``#``; a blank one becomes the default."""
    return F.when(is_blank(value), F.lit(default)).otherwise(F.concat(F.lit("#"), value))


def code3(value: Column) -> Column:
    return F.upper(F.substring(value, 1, 3))


def logo_url(base: str, team_name: Column) -> Column:
    """Only spaces are escaped."""
    return F.concat(F.lit(base), F.replace(team_name, F.lit(" "), F.lit("%20")), F.lit(".png"))


def folder_name(round_number: Column, race_name: Column) -> Column:
    """Round with at least two digits, then the race name without spaces."""
    return F.concat_ws(
        "_",
        F.format_string("%02d", round_number),
        F.replace(race_name, F.lit(" "), F.lit("_")),
    )


def _unescaped(value: Column) -> Column:
    """Undo the percent escapes of a path; a plus sign is just a plus sign."""
    plus_kept = F.replace(value, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(plus_kept), value)


def path_segment(path: Column, from_end: int) -> Column:
    """A segment counted from the end of a file path, null if there is none.

    File metadata escapes what a URI may not hold, such as spaces.  A segment
    ``name=value`` written by a partitioned write yields its value, in which
    that write has escaped characters once more.
    """
    segment = _unescaped(F.try_element_at(F.split(path, "/"), F.lit(-from_end)))
    value = F.regexp_extract(segment, "^[A-Za-z_]+=(.*)$", 1)
    return F.when(value == "", segment).otherwise(_unescaped(value))


def folder_from_path(path: Column) -> Column:
    return path_segment(path, 2)


def season_from_path(path: Column) -> Column:
    return path_segment(path, 3).try_cast("int")


def season_by_pattern(path: Column) -> Column:
    """The four digits below the ``bronze`` folder, null if there are none."""
    return F.regexp_extract(path, r"bronze/(?:[A-Za-z_]+=)?(\d{4})/", 1).try_cast("int")
