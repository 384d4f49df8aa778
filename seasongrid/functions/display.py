"""Display formats of dates and points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_date(value: Column) -> Column:
    return F.date_format(value, "dd/MM/yyyy")


def _trimmed(value: Column, digits: int) -> Column:
    return F.call_function("format_number", value, F.lit("0." + "#" * digits))


def display_points(value: Column) -> Column:
    """Up to two decimals; a dash for zero; nothing for a negative value."""
    shown = F.round(value.cast("double"), 2)
    return (
        F.when(shown > 0, _trimmed(shown, 2))
        .when(shown < 0, F.lit(""))
        .when(shown == 0, F.lit("-"))
    )


def display_total(value: Column) -> Column:
    """Up to six decimals behind a leading space."""
    return F.concat(F.lit(" "), _trimmed(F.round(value.cast("double"), 6), 6))
