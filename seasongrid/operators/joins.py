"""Join helpers: as-of lookup, forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasongrid.sources.sinks import stored


def last_nonblank(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    out: str,
    until: Column | None = None,
) -> DataFrame:
    """The value of the last date that has one, per key; equal dates keep the largest.

    The maximum of a (date, value) pair is both at once and combines map-side.
    """
    known = F.col(value).isNotNull()
    if until is not None:
        known = known & (F.col(date) <= until)
    pair = F.when(known, F.struct(F.col(date).alias("at"), F.col(value).alias("value")))
    return df.groupBy(*keys).agg(F.max(pair)["value"].alias(out))


def day_index(calendar: DataFrame, season: str | None, race: str, date: str) -> DataFrame:
    """Calendar rows with the running number of their date and the highest number.

    Numbers count within a season or, without ``season``, over the whole
    calendar.  Races of one date share a number.  The window groups hold one
    season's races; over the whole calendar, years are numbered apart and
    moved up by the dates of the years before, so that no task orders more
    than a year of races or one row per year.
    """
    group = season or "_year"
    dated = calendar if season else calendar.withColumn("_year", F.year(date))
    ranked = dated.select(
        group, race, date, F.dense_rank().over(Window.partitionBy(group).orderBy(date)).alias("_day")
    )
    if season:
        return ranked.withColumn("_days", F.max("_day").over(Window.partitionBy(season)))
    per_year = ranked.groupBy("_year").agg(F.max("_day").alias("_length"))
    whole = Window.partitionBy(F.lit(0))
    offsets = per_year.select(
        "_year",
        (F.sum("_length").over(whole.orderBy("_year")) - F.col("_length")).cast("int").alias("_before"),
        F.sum("_length").over(whole).cast("int").alias("_days"),
    )
    # One row per year of the timestamp range, hence safe to broadcast.
    return ranked.join(F.broadcast(offsets), "_year").select(
        race, date, (F.col("_day") + F.col("_before")).alias("_day"), "_days"
    )


def forward_fill(
    facts: DataFrame,
    calendar: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    season: str | None = "Year",
    race: str = "Race_Key",
    date: str = "Date",
    until: Column | None = None,
    how: str = "last",
) -> DataFrame:
    """One row per (key, race of the season): the value as of that race.

    ``facts`` carries ``keys``, ``season``, ``date`` and ``value``.  ``how`` is
    ``last`` (last known value) or ``max`` (running maximum).  Races before the
    first value of a key are kept with a null, races later than ``until`` are
    left out, and no value crosses a season.  With ``season=None`` the whole
    calendar is one series.

    Each known value is turned into the range of days it holds for and the
    range is unfolded, so the window sorts only rows that exist.  The key ×
    race grid is never joined together; it appears only as the result.
    """
    seasons = [season] if season else []
    group = [*keys, *seasons]
    visible = calendar if until is None else calendar.where(F.col(date) <= until)
    days = day_index(visible, season, race, date)
    if season is None:  # numbered in several steps and read twice
        days = stored(days, "days")
    numbered = days.select(*seasons, date, "_day", "_days").distinct()
    daily = (
        facts.join(numbered, [*seasons, date])
        .groupBy(*group, "_day", "_days")
        .agg(F.max(value).alias("_value"))
    )
    ordered = Window.partitionBy(*group).orderBy("_day")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.max("_value") if how == "max" else F.last("_value", ignorenulls=True)
    spans = daily.select(
        *group,
        "_day",
        carried.over(so_far).alias(out),
        F.when(F.lag("_day").over(ordered).isNull(), F.lit(1)).otherwise(F.col("_day")).alias("_from"),
        F.coalesce(F.lead("_day").over(ordered) - 1, F.col("_days")).alias("_to"),
    )
    cells = spans.select(
        *group,
        F.col("_day").alias("_since"),
        F.col(out).alias("_carried"),
        F.explode(F.sequence("_from", "_to")).alias("_day"),
    )
    return cells.join(days.drop("_days"), [*seasons, "_day"]).select(
        *group,
        race,
        date,
        F.when(F.col("_day") >= F.col("_since"), F.col("_carried")).alias(out),
    )
