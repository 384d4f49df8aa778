"""Point-in-time measures, one DataFrame for all cells.

What a report keeps in its filter context is passed as arguments:

``years``
    the visible seasons, all if ``None``;
``play_until``
    the last date selected on the timeline, nothing selected if ``None``.  A
    selection does not filter facts; each measure reads it as its cutoff.

Measures take ``star`` frames: facts joined to their race (``Year``, ``Date``,
``GP_Display``) and, where grouped by them, to other dimensions.  ``by`` names
the columns of the entity axis.  A blank is a null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasongrid.operators.joins import forward_fill, last_nonblank
from seasongrid.operators.series import spans_at, value_spans
from seasongrid.operators.summaries import selected_value
from seasongrid.plans.gold import SEASON
from seasongrid.sources.sinks import stored

Moment = dt.datetime | dt.date | str
TEAM = ("Team_Key",)
DRIVER = ("Driver_Key",)


def _visible(df: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """Rows of the visible seasons; a stored fact's own season prunes its partitions."""
    if years is None:
        return df
    seasons = [F.col(c).isin(list(years)) for c in ("Year", SEASON) if c in df.columns]
    return df.where(reduce(and_, seasons))


def _moment(df: DataFrame, play_until: Moment) -> Column:
    """The cutoff in the type of the Date column, so it can reach the scan."""
    return F.lit(play_until).cast(df.schema["Date"].dataType)


def _up_to(df: DataFrame, play_until: Moment | None) -> DataFrame:
    return df if play_until is None else df.where(F.col("Date") <= _moment(df, play_until))


def _points() -> Column:
    return F.col("Season_Points").cast("double")


# ---- points -----------------------------------------------------------------


def team_points(
    star: DataFrame,
    by: Sequence[str] = TEAM,
    years: Sequence[int] | None = None,
    play_until: Moment | None = None,
) -> DataFrame:
    """Season points as of the cutoff.

    Add race columns to ``by`` for a race axis: each race then shows its own
    value only, and a race later than the cutoff is blank, that is absent.
    """
    return _up_to(_visible(star, years), play_until).groupBy(*by).agg(F.max(_points()).alias("Team_Points"))


def team_points_by_date(
    star: DataFrame,
    dim_race: DataFrame,
    by: Sequence[str] = TEAM,
    years: Sequence[int] | None = None,
    play_until: Moment | None = None,
) -> DataFrame:
    """Season points on a date axis: the largest value up to each date.

    The running maximum is not confined to a season, so all visible races
    form one series; dates without a result show the value so far.
    """
    dates = _visible(dim_race, years).select("Date", F.col("Date").alias("_race")).distinct()
    facts = _visible(star, years).select(*by, "Date", _points().alias("_points"))
    until = None if play_until is None else _moment(dim_race, play_until)
    filled = forward_fill(facts, dates, by, "_points", "Team_Points", None, "_race", "Date", until, "max")
    return filled.drop("_race").where(F.col("Team_Points").isNotNull())


def team_point_spans(star: DataFrame, by: Sequence[str] = TEAM, years: Sequence[int] | None = None) -> DataFrame:
    """Season points on a date axis as the spans they hold for, the form to store.

    A key has a row for each rise of its points, whether seasons follow or not,
    where :func:`team_points_by_date` has one for each later date.
    """
    facts = _visible(star, years).select(*by, "Date", _points().alias("Team_Points"))
    return value_spans(facts, by, "Date", "Team_Points")


def team_points_on(spans: DataFrame, dates: DataFrame) -> DataFrame:
    """Season points on the dates asked for (column ``Date``), from stored spans; blank before a key's first."""
    return spans_at(spans, dates, "Date")


def draw_team_points(
    star: DataFrame,
    dim_race: DataFrame,
    timeline: DataFrame,
    by: Sequence[str] = TEAM,
    axis: Sequence[str] = ("Race_Key",),
    years: Sequence[int] | None = None,
    play_until: Moment | None = None,
) -> DataFrame:
    """Season points masked beyond the cutoff, for a chart that draws itself.

    A cell is compared by its last race date: that of the visible races of the
    cell's ``axis`` values.  The cutoff is the last selected timeline date,
    whatever races are visible.  With nothing selected there is no mask.
    """
    visible = _visible(star, years)
    values = visible.groupBy(*by, *axis).agg(F.max(_points()).alias("_points"))
    if play_until is None:
        return values.withColumnRenamed("_points", "Draw_Team_Points")
    cutoff = timeline.where(F.col("Date") <= _moment(timeline, play_until)).agg(F.max("Date")).scalar()
    races = _visible(dim_race, years)
    if axis:
        last_dates = races.groupBy(*axis).agg(F.max("Date").alias("_last"))
        placed, last = values.join(last_dates, list(axis), "left"), F.col("_last")
    else:
        placed, last = values, races.agg(F.max("Date")).scalar()
    drawn = F.when(last <= cutoff, F.col("_points"))
    return placed.select(*by, *axis, drawn.alias("Draw_Team_Points"))


# ---- ranks ------------------------------------------------------------------


def team_ranks(
    star: DataFrame,
    by: Sequence[str] = TEAM,
    years: Sequence[int] | None = None,
    play_until: Moment | None = None,
) -> DataFrame:
    """The last known rank up to the cutoff, within the visible seasons."""
    visible = _visible(star, years)
    until = None if play_until is None else _moment(star, play_until)
    return last_nonblank(visible, by, "Date", "World_Position", "Team_Ranks", until)


def team_ranks_by_race(
    star: DataFrame,
    dim_race: DataFrame,
    by: Sequence[str] = TEAM,
    years: Sequence[int] | None = None,
    play_until: Moment | None = None,
) -> DataFrame:
    """Ranks on a race axis, filled over races without a result.

    The fill stays within a season.  Races later than the cutoff and races
    before a team's first rank are blank, that is absent.
    """
    until = None if play_until is None else _moment(dim_race, play_until)
    facts = _visible(star, years).select(*by, "Year", "Date", "World_Position")
    filled = forward_fill(facts, _visible(dim_race, years), by, "World_Position", "Team_Ranks", until=until)
    return filled.where(F.col("Team_Ranks").isNotNull())


def team_ranks_by_code(
    star: DataFrame,
    dim_race: DataFrame,
    by: Sequence[str] = TEAM,
    years: Sequence[int] | None = None,
    play_until: Moment | None = None,
) -> DataFrame:
    """Ranks on an axis of display codes, which may recur in several seasons.

    A code's cutoff is the date of its last visible, selected race.  The rank is
    the last known one up to there within the seasons that hold the code: as of
    the cutoff in its season, else the final rank of an earlier one.
    """
    races = _visible(dim_race, years)
    cutoffs = _up_to(races, play_until).groupBy("GP_Display").agg(F.max("Date").alias("_cutoff"))
    seasons = races.select("GP_Display", "Year").distinct().join(cutoffs, "GP_Display")
    # Per code and season the last race date that counts: a few rows per season.
    as_of = (
        seasons.join(races.select("Year", "Date"), "Year")
        .where(F.col("Date") <= F.col("_cutoff"))
        .groupBy("GP_Display", "Year")
        .agg(F.max("Date").alias("Date"))
    )
    filled = team_ranks_by_race(star, dim_race, by, years, play_until).withColumnRenamed("Team_Ranks", "_rank")
    matched = filled.join(stored(as_of, "as-of"), ["Year", "Date"])
    return last_nonblank(matched, [*by, "GP_Display"], "Date", "_rank", "Team_Ranks")


def driver_ranks(
    star: DataFrame,
    dim_race: DataFrame,
    by: Sequence[str] = DRIVER,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """The rank at the last visible race date.

    That date comes from the calendar: if the last race has no results yet,
    every driver is blank.  Not filled, and replay does not matter.
    """
    last = _visible(dim_race, years).agg(F.max("Date")).scalar()
    at_last = F.when(F.col("Date") == last, F.struct("Race_Key", "World_Position"))
    return _visible(star, years).groupBy(*by).agg(
        F.max(at_last)["World_Position"].alias("Driver_Ranks")
    )


def driver_ranks_by_race(
    star: DataFrame,
    dim_race: DataFrame,
    by: Sequence[str] = DRIVER,
    axis: Sequence[str] = ("Race_Key",),
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Ranks on a race axis: each cell's last visible race date counts.

    For a code held in several seasons that is its latest race; a driver who
    raced there only before is blank.
    """
    last = _visible(dim_race, years).groupBy(*axis).agg(F.max("Date").alias("_last"))
    at_last = F.when(F.col("Date") == F.col("_last"), F.struct("Race_Key", "World_Position"))
    return (
        _visible(star, years)
        .join(last, list(axis))
        .groupBy(*by, *axis)
        .agg(F.max(at_last)["World_Position"].alias("Driver_Ranks"))
    )


# ---- team pictures and colours ----------------------------------------------


def actual_team_logo(
    star: DataFrame,
    dim_race: DataFrame,
    dim_team: DataFrame,
    by: Sequence[str] = DRIVER,
    years: Sequence[int] | None = None,
    play_until: Moment | None = None,
) -> DataFrame:
    """Logo of the team a driver raced for last, up to the cutoff.

    Needs exactly one visible season; with several every driver is blank.
    "Last" goes by date, then race key.
    """
    season = _visible(dim_race, years).agg(selected_value("Year")).scalar()
    counts = F.col("Year") == season
    if play_until is not None:
        counts = counts & (F.col("Date") <= _moment(star, play_until))
    raced = F.when(counts, F.struct("Date", "Race_Key", "Team_Key"))
    teams = _visible(star, years).groupBy(*by).agg(F.max(raced)["Team_Key"].alias("Team_Key"))
    return teams.join(dim_team.select("Team_Key", "Team_Logo"), "Team_Key", "left").select(
        *by, F.col("Team_Logo").alias("Actual_Team_Logo")
    )


def team_colour(dim_team: DataFrame, by: Sequence[str]) -> DataFrame:
    return dim_team.groupBy(*by).agg(F.max("Hex_Color").alias("Team_Color_Hex"))


# ---- replay -----------------------------------------------------------------


def championship_state_at(
    star: DataFrame,
    dim_race: DataFrame,
    play_until: Moment,
    by: Sequence[str] = TEAM,
) -> DataFrame:
    """The championship as of a date: points, rank and drawn points per team and season.

    One pass over the facts: all three are conditional maxima of one group.
    """
    date, cutoff = F.col("Date"), _moment(star, play_until)
    seen = date <= cutoff
    season_end = dim_race.groupBy("Year").agg(F.max("Date").alias("_season_end"))
    rank = F.when(seen & F.col("World_Position").isNotNull(), F.struct("Date", "World_Position"))
    ended = F.col("_season_end") <= cutoff
    return (
        star.join(season_end, "Year")
        .groupBy(*by, "Year")
        .agg(
            F.max(F.when(seen, _points())).alias("Team_Points"),
            F.max(rank)["World_Position"].alias("Team_Ranks"),
            F.max(F.when(ended, _points())).alias("Draw_Team_Points"),
        )
    )
