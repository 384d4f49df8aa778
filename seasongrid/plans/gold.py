"""Dimensions and facts from the typed tables.

Facts refer to dimensions by keys.  Team names are trimmed wherever they
enter a key, so a padded name is one team everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasongrid.config import DEFAULT_COLOUR
from seasongrid.functions.keys import entrant_key, name_or_number, team_key
from seasongrid.operators.codes import display_code
from seasongrid.operators.dedup import collapse_copies, expand_copies, first_per_group
from seasongrid.operators.series import clamped_delta, previous_value, running_max
from seasongrid.sources.sinks import stored

ENTRANT_SERIES = ("driver_number", "year")
RACE_ORDER = ("date_start", "meeting_key")
#: The column by which stored facts are partitioned.
SEASON = "season"


# ---- entrant dimension ------------------------------------------------------


def raced(standings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Places of entrants at the races of the calendar, with the race date."""
    places = standings.select(*ENTRANT_SERIES, "meeting_key", "position")
    return places.join(calendar.select(*RACE_ORDER), "meeting_key")


def with_name(entrants: DataFrame) -> DataFrame:
    """Roster rows that name their entrant."""
    return entrants.where(F.col("full_name").isNotNull())


def under_name(entrants: DataFrame, places: DataFrame) -> DataFrame:
    """``places``, however many an entrant has, with its name of that season."""
    return places.withColumn("rank_in_race", F.col("position").cast("int")).drop("position").join(
        entrants.select(*ENTRANT_SERIES, "full_name"), list(ENTRANT_SERIES)
    )


def _latest_first() -> list[Column]:
    return [F.col(c).desc() for c in RACE_ORDER]


def last_places(standings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each entrant's place at its last race of a season; of several the smallest."""
    order = [*_latest_first(), F.col("position").cast("int").asc()]
    return first_per_group(raced(standings, calendar), ENTRANT_SERIES, order)


def final_ranks(entrants: DataFrame, standings: DataFrame, calendar: DataFrame) -> DataFrame:
    """The rank after the last race of each name and season.

    Races are reduced to one row per entrant before any name is looked up, so
    names meet only as many rows as there are entrants.
    """
    candidates = under_name(with_name(entrants), last_places(standings, calendar))
    order = [*_latest_first(), F.col("driver_number").asc(), F.col("rank_in_race").asc()]
    return first_per_group(candidates, ["full_name", "year"], order).select(
        "full_name", "year", F.col("rank_in_race").alias("Final_Season_Rank")
    )


def with_final_rank(entrants: DataFrame, ranks: DataFrame) -> DataFrame:
    """Bring ranks back to the entrants; an entrant without a name has none."""
    of = ranks.select(F.col("full_name").alias("_name"), F.col("year").alias("_season"), "Final_Season_Rank")
    same_name = name_or_number(F.col("full_name"), F.col("driver_number")) == F.col("_name")
    return entrants.join(of, same_name & (F.col("year") == F.col("_season")), "left").drop("_name", "_season")


def dim_driver(entrants: DataFrame, standings: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row for each of ``entrants``, which has one per (number, season), as the keys have."""
    ranked = with_final_rank(entrants, final_ranks(entrants, standings, calendar))
    return ranked.select(
        entrant_key(F.col("year"), F.col("driver_number")).alias("Driver_Key"),
        F.col("driver_number").alias("Number"),
        F.col("year").alias("Year"),
        F.col("full_name").alias("Driver"),
        F.col("headshot_url").alias("Driver_Photo"),
        F.col("country_code").alias("Driver_Country"),
        F.col("Final_Season_Rank").alias("Season_Rank_Sort"),
    )


# ---- team dimension ---------------------------------------------------------


def team_colours(entrants: DataFrame) -> DataFrame:
    """The largest colour, in binary order, of each team and season."""
    return (
        entrants.where(F.col("team_name").isNotNull())
        .groupBy(F.trim("team_name").alias("team"), "year")
        .agg(F.max("team_colour").alias("Hex_Color"))
    )


def with_colour(teams: DataFrame, colours: DataFrame, default_colour: str = DEFAULT_COLOUR) -> DataFrame:
    t, c = teams.alias("t"), colours.alias("c")
    same = (F.trim("t.team_name") == F.col("c.team")) & (F.col("t.year") == F.col("c.year"))
    return t.join(c, same, "left").select(
        "t.*", F.coalesce("c.Hex_Color", F.lit(default_colour)).alias("Hex_Color")
    )


def dim_team(teams: DataFrame, entrants: DataFrame, default_colour: str = DEFAULT_COLOUR) -> DataFrame:
    coloured = with_colour(teams, team_colours(entrants), default_colour)
    keyed = coloured.withColumn("Team_Key", team_key(F.col("team_name"), F.col("year")))
    return first_per_group(keyed, ["Team_Key"], [F.col("team_name").asc()]).select(
        "Team_Key",
        F.trim("team_name").alias("Team"),
        F.col("year").alias("Year"),
        F.col("team_logo_url").alias("Team_Logo"),
        "Hex_Color",
    )


# ---- race dimension and timeline --------------------------------------------


_RACE = ("Race_Key", "Year", "Grand_Prix", "Circuit_Name", "Date")
_RACE_CODED = ("Race_Key", "Year", "Grand_Prix", "Circuit_Name", "GP_Display", "Date")


def dim_race(calendar: DataFrame, previous: DataFrame | None = None, seasons: Sequence[int] = ()) -> DataFrame:
    """The races of ``calendar``; of the other seasons those ``previous`` has.

    Codes compare the names of all seasons, which stand in the dimension itself,
    so a load of some ``seasons`` reads the calendar of these only.
    """
    races = calendar.select(
        F.col("meeting_key").alias("Race_Key"),
        F.col("year").alias("Year"),
        F.col("gp_name").alias("Grand_Prix"),
        F.col("circuit").alias("Circuit_Name"),
        F.col("date_start").alias("Date"),
    ).distinct()
    if previous is not None:
        others = previous.where(F.col("Year").isNull() | ~F.col("Year").isin(list(seasons)))
        races = others.select(*_RACE).unionByName(races)
    return display_code(races, "Grand_Prix", "Circuit_Name").select(*_RACE_CODED)


def timeline_rows(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        F.col("date_start").alias("Date"),
        F.col("meeting_key").try_cast("int").alias("Race_Key"),
    )


def timeline(calendar: DataFrame) -> DataFrame:
    """The dates a replay can stop at, in order."""
    return timeline_rows(calendar).distinct().orderBy("Date", "Race_Key")


def timeline_of(dim_race: DataFrame) -> DataFrame:
    """The same from the race dimension, which has the races of all seasons."""
    return timeline(dim_race.select(F.col("Date").alias("date_start"), F.col("Race_Key").alias("meeting_key")))


# ---- facts ------------------------------------------------------------------


def one_per_race(standings: DataFrame, keep_folder: bool = False) -> DataFrame:
    """Repeated standings of an entrant and race become one row.

    The largest points and the largest, that is worst, position are kept.
    """
    largest = [F.max("points").alias("points"), F.max("position").alias("position")]
    if keep_folder:
        largest.append(F.max("race_folder_name").alias("race_folder_name"))
    return standings.groupBy("driver_number", "year", "meeting_key").agg(*largest)


def entrant_results(
    results: DataFrame,
    calendar: DataFrame,
    entrants: DataFrame,
    team_of: tuple[str, ...] = ENTRANT_SERIES,
) -> DataFrame:
    """Results of calendar races, with name and team where the roster has them."""
    dated = results.join(calendar.select("meeting_key", "date_start"), "meeting_key")
    team = entrants.select(*team_of, "full_name", "team_name")
    return dated.join(team, list(team_of), "left")


def fact_driver(
    standings: DataFrame,
    calendar: DataFrame,
    entrants: DataFrame,
    rosters_by_race: DataFrame | None = None,
    block: Column | None = None,
    by_season: bool = False,
) -> DataFrame:
    """Per-race results of entrants.

    The team is the one of the season's roster row; given ``rosters_by_race``
    it is the team the entrant raced for that day.  The series is kept per
    start number and season, so entrants without a name stay apart.  For
    ``block`` see :mod:`seasongrid.operators.series`.  ``by_season`` adds the
    season of the standings, by which a stored fact is partitioned.
    """
    if rosters_by_race is None:
        joined = entrant_results(one_per_race(standings), calendar, entrants)
    else:
        joined = entrant_results(
            one_per_race(standings, keep_folder=True),
            calendar,
            rosters_by_race,
            (*ENTRANT_SERIES, "race_folder_name"),
        )
    step = None
    if block is not None:
        joined, step = joined.withColumn("_block", block), "_block"
    series = previous_value(joined, "points", ENTRANT_SERIES, RACE_ORDER, "prev_points", 0.0, step)
    return series.select(
        entrant_key(F.col("year"), F.col("driver_number")).alias("Driver_Key"),
        team_key(F.col("team_name"), F.col("year")).alias("Team_Key"),
        F.col("meeting_key").alias("Race_Key"),
        clamped_delta(F.col("points"), F.col("prev_points")).alias("Race_Points"),
        F.col("points").alias("Season_Points"),
        F.col("position").alias("World_Position"),
        *_season(by_season),
    )


def _season(wanted: bool) -> list[Column]:
    return [F.col("year").alias(SEASON)] if wanted else []


def team_results(standings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Team standings of calendar races, with the race date and trimmed name."""
    named = standings.withColumn("team_name", F.trim("team_name"))
    return named.join(calendar.select("meeting_key", "date_start"), "meeting_key")


TEAM_SERIES = ("team_name", "year")
TEAM_ORDER = (*RACE_ORDER, "points", "position")


def fact_team(
    standings: DataFrame, calendar: DataFrame, block: Column | None = None, by_season: bool = False
) -> DataFrame:
    """Per-race results of teams; a cumulative total that drops is repaired first.

    Repeated standings rows are kept.  Exact copies travel as one row with
    their number and are unfolded at the end: the first copy carries the
    points gained, the others gain nothing.  Should one race of a team have
    very many different rows, let ``block`` cut the points as well, as
    ``struct(date_start, meeting_key, floor(points / 1000))`` does.
    ``by_season`` is as for :func:`fact_driver`.
    """
    slim = standings.select(
        F.trim("team_name").alias("team_name"), "year", "meeting_key", "points", "position"
    )
    dated = team_results(collapse_copies(slim), calendar)
    step = None
    if block is not None:
        dated, step = dated.withColumn("_block", block), "_block"
    repaired = running_max(dated, "points", TEAM_SERIES, TEAM_ORDER, "fixed", step)
    series = previous_value(repaired, "fixed", TEAM_SERIES, TEAM_ORDER, "prev_points", 0.0, step)
    facts = series.select(
        team_key(F.col("team_name"), F.col("year")).alias("Team_Key"),
        F.col("meeting_key").alias("Race_Key"),
        clamped_delta(F.col("fixed"), F.col("prev_points")).alias("gained"),
        F.col("fixed").alias("Season_Points"),
        F.col("position").alias("World_Position"),
        *_season(by_season),
        "copies",
    )
    first_copy = F.col("copy") == 1
    # Written once, as two branches read it; the one for huge counts skips files by their statistics.
    return expand_copies(stored(facts, "team-facts"), "copies", "copy").select(
        "Team_Key",
        "Race_Key",
        F.when(first_copy, F.col("gained"))
        .when(F.col("Season_Points").isNotNull(), F.lit(0.0).cast("float"))
        .alias("Race_Points"),
        "Season_Points",
        "World_Position",
        *([SEASON] if by_season else []),
    )
