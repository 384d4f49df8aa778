"""The star: facts with their dimension columns.

Relations are many-to-one from fact (or timeline) to dimension.  A fact key
without a dimension row keeps its row, with blank dimension columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.plans.gold import SEASON


_RACE = ("Year", "Grand_Prix", "Circuit_Name", "GP_Display", "Date")
_TEAM = ("Team", "Team_Logo", "Hex_Color")
_DRIVER = ("Number", "Driver", "Driver_Photo", "Driver_Country", "Season_Rank_Sort")


def _race_columns(dim_race: DataFrame) -> DataFrame:
    return dim_race.select("Race_Key", *_RACE)


def _lookup(facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Columns of a dimension, joined by key, and by season where the facts have theirs.

    A key belongs to one season, so the season changes no result.  It lets a
    filter on the dimension's ``Year`` reach the partitions of the facts, and one
    on the facts' season those of the dimension.
    """
    if SEASON not in facts.columns:
        return facts.join(dimension.select(key, *columns), key, "left")
    named = dimension.select(F.col(key).alias("_key"), F.col("Year").alias("_of"), *columns)
    same = (F.col(key) == F.col("_key")) & (F.col(SEASON) == F.col("_of"))
    return facts.join(named, same, "left").drop("_key", "_of")


def with_race(facts: DataFrame, dim_race: DataFrame) -> DataFrame:
    """Facts with the columns of their race."""
    return _lookup(facts, dim_race, "Race_Key", _RACE)


def with_driver(facts: DataFrame, dim_driver: DataFrame) -> DataFrame:
    """Facts with the columns of their driver, by key alone: tables bucketed by it join in place.

    Put it first, since the joins with races and teams deal facts out anew.
    """
    return facts.join(dim_driver.select("Driver_Key", *_DRIVER), "Driver_Key", "left")


def driver_star(fact: DataFrame, dim_driver: DataFrame, dim_race: DataFrame, dim_team: DataFrame) -> DataFrame:
    teams = _lookup(with_race(fact, dim_race), dim_team, "Team_Key", _TEAM)
    return _lookup(teams, dim_driver, "Driver_Key", _DRIVER)


def team_star(fact: DataFrame, dim_team: DataFrame, dim_race: DataFrame) -> DataFrame:
    return _lookup(with_race(fact, dim_race), dim_team, "Team_Key", _TEAM)


def timeline_star(timeline: DataFrame, dim_race: DataFrame) -> DataFrame:
    races = _race_columns(dim_race).drop("Date")
    return timeline.withColumn("Race_Key", F.col("Race_Key").cast("long")).join(races, "Race_Key", "left")


def codes_by_date(dim_race: DataFrame) -> DataFrame:
    """Display codes in the order of their first race."""
    return dim_race.groupBy("GP_Display").agg(F.min("Date").alias("first_date")).orderBy(
        "first_date", "GP_Display"
    )


def drivers_by_rank(dim_driver: DataFrame) -> DataFrame:
    """Drivers in the order of their season rank, unranked ones last."""
    return dim_driver.orderBy(F.col("Season_Rank_Sort").asc_nulls_last(), "Driver_Key")


def standings_by_round(fact: DataFrame, dim_driver: DataFrame, dim_race: DataFrame, dim_team: DataFrame) -> DataFrame:
    """Championship slices, race by race and season by season."""
    star = driver_star(fact, dim_driver, dim_race, dim_team)
    return star.select(
        "Year",
        "Race_Key",
        "Date",
        "GP_Display",
        "World_Position",
        "Driver_Key",
        "Driver",
        "Team",
        F.col("Race_Points").cast("double").alias("Race_Points"),
        F.col("Season_Points").cast("double").alias("Season_Points"),
    ).orderBy("Year", "Date", "Race_Key", "World_Position", "Driver_Key")
