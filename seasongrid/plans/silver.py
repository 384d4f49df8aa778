"""Typed tables from landed records.

Every builder takes accepted records of :mod:`seasongrid.sources.landing`.
``loaded_at`` is the load stamp, by default the time of the run; ``schemas`` the
version of the declared schemas the records were scanned with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasongrid.config import Assets
from seasongrid.functions.cast import to_type
from seasongrid.functions.text import default_if_blank, folder_name, hex_colour, logo_url
from seasongrid.operators.dedup import first_per_group
from seasongrid.schemas import Schemas
from seasongrid.sources.landing import with_path_columns, with_season_by_pattern


def typed_columns(records: DataFrame, entity: str, *more: str | Column, schemas: Schemas = Schemas()) -> DataFrame:
    """The declared columns of an entity in their types, and ``more`` columns."""
    defaults = schemas.defaults(entity)

    def typed(landed: str, name: str, kind: str) -> Column:
        value = to_type(F.col(landed), kind)
        return (F.coalesce(value, F.expr(defaults[name]).cast(kind)) if name in defaults else value).alias(name)

    return records.select(*[typed(*column) for column in schemas.columns(entity)], *more)


def stamped(rows: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """``rows`` with the load stamp."""
    return rows.withColumn("ingestion_date", F.current_timestamp() if loaded_at is None else loaded_at)


def _typed(
    records: DataFrame, entity: str, *more: str | Column, loaded_at: Column | None, schemas: Schemas
) -> DataFrame:
    """The same with the load stamp."""
    return stamped(typed_columns(records, entity, *more, schemas=schemas), loaded_at)


def driver_standings(
    records: DataFrame, loaded_at: Column | None = None, schemas: Schemas = Schemas()
) -> DataFrame:
    """Entrant standings by race; a row needs an entrant and a position."""
    located = with_path_columns(records)
    typed = _typed(located, "drivers_standings", "race_folder_name", "year", loaded_at=loaded_at, schemas=schemas)
    return typed.na.drop(subset=["driver_number", "position"])


def team_standings(
    records: DataFrame, loaded_at: Column | None = None, schemas: Schemas = Schemas()
) -> DataFrame:
    """Team standings by race; a row needs a team and a position."""
    typed = _typed(with_path_columns(records), "teams_standings", "year", loaded_at=loaded_at, schemas=schemas)
    return typed.na.drop(subset=["team_name", "position"])


def is_race_meeting(name: Column) -> Column:
    """Neither a test nor nameless: a null name fails the condition too."""
    return ~name.contains("Testing")


def calendar(
    records: DataFrame, loaded_at: Column | None = None, schemas: Schemas = Schemas()
) -> DataFrame:
    """Race meetings; the season is a value of the record, not of the path."""
    races = records.where(is_race_meeting(F.col("meeting_name")))
    return _typed(races, "circuits", loaded_at=loaded_at, schemas=schemas)


def roster(
    records: DataFrame,
    assets: Assets = Assets(),
    loaded_at: Column | None = None,
    schemas: Schemas = Schemas(),
) -> DataFrame:
    """Roster records, one per race and entrant as landed."""
    located = with_season_by_pattern(with_path_columns(records))
    typed = _typed(located, "drivers", "race_folder_name", "year", loaded_at=loaded_at, schemas=schemas)
    return typed.withColumns(
        {
            "headshot_url": default_if_blank(F.col("headshot_url"), assets.default_photo),
            "team_colour": hex_colour(F.col("team_colour"), assets.default_colour),
        }
    )


def _roster_order() -> list[Column]:
    """Which roster row speaks for an entrant: the latest race, then the first
    team name; the other columns make the order total.

    Races go by the round their folder name starts with, as a number.
    """
    folder = F.col("race_folder_name")
    latest = [F.regexp_extract(folder, r"^(\d+)", 1).try_cast("int").desc_nulls_last(), folder.desc_nulls_last()]
    return latest + _race_roster_order()


def _race_roster_order() -> list[Column]:
    """The same among the rows of one race."""
    columns = ("team_name", "full_name", "name_acronym", "country_code", "headshot_url", "team_colour")
    return [F.col(c).asc_nulls_last() for c in columns]


def entrants(roster_rows: DataFrame) -> DataFrame:
    """One row per (entrant, season)."""
    return first_per_group(roster_rows, ["driver_number", "year"], _roster_order()).drop("race_folder_name")


def entrants_by_race(roster_rows: DataFrame) -> DataFrame:
    """One row per (entrant, season, race folder), for the team at each race."""
    return first_per_group(roster_rows, ["driver_number", "year", "race_folder_name"], _race_roster_order())


def teams(standings: DataFrame, assets: Assets = Assets()) -> DataFrame:
    """One row per (team name, season) with its logo and last load."""
    return (
        standings.groupBy("team_name", "year")
        .agg(F.max("ingestion_date").alias("last_updated"))
        .select(
            "team_name",
            "year",
            logo_url(assets.logo_base, F.col("team_name")).alias("team_logo_url"),
            "last_updated",
        )
    )


def meetings(records: DataFrame) -> DataFrame:
    """All meetings of the calendar, for the season catalog."""
    return typed_columns(records, "meetings")


def sessions(records: DataFrame) -> DataFrame:
    """Sessions of all kinds, for the season catalog."""
    return typed_columns(records, "sessions")


def race_sessions(
    sessions: DataFrame, order: Sequence[str] = ("session_start", "session_key")
) -> DataFrame:
    """The race session of each meeting: the last one under ``order`` counts."""
    return (
        sessions.where(F.col("session_type") == "Race")
        .groupBy("meeting_key")
        .agg(F.max_by("session_key", F.struct(*order)).alias("session_key"))
        .where((F.col("session_key").isNotNull()) & (F.col("session_key") != 0))
    )


def with_session_name(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("session_name", F.coalesce("session_name", F.lit("Unknown")))


def result_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with a result to fetch: races and sprints that have a key."""
    key = F.col("session_key")
    return with_session_name(sessions).where(
        F.col("session_name").isin("Race", "Sprint") & key.isNotNull() & (key != 0)
    )


def season_catalog(meetings: DataFrame, races: DataFrame) -> DataFrame:
    """Meetings that have a race, numbered by date within their season.

    ``meetings`` is the result of :func:`meetings`, ``races`` of
    :func:`race_sessions`.
    """
    rounds = Window.partitionBy("year").orderBy("date_start", "meeting_key")
    held = meetings.where(is_race_meeting(F.col("meeting_name"))).join(races, "meeting_key")
    return held.withColumn("round", F.row_number().over(rounds)).select(
        "year",
        "round",
        "meeting_key",
        "session_key",
        "meeting_name",
        "date_start",
        folder_name(F.col("round"), F.col("meeting_name")).alias("folder_name"),
    )
