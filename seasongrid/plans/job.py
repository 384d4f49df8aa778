"""The incremental season load: landed JSON to typed tables to star.

Every table is staged first and all are published at the end, so a load that
fails on the way leaves what readers see as it was (see
:mod:`seasongrid.sources.stores`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasongrid.config import DEFAULT_COLOUR, Assets
from seasongrid.operators.quality import Limits, Watch
from seasongrid.plans import gold, silver
from seasongrid.schemas import RejectSchemas, Schemas
from seasongrid.sources import ledger, sinks
from seasongrid.sources.landing import (
    accepted,
    entity_files,
    quarantined,
    scan_entity,
    scan_rescued,
    unknown_fields,
    with_season_by_pattern,
)
from seasongrid.sources.stores import CatalogStore, FolderStore, Store


@dataclass
class Report:
    """What a load did: its seasons, and the counts of its watched tables."""

    seasons: list[int]
    counts: dict[str, dict[str, int]]


def load_typed(
    store: Store,
    season_paths: Sequence[str],
    seasons: Sequence[int],
    assets: Assets = Assets(),
    loaded_at: Column | None = None,
    rejects: Store | None = None,
    rescue: bool = False,
) -> None:
    """Stage the given seasons, also those that bring no record; other seasons are not touched.

    Records that were not accepted go to ``rejects``, one table per entity, with
    the season of their file.  With ``rescue`` the table ``unknown_fields`` says
    which fields came that no schema declares, how often, and with what value.
    """
    spark, schemas = store.spark, store.schemas
    refused: dict[str, DataFrame] = {}
    unknown: list[DataFrame] = []

    def landed(entity: str) -> DataFrame:
        if rescue:
            scan = scan_rescued(spark, season_paths, entity_files(entity), schemas.record(entity).names)
            unknown.append(unknown_fields(scan).select(F.lit(entity).alias("entity"), "*"))
        else:
            scan = scan_entity(spark, season_paths, entity, schemas)
        if rejects:
            refused[entity] = with_season_by_pattern(quarantined(scan))
        return accepted(scan)

    def save(name: str, table: DataFrame) -> Callable[[], None]:
        return partial(store.replace, name, table, seasons, name != "circuits")

    meetings = landed("circuits")
    first = {
        "drivers_standings": silver.driver_standings(landed("drivers_standings"), loaded_at, schemas),
        "teams_standings": silver.team_standings(landed("teams_standings"), loaded_at, schemas),
        "circuits": sinks.date_ordered(silver.calendar(meetings, loaded_at, schemas)),
        "drivers_by_race": silver.entrants_by_race(silver.roster(landed("drivers"), assets, loaded_at, schemas)),
        "seasons": catalog_of(meetings, landed("sessions")),
    }
    sinks.write_all(
        [partial(rejects.replace, entity, table, seasons) for entity, table in refused.items() if rejects]
        + [save(name, table) for name, table in first.items()]
        + ([save("unknown_fields", reduce(DataFrame.union, unknown))] if unknown else [])
    )
    # The row of a season is one of its rows by race.
    then = {
        "drivers": silver.entrants(store.read("drivers_by_race", seasons)),
        "teams": silver.teams(store.read("teams_standings", seasons), assets),
    }
    sinks.write_all([save(name, table) for name, table in then.items()])


def catalog_of(calendar_records: DataFrame, session_records: DataFrame) -> DataFrame:
    """The season catalog from landed calendars and sessions."""
    races = silver.race_sessions(silver.sessions(session_records))
    return silver.season_catalog(silver.meetings(calendar_records), races)


def load_star(
    typed: Store,
    star: Store,
    default_colour: str = DEFAULT_COLOUR,
    seasons: Sequence[int] | None = None,
    team_at_race: bool = False,
    block: Column | None = None,
    watch: Watch | None = None,
) -> None:
    """Stage the star from the typed tables.

    A series ends with its season, and a key names its season, so facts, drivers
    and teams are partitioned by season; only those of ``seasons`` are read,
    computed and replaced, all if it is ``None``.  The races of other seasons
    come from the race dimension itself.  ``team_at_race`` gives results the
    team an entrant raced for that day; seasons loaded before without it stay
    as they are.  For ``block`` see :mod:`seasongrid.operators.series`.  A
    ``watch`` counts repeated and missing keys while the tables are written.
    """

    def chosen(name: str) -> DataFrame:
        return typed.read(name, seasons)

    calendar, entrants = chosen("circuits"), chosen("drivers")
    previous = star.read("dim_race") if seasons is not None and star.exists("dim_race") else None
    rosters = chosen("drivers_by_race") if team_at_race else None
    # Small, and read from the table it replaces.
    races = sinks.stored(gold.dim_race(calendar, previous, seasons or ()), "dim-race")
    dimensions = {
        "dim_driver": (gold.dim_driver(entrants, chosen("drivers_standings"), calendar), "Driver_Key"),
        "dim_team": (gold.dim_team(chosen("teams"), entrants, default_colour), "Team_Key"),
        "dim_race": (races, "Race_Key"),
        "ui_play_timeline": (gold.timeline_of(races), None),
    }
    facts = {
        "fact_driver_results": gold.fact_driver(
            chosen("drivers_standings"), calendar, entrants, rosters, block, by_season=True
        ),
        "fact_team_results": gold.fact_team(chosen("teams_standings"), calendar, block, by_season=True),
    }

    def dimension(name: str) -> Callable[[], None]:
        table, key = dimensions[name]
        return partial(star.replace, name, watch.dimension(name, table, key) if watch and key else table, seasons)

    def fact(name: str) -> Callable[[], None]:
        table = facts[name]
        if watch:
            keys = {"Race_Key": "dim_race", "Team_Key": "dim_team", "Driver_Key": "dim_driver"}
            known = {key: star.read(of, seasons if of != "dim_race" else None) for key, of in keys.items() if key in table.columns}
            table = watch.fact(name, table, known)
        return partial(star.replace, name, table, seasons)

    if watch:  # facts look up the dimensions that were just written
        sinks.write_all([dimension(name) for name in dimensions])
        sinks.write_all([fact(name) for name in facts])
    else:
        sinks.write_all([fact(name) for name in facts] + [dimension(name) for name in dimensions])


def load_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    default_colour: str = DEFAULT_COLOUR,
    fmt: str = "parquet",
    seasons: Sequence[int] | None = None,
    team_at_race: bool = False,
    block: Column | None = None,
    schemas: Schemas = Schemas(),
) -> None:
    """Rebuild the star in a folder from the typed tables of another."""
    star = FolderStore(spark, gold_root, fmt, schemas)
    load_star(FolderStore(spark, silver_root, fmt, schemas), star, default_colour, seasons, team_at_race, block)
    star.publish()


def stores(
    spark: SparkSession, root: str, fmt: str = "parquet", schemas: Schemas = Schemas(), catalog: str | None = None
) -> tuple[Store, Store]:
    """The stores of typed tables and of the star below ``root``."""

    def store(layer: str) -> Store:
        if catalog is None:
            return FolderStore(spark, f"{root}/{layer}", fmt, schemas)
        return CatalogStore(spark, f"{root}/{layer}", f"{catalog}{layer}_", fmt, schemas)

    return store("silver"), store("gold")


def due_seasons(typed: Store, root: str, season_dir: str = "{year}") -> list[int]:
    """Landed seasons that are complete and not yet loaded as they are now.

    The catalog of a season, from its landed calendar and sessions, names a
    folder for every race; all of them must have their standings and roster.
    Only seasons whose files changed since their load are looked at.
    """
    spark = typed.spark
    landed = ledger.landed_seasons(spark, f"{root}/bronze", season_dir)
    changed = ledger.changed_seasons(typed, landed)
    if not changed:
        return []
    paths = [landed[season] for season in changed]
    schemas = typed.schemas
    catalog = catalog_of(
        accepted(scan_entity(spark, paths, "circuits", schemas)), accepted(scan_entity(spark, paths, "sessions", schemas))
    )
    return ledger.complete_seasons(catalog, ledger.listing(spark, paths), changed)


def run(
    spark: SparkSession,
    seasons: Sequence[int] | None,
    root: str,
    season_dir: str = "{year}",
    assets: Assets = Assets(),
    loaded_at: Column | None = None,
    rejects_root: str | None = None,
    fmt: str = "parquet",
    team_at_race: bool = False,
    block: Column | None = None,
    catalog: str | None = None,
    schemas: Schemas = Schemas(),
    limits: Limits | None = None,
    rescue: bool = False,
) -> Report:
    """Load ``seasons`` from ``{root}/bronze`` and bring the star up to date; ``None`` loads those that are due.

    Seasons do not depend on each other before the star, so they are read in
    one pass; a season without landed files fails the load before any write.
    With ``catalog`` the tables get names that start with it and are switched
    over in the catalog.  ``limits`` counts repeated and missing keys in the
    passes that write, and refuses a load beyond them before anything is visible.
    ``rescue`` also stores which undeclared fields the landed records have.
    """
    typed, star = stores(spark, root, fmt, schemas, catalog)
    if seasons is None:
        seasons = due_seasons(typed, root, season_dir)
        if not seasons:
            return Report([], {})
    paths = [f"{root}/bronze/{season_dir.format(year=year)}" for year in seasons]
    rejects = FolderStore(spark, rejects_root, fmt, RejectSchemas()) if rejects_root else None
    watch = Watch(limits) if limits else None
    used: list[Store] = [store for store in (typed, star, rejects) if store]
    try:
        typed.replace("landed_files", ledger.listing(spark, paths), seasons)  # as they are before any of them is read
        load_typed(typed, paths, seasons, assets, loaded_at, rejects, rescue)
        load_star(typed, star, assets.default_colour, seasons, team_at_race, block, watch)
        counts = watch.enforce() if watch else {}
    except BaseException:
        for store in used:
            store.discard()
        raise
    for store in used:
        store.publish()
    return Report(list(seasons), counts)
