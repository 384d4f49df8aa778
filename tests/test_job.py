from __future__ import annotations

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from seasongrid.plans import job
from seasongrid.session import fresh_dir
from seasongrid.sources import sinks
from seasongrid.sources.tables import GOLD_TABLES, SILVER_TABLES, create_tables, read_table, register_silver, register_star


def _land(make, root: str, year: int, totals: list[float]) -> None:
    races = [(f"{i:02d}_R{i}", year * 100 + i, t) for i, t in enumerate(totals, 1)]
    standings = "driver_number long, position_current long, points_current double, session_key long, meeting_key long, race_folder string"
    team = "team_name string, position_current long, points_current double, meeting_key long, race_folder string"
    roster = "driver_number long, full_name string, team_name string, country_code string, race_folder string"
    meeting = "meeting_key long, meeting_name string, circuit_short_name string, date_start string, year long"
    sinks.replace_season(
        {
            "drivers_standings": make(standings, *[(7, 1, p, k * 10, k, f) for f, k, p in races]),
            "teams_standings": make(team, *[("Alpha", 1, p, k, f) for f, k, p in races]),
            "drivers": make(roster, *[(7, "Ann", "Alpha", "AA", f) for f, _, _ in races]),
            "circuits": make(
                meeting, *[(k, f"Race {f[-1]}", f"Ring {f[-1]}", f"{year}-0{f[-1]}-01", year) for f, k, _ in races]
            ),
        },
        f"{root}/bronze/{year}",
    )


@pytest.fixture(scope="module")
def loaded(spark, make):
    """2023 and 2024, then 2024 landed and loaded again with one race fewer."""
    root = fresh_dir(spark, "job")
    _land(make, root, 2023, [10.0, 25.0])
    _land(make, root, 2024, [1.0, 2.0, 3.0])
    job.run(spark, [2023, 2024], root)
    before = read_table(spark, f"{root}/silver/drivers_standings", seasons=[2023])
    stamps = rows(before, "meeting_key", "ingestion_date")
    _land(make, root, 2024, [4.0, 9.0])
    job.run(spark, [2024], root)
    return root, stamps


def test_a_rerun_replaces_its_season_only(spark, loaded):
    root, stamps = loaded
    table = read_table(spark, f"{root}/silver/drivers_standings")
    assert rows(table.where("year = 2023"), "meeting_key", "ingestion_date") == stamps
    assert rows(table.where("year = 2024"), "meeting_key", "points") == [(202401, 4.0), (202402, 9.0)]


def test_the_star_covers_all_seasons(spark, loaded):
    root, _ = loaded
    tables = register_star(spark, f"{root}/gold")
    assert set(tables) == set(GOLD_TABLES)
    fact = tables["fact_driver_results"]
    assert rows(fact, "Race_Key", "Race_Points", "Team_Key") == [
        (202301, 10.0, "Alpha-2023"), (202302, 15.0, "Alpha-2023"),
        (202401, 4.0, "Alpha-2024"), (202402, 5.0, "Alpha-2024"),
    ]
    joined = spark.sql(
        """SELECT t.Team, r.Year, sum(f.Race_Points) AS points
           FROM gold_fact_team_results f JOIN gold_dim_team t USING (Team_Key) JOIN gold_dim_race r USING (Race_Key)
           GROUP BY ALL"""
    )
    assert rows(joined) == [("Alpha", 2023, 25.0), ("Alpha", 2024, 9.0)]
    assert tables["ui_play_timeline"].count() == 4


def test_a_load_leaves_the_facts_of_other_seasons_alone(spark, make):
    root = fresh_dir(spark, "facts")
    for year in (2023, 2024):
        _land(make, root, year, [1.0, 3.0])
    job.run(spark, [2023, 2024], root)

    def files(season: int) -> set[str]:
        fact = read_table(spark, f"{root}/gold/fact_team_results").where(f"season = {season}")
        return {r[0] for r in fact.select("_metadata.file_path").collect()}

    before = files(2023), files(2024)
    _land(make, root, 2024, [5.0])
    job.run(spark, [2024], root)
    assert files(2023) == before[0] and not files(2024) & before[1]
    fact = read_table(spark, f"{root}/gold/fact_team_results")
    assert rows(fact, "Race_Key", "Race_Points") == [(202301, 1.0), (202302, 2.0), (202401, 5.0)]
    # from scratch and by seasons come to the same
    job.load_gold(spark, f"{root}/silver", f"{root}/again")
    again = read_table(spark, f"{root}/again/fact_team_results")
    assert rows(again.select(fact.columns)) == rows(fact)


def test_results_for_the_team_of_the_day(spark, make):
    root = fresh_dir(spark, "transfer")
    roster = "driver_number long, full_name string, team_name string, country_code string, race_folder string"
    sinks.replace_season(
        {
            "drivers": make(roster, (7, "Ann", "Alpha", "AA", "01_R1"), (7, "Ann", "Beta", "AA", "02_R2")),
            "drivers_standings": make(
                "driver_number long, position_current long, points_current double, session_key long, meeting_key long, race_folder string",
                (7, 1, 1.0, 1, 202401, "01_R1"), (7, 1, 3.0, 2, 202402, "02_R2"),
            ),
            "teams_standings": make(
                "team_name string, position_current long, points_current double, meeting_key long, race_folder string",
                ("Alpha", 1, 1.0, 202401, "01_R1"), ("Beta", 1, 2.0, 202402, "02_R2"),
            ),
            "circuits": make(
                "meeting_key long, meeting_name string, circuit_short_name string, date_start string, year long",
                (202401, "Race 1", "Ring 1", "2024-01-01", 2024), (202402, "Race 2", "Ring 2", "2024-02-01", 2024),
            ),
        },
        f"{root}/bronze/2024",
    )
    for at_race, first in ((False, "Beta-2024"), (True, "Alpha-2024")):
        job.run(spark, [2024], root, team_at_race=at_race)
        fact = read_table(spark, f"{root}/gold/fact_driver_results")
        assert rows(fact, "Race_Key", "Team_Key", "Race_Points") == [(202401, first, 1.0), (202402, "Beta-2024", 2.0)]


def test_tables_have_names_in_every_session(spark, loaded):
    root, _ = loaded
    names = create_tables(spark, f"{root}/gold", GOLD_TABLES, "standings")
    create_tables(spark, f"{root}/gold", GOLD_TABLES, "standings")
    other = spark.newSession()
    assert all(other.catalog.tableExists(name) for name in names)
    seasons = other.sql("SELECT DISTINCT season FROM standings_fact_team_results")
    assert rows(seasons) == [(2023,), (2024,)]
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    assert read_table(spark, f"{root}/gold/dim_race").count() == 4


def test_typed_tables_are_views(spark, loaded):
    root, _ = loaded
    assert set(register_silver(spark, f"{root}/silver")) == set(SILVER_TABLES)
    assert rows(spark.sql("SELECT DISTINCT team_name, year FROM silver_teams")) == [("Alpha", 2023), ("Alpha", 2024)]


def test_rejects_are_kept_per_season(spark, make):
    root = fresh_dir(spark, "rejects")
    _land(make, root, 2023, [1.0])
    bad = make("detail string, race_folder string", ("try later", "01_R1"))
    sinks.land_json(bad, f"{root}/bronze/2023", "drivers_standings", ["race_folder"])
    job.run(spark, [2023], root, rejects_root=f"{root}/rejects")
    kept = spark.read.parquet(f"{root}/rejects/drivers_standings")
    assert rows(kept, "reason", "payload", "year") == [("error payload", "try later", 2023)]
    assert read_table(spark, f"{root}/silver/drivers_standings").count() == 1


def test_a_reload_with_rejects_only_empties_its_season_and_a_clean_one_the_rejects(spark, make):
    root = fresh_dir(spark, "reload")
    for year in (2023, 2024):
        _land(make, root, year, [1.0])
    job.run(spark, [2023, 2024], root, rejects_root=f"{root}/rejects")
    bad = make("detail string, race_folder string", ("try later", "01_R1"))
    sinks.land_json(bad, f"{root}/bronze/2024", "drivers_standings", ["race_folder"], "append")
    job.run(spark, [2024], root, rejects_root=f"{root}/rejects")
    assert spark.read.parquet(f"{root}/rejects/drivers_standings").count() == 1
    standings = read_table(spark, f"{root}/silver/drivers_standings")
    sinks.overwrite_seasons(standings.where("false"), f"{root}/silver/drivers_standings", seasons=[2024])
    assert rows(read_table(spark, f"{root}/silver/drivers_standings"), "year") == [(2023,)]


def test_tables_in_another_format(spark, make):
    root = fresh_dir(spark, "orc")
    _land(make, root, 2023, [10.0, 25.0])
    job.run(spark, [2023], root, fmt="orc")
    fact = register_star(spark, f"{root}/gold", "orc")["fact_team_results"]
    assert rows(fact, "Race_Key", "Race_Points") == [(202301, 10.0), (202302, 15.0)]


def test_a_season_that_has_not_landed_fails_the_load(spark, loaded):
    root, _ = loaded
    with pytest.raises(AnalysisException):
        job.run(spark, [2025], root)
