from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from seasongrid.config import Assets
from seasongrid.plans import silver
from seasongrid.sources import landing, sinks
from seasongrid.sources.landing import accepted, quarantined, scan_entity


def _put(path, payload) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload), encoding="utf-8")


def _standing(number, meeting, position=1, points=10):
    return {
        "driver_number": number,
        "meeting_key": meeting,
        "session_key": meeting * 10,
        "position_current": position,
        "points_current": points,
    }


def _entry(number, team, **more):
    return {"driver_number": number, "full_name": f"D{number}", "team_name": team, **more}


@pytest.fixture()
def bronze(tmp_path):
    """Two seasons of files put by hand: arrays, an error payload, broken text, absent fields."""
    root = tmp_path / "bronze"
    first = root / "2023" / "01_São Paulo"
    _put(first / "drivers_standings.json", [_standing(1, 101), _standing(2, 101, None), _standing(3, 101, 4, 2.5)])
    _put(first / "drivers.json", [_entry(1, "Alpha ", headshot_url="", team_colour="FF8000"), _entry(2, None)])
    _put(first / "teams_standings.json", [{"team_name": "Alpha ", "meeting_key": 101, "position_current": 1}])
    second = root / "2023" / "02_Austria"
    _put(second / "drivers_standings.json", {"detail": "try later"})
    _put(second / "drivers.json", [_entry(1, "Beta", headshot_url="http://p/1", team_colour=None)])
    _put(second / "teams_standings.json", "[{\"team_name\": \"Alph")
    _put(second / "sessions.json", [])
    _put(root / "2024" / "01_Monza" / "drivers_standings.json", [_standing(1, 201, 2, 25)])
    meeting = {"year": 2023, "location": "X", "date_start": "2023-11-03T14:30:00+00:00"}
    _put(
        root / "2023" / "circuits.json",
        [
            {"meeting_key": 101, "meeting_name": "São Paulo Prix", **meeting},
            {"meeting_key": 90, "meeting_name": "Pre-Season Testing", **meeting},
            {"meeting_key": 91, "meeting_name": None, **meeting},
        ],
    )
    return str(root)


def test_scan_takes_exactly_one_entity(spark, bronze):
    scan = scan_entity(spark, bronze, "drivers")
    assert rows(accepted(scan), "driver_number", "team_name") == [("1", "Alpha "), ("1", "Beta"), ("2", None)]


def test_path_columns(spark, bronze):
    scan = landing.with_season_by_pattern(
        landing.with_path_columns(scan_entity(spark, bronze, "drivers_standings")).withColumnRenamed("year", "by_place")
    )
    got = accepted(scan).select("race_folder_name", "by_place", "year").distinct()
    assert rows(got) == [("01_Monza", 2024, 2024), ("01_São Paulo", 2023, 2023)]


def test_season_scoped_scan(spark, bronze):
    scan = scan_entity(spark, f"{bronze}/2024", "drivers_standings")
    assert rows(silver.driver_standings(accepted(scan)), "driver_number", "year", "points") == [(1, 2024, 25.0)]


def test_error_payload_and_broken_text_are_quarantined(spark, bronze):
    errors = quarantined(scan_entity(spark, bronze, "drivers_standings"))
    assert rows(errors, "reason", "payload") == [("error payload", "try later")]
    broken = quarantined(scan_entity(spark, bronze, "teams_standings"))
    assert rows(broken, "reason") == [("malformed",)]
    assert broken.first().source_path.endswith("02_Austria/teams_standings.json")
    assert scan_entity(spark, bronze, "sessions").count() == 0


def test_wrong_path_depth_yields_null(spark, tmp_path):
    _put(tmp_path / "drivers_standings.json", [_standing(1, 5)])
    scan = landing.with_path_columns(scan_entity(spark, str(tmp_path), "drivers_standings"))
    assert scan.first().year is None


def test_driver_standings_drop_rows_without_position(spark, bronze):
    table = silver.driver_standings(accepted(scan_entity(spark, bronze, "drivers_standings")))
    assert dict(table.dtypes) == {
        "position": "int",
        "points": "float",
        "driver_number": "int",
        "session_key": "bigint",
        "meeting_key": "bigint",
        "race_folder_name": "string",
        "year": "int",
        "ingestion_date": "timestamp",
    }
    assert rows(table, "driver_number", "meeting_key", "position", "points") == [
        (1, 101, 1, 10.0), (1, 201, 2, 25.0), (3, 101, 4, 2.5)
    ]


def test_calendar_drops_tests_and_unnamed_meetings(spark, bronze):
    table = silver.calendar(accepted(scan_entity(spark, bronze, "circuits")))
    assert rows(table.select("meeting_key", "gp_name", F.date_format("date_start", "yyyy-MM-dd HH:mm"))) == [
        (101, "São Paulo Prix", "2023-11-03 14:30")
    ]


def test_roster_defaults_and_latest_row(spark, bronze):
    assets = Assets(default_photo="none.png")
    roster = silver.roster(accepted(scan_entity(spark, bronze, "drivers")), assets)
    assert rows(roster, "driver_number", "race_folder_name", "headshot_url", "team_colour") == [
        (1, "01_São Paulo", "none.png", "#FF8000"),
        (1, "02_Austria", "http://p/1", "#999999"),
        (2, "01_São Paulo", "none.png", "#999999"),
    ]
    assert rows(silver.entrants(roster), "driver_number", "year", "team_name") == [(1, 2023, "Beta"), (2, 2023, None)]
    assert rows(silver.entrants_by_race(roster), "driver_number", "race_folder_name", "team_name") == [
        (1, "01_São Paulo", "Alpha "), (1, "02_Austria", "Beta"), (2, "01_São Paulo", None)
    ]


def test_rounds_are_compared_as_numbers(spark, tmp_path):
    for folder, team in (("99_X", "Old"), ("100_Y", "New"), ("Extra", "None")):
        _put(tmp_path / "bronze" / "2023" / folder / "drivers.json", [_entry(1, team)])
    roster = silver.roster(accepted(scan_entity(spark, str(tmp_path), "drivers")))
    assert rows(silver.entrants(roster), "team_name") == [("New",)]


def test_teams_escape_spaces_only(spark, bronze):
    standings = silver.team_standings(accepted(scan_entity(spark, bronze, "teams_standings")))
    assert rows(silver.teams(standings, Assets(logo_base="logos/")), "team_name", "team_logo_url") == [
        ("Alpha ", "logos/Alpha%20.png")
    ]


def test_landed_by_spark_reads_like_files_put_by_hand(spark, make, tmp_path):
    season = str(tmp_path / "bronze" / "2023")
    record = "driver_number long, position_current long, race_folder string"
    first = make(record, (1, 1, "01_A b"), (2, 2, "02_C"))
    other = make("driver_number long", (9,))
    sinks.replace_season({"drivers_standings": first, "drivers": other}, season)
    again = make(record, (1, 7, "02_C"))
    sinks.replace_season({"drivers_standings": again}, season)
    scan = landing.with_path_columns(accepted(scan_entity(spark, season, "drivers_standings")))
    assert rows(scan, "driver_number", "position_current", "race_folder_name", "year") == [("1", "7", "02_C", 2023)]
    assert scan_entity(spark, season, "drivers").count() == 0


def test_values_that_do_not_fit_become_null_and_reject_nothing(spark, tmp_path):
    odd = [
        {**_standing(1, 101), "points_current": "12.5", "position_current": "2"},
        {**_standing(2, 101), "points_current": "many", "position_current": 3.0},
        {**_standing(3, 101), "position_current": "first"},
        {**_standing(4, 9007199254740993), "points_current": None},
    ]
    _put(tmp_path / "bronze" / "2023" / "01_X" / "drivers_standings.json", odd)
    scan = scan_entity(spark, str(tmp_path), "drivers_standings")
    assert quarantined(scan).count() == 0
    assert rows(silver.driver_standings(accepted(scan)), "driver_number", "position", "points", "meeting_key") == [
        (1, 2, 12.5, 101), (2, 3, None, 101), (4, 1, None, 9007199254740993)
    ]


@pytest.mark.parametrize("name", ["01_São Paulo", "02_A+B 100%", "03_Round #3: x=y", "04_a%20b"])
def test_folder_names_survive_landing(spark, make, tmp_path, name):
    by_hand, by_spark = tmp_path / "bronze" / "2023", str(tmp_path / "spark" / "bronze" / "2024")
    _put(by_hand / name / "drivers.json", [_entry(1, "A")])
    sinks.replace_season({"drivers": make("driver_number long, race_folder string", (2, name))}, by_spark)
    scan = landing.with_path_columns(scan_entity(spark, [str(by_hand), by_spark], "drivers"))
    assert rows(scan, "driver_number", "race_folder_name", "year") == [("1", name, 2023), ("2", name, 2024)]


def test_catalog_from_landed_files(spark, bronze, tmp_path):
    _put(tmp_path / "bronze" / "2023" / "01_São Paulo" / "sessions.json", [
        {"meeting_key": 101, "session_key": 1010, "session_type": "Race", "date_start": "2023-11-03T14:30:00+00:00"},
        {"meeting_key": 101, "session_key": 1009, "session_type": "Race", "date_start": "2023-11-04T14:30:00+00:00"},
    ])
    meetings = silver.meetings(accepted(scan_entity(spark, bronze, "circuits")))
    sessions = silver.sessions(accepted(scan_entity(spark, bronze, "sessions")))
    catalog = silver.season_catalog(meetings, silver.race_sessions(sessions))
    assert rows(catalog, "year", "round", "session_key", "folder_name") == [(2023, 1, 1009, "01_São_Paulo_Prix")]


def test_season_catalog_numbers_races_by_date(make):
    meetings = make(
        "meeting_key long, meeting_name string, date_start string, year int",
        (1, "Testing days", "2023-02-01", 2023),
        (2, "B Prix", "2023-04-01", 2023),
        (3, "A Prix", "2023-03-01", 2023),
        (4, "No race", "2023-05-01", 2023),
        (5, "C Prix", "2023-06-01", 2023),
        (6, "D Prix", "2024-03-01", 2024),
    )
    sessions = make(
        "meeting_key long, session_key long, session_type string, place int",
        (1, 10, "Race", 0), (2, 20, "Race", 0), (2, 21, "Race", 1), (3, 30, "Race", 0), (3, 31, "Qualifying", 1),
        (5, 50, "Race", 0), (5, 0, "Race", 1), (6, 60, "Race", 0),
    )
    catalog = silver.season_catalog(meetings, silver.race_sessions(sessions, ["place"]))
    assert rows(catalog, "year", "round", "meeting_key", "session_key", "folder_name") == [
        (2023, 1, 3, 30, "01_A_Prix"), (2023, 2, 2, 21, "02_B_Prix"), (2024, 1, 6, 60, "01_D_Prix")
    ]


def test_result_sessions(make):
    sessions = make(
        "session_key long, session_name string",
        (1, "Race"), (2, "Sprint"), (3, None), (None, "Race"), (0, "Sprint"), (4, "Practice"),
    )
    assert rows(silver.result_sessions(sessions)) == [(1, "Race"), (2, "Sprint")]
