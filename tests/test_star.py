from __future__ import annotations

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from seasongrid.operators.quality import duplicate_keys, orphan_keys
from seasongrid.plans import gold, star

STANDINGS = "driver_number int, year int, meeting_key long, points float, position int, race_folder_name string"
ROSTER = "driver_number int, year int, full_name string, team_name string, team_colour string, headshot_url string, country_code string"
TEAMS = "team_name string, year int, meeting_key long, points float, position int"


@pytest.fixture(scope="module")
def calendar(make):
    return make(
        "meeting_key long, year int, gp_name string, circuit string, date_start timestamp",
        (1, 2023, "Australian Prix", "Melbourne", day("2023-03-01")),
        (2, 2023, "Austrian Prix", "Spielberg", day("2023-04-01")),
        (3, 2023, "Monaco Prix", "Monte Carlo", day("2023-05-01")),
        (4, 2023, "Dutch Prix", "Zandvoort", day("2023-06-01")),
        (11, 2024, "Monaco Prix", "Monte Carlo", day("2024-05-01")),
    )


@pytest.fixture(scope="module")
def standings(make):
    return make(
        STANDINGS,
        (7, 2023, 1, 10.0, 1, "01_A"), (7, 2023, 2, 25.0, 1, "02_B"),
        (7, 2023, 3, 20.0, 2, "03_C"), (7, 2023, 4, 30.0, 1, "04_D"),
        (8, 2023, 1, 8.0, 3, "01_A"), (8, 2023, 1, 10.0, 2, "01_A"), (8, 2023, 4, 12.0, 5, "04_D"),
        (20, 2023, 1, 4.0, 6, "01_A"), (20, 2023, 2, 6.0, 6, "02_B"),
        (21, 2023, 1, 5.0, 7, "01_A"), (21, 2023, 2, 5.0, 7, "02_B"),
        (7, 2024, 11, 18.0, 2, "01_M"),
        (7, 2024, 99, 40.0, 1, "99_X"),
    )


@pytest.fixture(scope="module")
def entrants(make):
    return make(
        ROSTER,
        (7, 2023, "Ann", "Alpha ", "#000001", "p", "AA"), (8, 2023, "Bob", "Beta", "#00000B", "p", "BB"),
        (20, 2023, None, "Beta", "#00000C", "p", None), (7, 2024, "Ann", "Gamma", "#000003", "p", "AA"),
        (9, 2023, "Cyd", None, "#FFFFFF", "p", "CC"),
    )


def test_fact_driver(standings, calendar, entrants):
    fact = gold.fact_driver(standings, calendar, entrants)
    assert dict(fact.dtypes) == {
        "Driver_Key": "bigint", "Team_Key": "string", "Race_Key": "bigint",
        "Race_Points": "float", "Season_Points": "float", "World_Position": "int",
    }
    got = rows(fact, "Driver_Key", "Race_Key", "Race_Points", "Season_Points", "World_Position", "Team_Key")
    assert [r for r in got if r[0] == 20230007] == [
        (20230007, 1, 10.0, 10.0, 1, "Alpha-2023"), (20230007, 2, 15.0, 25.0, 1, "Alpha-2023"),
        (20230007, 3, 0.0, 20.0, 2, "Alpha-2023"), (20230007, 4, 10.0, 30.0, 1, "Alpha-2023"),
    ]
    # Repeated rows: the largest points and the worst position.
    assert got[4] == (20230008, 1, 10.0, 10.0, 3, "Beta-2023")
    # A missing race leaves no row; an unknown meeting is dropped.
    assert [r[1] for r in got if r[0] == 20230008] == [1, 4]
    assert [r for r in got if r[0] == 20240007] == [(20240007, 11, 18.0, 18.0, 2, "Gamma-2024")]


def test_entrants_without_a_name_keep_their_own_series(standings, calendar, entrants):
    fact = gold.fact_driver(standings, calendar, entrants)
    nameless = fact.where("Driver_Key IN (20230020, 20230021)")
    assert rows(nameless, "Driver_Key", "Race_Key", "Race_Points", "Team_Key") == [
        (20230020, 1, 4.0, "Beta-2023"), (20230020, 2, 2.0, "Beta-2023"),
        (20230021, 1, 5.0, None), (20230021, 2, 0.0, None),
    ]


def test_fact_driver_in_blocks(standings, calendar, entrants):
    plain = gold.fact_driver(standings, calendar, entrants)
    blocked = gold.fact_driver(standings, calendar, entrants, block=F.trunc("date_start", "quarter"))
    assert rows(plain) == rows(blocked)


def test_team_at_each_race(make, standings, calendar, entrants):
    by_race = make(
        "driver_number int, year int, race_folder_name string, full_name string, team_name string",
        (7, 2023, "01_A", "Ann", "Alpha"), (7, 2023, "02_B", "Ann", "Alpha"),
        (7, 2023, "03_C", "Ann", "Beta"), (7, 2023, "04_D", "Ann", "Beta "),
    )
    fact = gold.fact_driver(standings, calendar, entrants, by_race).where("Driver_Key = 20230007")
    assert [r[1] for r in rows(fact, "Race_Key", "Team_Key")] == [
        "Alpha-2023", "Alpha-2023", "Beta-2023", "Beta-2023"
    ]


def test_fact_team_repairs_and_trims(make, calendar):
    table = make(
        TEAMS,
        ("Alpha ", 2023, 1, 10.0, 2), ("Alpha ", 2023, 2, 25.0, 1),
        ("Alpha ", 2023, 3, 20.0, 1), ("Alpha ", 2023, 4, 30.0, 1), ("Alpha", 2024, 11, 3.0, 4),
    )
    fact = gold.fact_team(table, calendar)
    expected = [
        ("Alpha-2023", 1, 10.0, 10.0, 2), ("Alpha-2023", 2, 15.0, 25.0, 1),
        ("Alpha-2023", 3, 0.0, 25.0, 1), ("Alpha-2023", 4, 5.0, 30.0, 1), ("Alpha-2024", 11, 3.0, 3.0, 4),
    ]
    columns = ("Team_Key", "Race_Key", "Race_Points", "Season_Points", "World_Position")
    assert rows(fact, *columns) == expected
    assert rows(gold.fact_team(table, calendar, block=F.trunc("date_start", "month")), *columns) == expected


def test_fact_team_keeps_repeated_rows(make, calendar):
    table = make(TEAMS, *[("A", 2023, 1, 10.0, 2)] * 3, ("A", 2023, 1, 12.0, 2), ("A", 2023, 2, 11.0, 1))
    fact = gold.fact_team(table, calendar)
    assert rows(fact, "Race_Key", "Season_Points", "Race_Points") == [
        (1, 10.0, 0.0), (1, 10.0, 0.0), (1, 10.0, 10.0), (1, 12.0, 2.0), (2, 12.0, 0.0)
    ]


def test_dim_driver(standings, calendar, entrants):
    dim = gold.dim_driver(entrants, standings, calendar)
    assert rows(dim, "Driver_Key", "Number", "Year", "Driver", "Season_Rank_Sort") == [
        (20230007, 7, 2023, "Ann", 1), (20230008, 8, 2023, "Bob", 5),
        (20230009, 9, 2023, "Cyd", None), (20230020, 20, 2023, None, None),
        (20240007, 7, 2024, "Ann", 2),
    ]
    assert duplicate_keys(dim, ["Driver_Key"]).count() == 0


def test_dim_team_is_one_row_per_trimmed_name(make, entrants):
    teams = make(
        "team_name string, year int, team_logo_url string, last_updated timestamp",
        ("Alpha ", 2023, "a2", day("2024-01-01")), ("Alpha", 2023, "a1", day("2024-01-01")),
        ("Beta", 2023, "b", day("2024-01-01")), ("Delta", 2023, "d", day("2024-01-01")),
    )
    dim = gold.dim_team(teams, entrants)
    assert rows(dim, "Team_Key", "Team", "Team_Logo", "Hex_Color") == [
        ("Alpha-2023", "Alpha", "a1", "#000001"), ("Beta-2023", "Beta", "b", "#00000C"),
        ("Delta-2023", "Delta", "d", "#999999"),
    ]


def test_codes_of_conflicting_names_come_from_the_circuit(calendar):
    dim = gold.dim_race(calendar.unionByName(calendar))
    assert rows(dim, "Race_Key", "GP_Display") == [(1, "MEL"), (2, "SPI"), (3, "MON"), (4, "DUT"), (11, "MON")]


def test_timeline_is_ordered_and_distinct(calendar):
    line = gold.timeline(calendar.unionByName(calendar))
    assert [r.Race_Key for r in line.collect()] == [1, 2, 3, 4, 11]
    assert dict(line.dtypes)["Race_Key"] == "int"


def test_unmatched_keys_fall_on_a_blank_member(make, standings, calendar, entrants):
    fact = gold.fact_driver(standings, calendar, entrants)
    dim_driver = gold.dim_driver(entrants, standings, calendar)
    dim_team = make("Team_Key string, Team string, Team_Logo string, Hex_Color string", ("Beta-2023", "Beta", "b", "#B"))
    joined = star.driver_star(fact, dim_driver, gold.dim_race(calendar), dim_team)
    assert joined.count() == fact.count()
    assert joined.where("Driver_Key = 20230021").first().Driver is None
    assert rows(orphan_keys(fact, dim_driver, "Driver_Key")) == [(20230021, 2)]
    assert rows(orphan_keys(fact, dim_team, "Team_Key")) == [("Alpha-2023", 4), ("Gamma-2024", 1)]


def test_orders(calendar, standings, entrants):
    codes = star.codes_by_date(gold.dim_race(calendar))
    assert [r.GP_Display for r in codes.collect()] == ["MEL", "SPI", "MON", "DUT"]
    ranked = star.drivers_by_rank(gold.dim_driver(entrants, standings, calendar))
    assert [r.Season_Rank_Sort for r in ranked.collect()] == [1, 2, 5, None, None]
