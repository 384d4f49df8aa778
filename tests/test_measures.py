"""Worked cases: 2023 has R1 (d1), R2 (d2, cancelled) and R3 (d3), 2024 has R4 (d4)."""

from __future__ import annotations

import pytest
from conftest import day, rows

from seasongrid.plans import measures

D1, D2, D3 = day("2023-03-01"), day("2023-04-01"), day("2023-05-01")
D4 = day("2024-03-01")


@pytest.fixture(scope="module")
def dim_race(make):
    return make(
        "Race_Key long, Year int, Grand_Prix string, Circuit_Name string, GP_Display string, Date timestamp",
        (1, 2023, "One", "c", "R1", D1), (2, 2023, "Two", "c", "R2", D2),
        (3, 2023, "Three", "c", "R3", D3), (4, 2024, "Four", "c", "R4", D4),
    )


@pytest.fixture(scope="module")
def timeline(dim_race):
    return dim_race.select("Date", "Race_Key")


@pytest.fixture(scope="module")
def teams(make, dim_race):
    facts = make(
        "Team string, Team_Key string, Race_Key long, Season_Points float, World_Position int",
        ("A", "A-2023", 1, 10.0, 2), ("A", "A-2023", 3, 30.0, 1), ("A", "A-2024", 4, 5.0, 3),
    )
    return facts.join(dim_race, "Race_Key")


@pytest.fixture(scope="module")
def drivers(make, dim_race):
    facts = make(
        "Driver string, Driver_Key long, Team_Key string, Race_Key long, World_Position int",
        ("D", 20230001, "A-2023", 1, 4), ("D", 20230001, "B-2023", 3, 6), ("E", 20230002, "A-2023", 1, 5),
    )
    return facts.join(dim_race, "Race_Key")


@pytest.fixture(scope="module")
def dim_team(make):
    return make(
        "Team_Key string, Team string, Team_Logo string, Hex_Color string",
        ("A-2023", "A", "logo-a", "#1"), ("B-2023", "B", "logo-b", "#2"), ("A-2024", "A", "logo-a24", "#3"),
    )


def test_team_points(teams):
    by = ["Team"]
    assert rows(measures.team_points(teams, by, years=[2023])) == [("A", 30.0)]
    assert rows(measures.team_points(teams, by, years=[2023], play_until=D2)) == [("A", 10.0)]
    assert rows(measures.team_points(teams, by, play_until=D4)) == [("A", 30.0)]
    assert rows(measures.team_points(teams, by, play_until=day("2022-01-01"))) == []


def test_team_points_on_a_race_axis(teams):
    by = ["Team", "GP_Display"]
    assert rows(measures.team_points(teams, by, years=[2023])) == [("A", "R1", 10.0), ("A", "R3", 30.0)]
    assert rows(measures.team_points(teams, by, years=[2023], play_until=D2)) == [("A", "R1", 10.0)]


def test_team_points_on_a_date_axis(teams, dim_race):
    got = measures.team_points_by_date(teams, dim_race, ["Team"], years=[2023])
    assert rows(got, "Date", "Team_Points") == [(D1, 10.0), (D2, 10.0), (D3, 30.0)]
    everything = measures.team_points_by_date(teams, dim_race, ["Team"])
    assert rows(everything, "Date", "Team_Points")[-1] == (D4, 30.0)
    played = measures.team_points_by_date(teams, dim_race, ["Team"], play_until=D2)
    assert rows(played, "Date", "Team_Points") == [(D1, 10.0), (D2, 10.0)]


def test_team_ranks(teams):
    by = ["Team"]
    assert rows(measures.team_ranks(teams, by, years=[2023])) == [("A", 1)]
    assert rows(measures.team_ranks(teams, by, years=[2023], play_until=D2)) == [("A", 2)]
    assert rows(measures.team_ranks(teams, by)) == [("A", 3)]


def test_team_ranks_fill_missing_races_within_the_season(teams, dim_race):
    def filled(**context):
        return rows(measures.team_ranks_by_race(teams, dim_race, ["Team"], **context), "Race_Key", "Team_Ranks")

    assert filled(years=[2023]) == [(1, 2), (2, 2), (3, 1)]
    assert filled() == [(1, 2), (2, 2), (3, 1), (4, 3)]
    assert filled(years=[2023], play_until=D2) == [(1, 2), (2, 2)]


def test_team_ranks_do_not_leak_into_the_next_season(make, dim_race):
    late = make("Race_Key long, Year int, GP_Display string, Date timestamp", (5, 2024, "R5", day("2024-04-01")))
    races = dim_race.select("Race_Key", "Year", "GP_Display", "Date").unionByName(late)
    facts = make(
        "Team string, Year int, Date timestamp, World_Position int", ("A", 2023, D3, 1), ("A", 2024, day("2024-04-01"), 7)
    )
    got = measures.team_ranks_by_race(facts, races, ["Team"])
    assert rows(got, "Race_Key", "Team_Ranks") == [(3, 1), (5, 7)]


def test_team_ranks_on_an_axis_of_recurring_codes(make):
    races = make(
        "Race_Key long, Year int, GP_Display string, Date timestamp",
        (1, 2023, "X", day("2023-03-01")), (2, 2023, "Y", day("2023-04-01")), (3, 2023, "Z", day("2023-05-01")),
        (4, 2024, "Y", day("2024-03-01")), (5, 2024, "X", day("2024-04-01")),
    )
    facts = make(
        "Team string, Year int, Date timestamp, World_Position int",
        ("A", 2023, day("2023-03-01"), 1), ("A", 2023, day("2023-05-01"), 2), ("A", 2024, day("2024-03-01"), 3),
        ("B", 2023, day("2023-03-01"), 4), ("B", 2023, day("2023-05-01"), 5), ("B", 2024, day("2024-04-01"), 6),
    )

    def ranks(**context):
        return rows(measures.team_ranks_by_code(facts, races, ["Team"], **context))

    assert ranks() == [
        ("A", "X", 3), ("A", "Y", 3), ("A", "Z", 2),
        ("B", "X", 6), ("B", "Y", 5), ("B", "Z", 5),
    ]
    assert ranks(years=[2023]) == [
        ("A", "X", 1), ("A", "Y", 1), ("A", "Z", 2), ("B", "X", 4), ("B", "Y", 4), ("B", "Z", 5)
    ]
    assert ranks(play_until=day("2024-03-15")) == [
        ("A", "X", 1), ("A", "Y", 3), ("A", "Z", 2), ("B", "X", 4), ("B", "Y", 5), ("B", "Z", 5)
    ]


def test_races_of_one_day_share_the_larger_rank(make):
    races = make("Race_Key long, Year int, Date timestamp", (1, 2023, D1), (2, 2023, D1), (3, 2023, D2))
    facts = make("Team string, Year int, Date timestamp, World_Position int", ("A", 2023, D1, 4), ("A", 2023, D1, 6))
    got = measures.team_ranks_by_race(facts, races, ["Team"])
    assert rows(got, "Race_Key", "Team_Ranks") == [(1, 6), (2, 6), (3, 6)]
    assert rows(measures.team_ranks(facts, ["Team"])) == [("A", 6)]


def test_driver_ranks(drivers, dim_race):
    by = ["Driver"]
    assert rows(measures.driver_ranks(drivers, dim_race, by, [2023])) == [("D", 6), ("E", None)]
    assert rows(measures.driver_ranks(drivers, dim_race, by)) == [("D", None), ("E", None)]
    own = measures.driver_ranks_by_race(drivers, dim_race, by, ["GP_Display"], [2023])
    assert rows(own.where("Driver = 'D'")) == [("D", "R1", 4), ("D", "R3", 6)]


def test_driver_ranks_on_an_axis_of_recurring_codes(make):
    races = make("Race_Key long, Year int, GP_Display string, Date timestamp", (1, 2023, "X", D1), (4, 2024, "X", D4))
    facts = make("Driver string, Race_Key long, World_Position int", ("D", 1, 2), ("D", 4, 7), ("E", 1, 3))
    star = facts.join(races, "Race_Key")
    assert rows(measures.driver_ranks_by_race(star, races, ["Driver"], ["GP_Display"])) == [("D", "X", 7), ("E", "X", None)]
    assert rows(measures.driver_ranks_by_race(star, races, ["Driver"], ["GP_Display"], [2023])) == [
        ("D", "X", 2), ("E", "X", 3)
    ]


def test_actual_team_logo(drivers, dim_race, dim_team):
    def logos(**context):
        return dict(rows(measures.actual_team_logo(drivers, dim_race, dim_team, ["Driver"], **context)))

    assert logos(years=[2023], play_until=D2) == {"D": "logo-a", "E": "logo-a"}
    assert logos(years=[2023]) == {"D": "logo-b", "E": "logo-a"}
    assert logos() == {"D": None, "E": None}
    assert logos(years=[2023], play_until=day("2022-01-01")) == {"D": None, "E": None}


def test_team_colour(dim_team):
    assert rows(measures.team_colour(dim_team, ["Team"])) == [("A", "#3"), ("B", "#2")]


def test_draw_team_points(teams, dim_race, timeline):
    def drawn(**context):
        got = measures.draw_team_points(teams, dim_race, timeline, ["Team"], **context)
        return [r[1:] for r in rows(got)]

    axis = {"axis": ["GP_Display"], "years": [2023]}
    assert drawn(**axis) == [("R1", 10.0), ("R3", 30.0)]
    assert drawn(**axis, play_until=D2) == [("R1", 10.0), ("R3", None)]
    assert drawn(**axis, play_until=day("2022-01-01")) == [("R1", None), ("R3", None)]
    assert drawn(axis=[], years=[2023], play_until=D2) == [(None,)]
    assert drawn(axis=[], years=[2023], play_until=D3) == [(30.0,)]


def test_championship_state(teams, dim_race):
    got = measures.championship_state_at(teams, dim_race, D2, ["Team"])
    assert rows(got) == [("A", 2023, 10.0, 2, None), ("A", 2024, None, None, None)]
    done = measures.championship_state_at(teams, dim_race, D3, ["Team"])
    assert rows(done)[0] == ("A", 2023, 30.0, 1, 30.0)
