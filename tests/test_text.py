from __future__ import annotations

from conftest import day, rows
from pyspark.sql import functions as F

from seasongrid.functions import display, keys, text


def test_points_format(make):
    df = make("v double", (25.0,), (0.5,), (12.25,), (0.005,), (0.001,), (0.0,), (-3.0,), (100.0,), (None,))
    got = [r[0] for r in df.select(display.display_points(F.col("v"))).collect()]
    assert got == ["25", "0.5", "12.25", "0.01", "-", "-", "", "100", None]


def test_total_and_date_format(make):
    df = make("v double, d timestamp", (1.5, day("2023-03-05")), (10.0, None))
    got = df.select(display.display_total(F.col("v")), display.display_date(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(" 1.5", "05/03/2023"), (" 10", None)]


def test_keys(make):
    df = make("y int, n int, t string", (2023, 44, " Alpha "), (2023, None, None))
    got = df.select(keys.entrant_key(F.col("y"), F.col("n")), keys.team_key(F.col("t"), F.col("y"))).collect()
    assert [tuple(r) for r in got] == [(20230044, "Alpha-2023"), (None, None)]


def test_nameless_join_keys_are_spread_and_match_nothing(make):
    df = make("t string, n int", ("x", 1), (None, 1), (None, 2))
    got = [r[0] for r in df.select(keys.name_or_number(F.col("t"), F.col("n"))).collect()]
    assert got[0] == "x" and len(set(got)) == 3


def test_blank_defaults(make):
    df = make("v string", ("FF8000",), ("",), (None,))
    got = df.select(text.default_if_blank(F.col("v"), "none"), text.hex_colour(F.col("v"), "#999999")).collect()
    assert [tuple(r) for r in got] == [("FF8000", "#FF8000"), ("none", "#999999"), ("none", "#999999")]


def test_folder_names_do_not_cut_long_rounds(make):
    df = make("r int, t string", (3, "Grand Prix X"), (120, "Y"))
    assert rows(df.select(text.folder_name(F.col("r"), F.col("t")))) == [("03_Grand_Prix_X",), ("120_Y",)]


def test_paths(make):
    df = make(
        "p string",
        ("file:/lake/bronze/2023/01_S%20X/drivers.json",),
        ("file:/lake/bronze/season=2024/race_folder=02_Y/drivers-0.json",),
        ("drivers.json",),
    )
    path = F.col("p")
    got = df.select(text.folder_from_path(path), text.season_from_path(path), text.season_by_pattern(path))
    assert rows(got) == [(None, None, None), ("01_S X", 2023, 2023), ("02_Y", 2024, 2024)]


def test_bad_numbers_become_null(make):
    df = make("v string", ("12",), ("",), ("x",))
    assert [r[0] for r in df.select(F.col("v").try_cast("int")).collect()] == [12, None, None]


def test_entrant_keys_are_unique_at_any_number(make):
    from seasongrid.functions.keys import entrant_key

    df = make("year int, number int", (2023, 44), (2023, 12345), (2024, 2345), (2024, 9999), (2025, 10000))
    keys = [r[0] for r in df.select(entrant_key(F.col("year"), F.col("number"))).collect()]
    assert keys[0] == 20230044 and len(set(keys)) == 5


def test_season_by_pattern_and_by_place_agree(make):
    from seasongrid.functions.text import season_by_pattern, season_from_path

    paths = [f"file:/lake/bronze/{s}/01_R1/drivers-1.json" for s in ("2023", "year=2023", "Season=2023", "season_year=2023")]
    df = make("p string", *[(p,) for p in paths])
    got = df.select(season_by_pattern(F.col("p")), season_from_path(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(2023, 2023)] * 4
