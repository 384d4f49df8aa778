"""Queries over driver tables made of a few rows."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

import __spark_entry__ as contract
from seasongrid.plans import silver
from seasongrid.session import fresh_dir
from workload.scans import _last_season
from workload.standins import Standins, race_folder


@pytest.fixture(scope="module")
def tables(spark, make):
    """Two suppliers of different nations, two races, a line without a date."""
    root = fresh_dir(spark, "tables")
    january, march = dt.datetime(1997, 1, 9), dt.datetime(1997, 3, 2)
    data = {
        "lineitem": make(
            "l_suppkey long, l_quantity double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
            (1, 5.0, 0.0, "R", january), (1, 4.0, 0.08, "R", march), (2, 7.0, 0.0, "R", january),
            (2, 3.0, 0.0, "N", march), (2, 2.0, 0.0, "R", None),
        ),
        "supplier": make(
            "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
            (1, "Supplier#001", 0, 10.0), (2, "Supplier#002", 1, 20.0),
        ),
        "nation": make("n_nationkey int, n_name string, n_regionkey int", (0, "PERU", 0), (1, "CHINA", 1)),
        "region": make("r_regionkey int, r_name string", (0, "AMERICA"), (1, "ASIA")),
    }
    for name, table in data.items():
        table.write.parquet(f"{root}/{name}.parquet")
    return root


def test_every_team_standing_gets_the_load_stamp(spark, tables):
    stamp = dt.datetime(2024, 1, 1)
    found = rows(contract.queries()["fn_load_stamp"](spark, tables), "team_name", "meeting_key", "ingestion_date")
    assert found == [
        ("Team CHINA", None, stamp), ("Team CHINA", 199701, stamp),  # no points, no place in March
        ("Team PERU", 199701, stamp), ("Team PERU", 199703, stamp),
    ]


def test_results_have_one_key_for_the_month(spark, tables):
    s = Standins(spark, tables)
    found = rows(s.raw_results, "driver_number", "year", "meeting_key", "pts", "pen", "cp")
    assert found == [
        (1, 1997, 199701, 5.0, 0.0, 5.0), (1, 1997, 199703, 4.0, 4.0, 9.0),
        (2, None, None, 2.0, 0.0, 2.0), (2, 1997, 199701, 7.0, 0.0, 7.0), (2, 1997, 199703, None, 0.0, 7.0),
    ]


def test_folder_names_are_made_once_for_a_race(spark, tables):
    s = Standins(spark, tables)
    placed = s.in_folder(s.driver_records)
    assert "format_string" not in placed._jdf.queryExecution().optimizedPlan().toString()
    records = s.driver_records.withColumn("race_folder", race_folder(s.driver_records["meeting_key"]))
    assert rows(placed, *records.columns) == rows(records)
    assert placed.where("race_folder IS NULL").count() == 0  # nor is a record without a date lost


def test_rows_of_a_race_are_ordered_without_its_folder(make):
    schema = "driver_number int, full_name string, name_acronym string, team_name string, country_code string, headshot_url string, team_colour string, year int, race_folder_name string"
    roster = make(
        schema,
        (1, "Ann", "A", "Beta", "AA", "u", "c", 2024, "02_R2"), (1, "Ann", "A", "Alpha", "AA", "u", "c", 2024, "02_R2"),
        (1, "Ann", "A", "Gamma", "AA", "u", "c", 2024, "10_R10"),
    )
    by_race = silver.entrants_by_race(roster)
    assert rows(by_race, "race_folder_name", "team_name") == [("02_R2", "Alpha"), ("10_R10", "Gamma")]
    assert "regexp_extract" not in by_race._jdf.queryExecution().optimizedPlan().toString()
    assert rows(silver.entrants(by_race), "team_name") == [("Gamma",)]


def test_lines_are_read_once_for_results_and_calendar(spark, tables, monkeypatch):
    plain = rows(Standins(spark, tables).meetings)
    names, table = [], Standins.table
    monkeypatch.setattr(Standins, "table", lambda self, name: names.append(name) or table(self, name))
    s = Standins(spark, tables)
    assert _last_season(s) == 1997
    assert rows(s.meetings) == plain and len(plain) == 3  # also the month that is not known
    assert rows(s.raw_results)
    assert names.count("lineitem") == 1
