"""The physical plans the operators are designed for."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from seasongrid.operators.series import previous_value, running_max
from seasongrid.plans import gold, measures, silver
from seasongrid.session import fresh_dir
from seasongrid.sources import sinks
from seasongrid.sources.tables import read_table, register_star
from workload.standins import Standins

from __spark_entry__ import queries
from workload import registry


def plan(df) -> str:
    """The executed plan without the numbers Spark gives to expressions."""
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r" Exchange ", plan(df)))


@pytest.fixture(scope="module", autouse=True)
def no_automatic_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def tables(spark):
    return Standins(spark, SMALL)


def test_one_row_per_group_is_cut_before_the_shuffle(spark):
    # ranks: once per entrant, then once per name
    for name, limits in (("top1_per_group", 2), ("window_row_number_latest", 4)):
        assert plan(queries()[name](spark, SMALL)).count("WindowGroupLimit") == limits, name


def test_race_rows_never_move_by_name(spark, tables):
    standings = sinks.stored(tables.standings, "standings")
    entrants = sinks.stored(tables.entrants, "entrants")
    text = plan(gold.dim_driver(entrants, standings, tables.calendar))
    assert "hashpartitioning(Driver_Key" not in text
    # The plan is printed from its result down: by name above, one row per entrant below it.
    by_name = text.index("hashpartitioning(full_name")
    last_race = [m.start() for m in re.finditer(r"WindowGroupLimit \[driver_number", text)]
    assert last_race and min(last_race) > by_name
    assert "hashpartitioning(full_name" not in text[min(last_race):]


def test_team_fact_does_not_move_single_copies(tables):
    text = plan(gold.fact_team(tables.team_standings, tables.calendar))
    assert "REPARTITION_BY_COL" not in text
    few, many = text.split("Union")[1].split("REPARTITION_BY_NUM", 1)
    assert "REPARTITION" not in few and "> 65536" in many


@pytest.fixture(scope="module")
def landed_star(spark, tables):
    root = fresh_dir(spark, "star")
    facts = {
        "fact_driver_results": gold.fact_driver(tables.standings, tables.calendar, tables.entrants, by_season=True),
        "fact_team_results": gold.fact_team(tables.team_standings, tables.calendar, by_season=True),
    }
    for name, fact in facts.items():
        sinks.overwrite_table(fact, f"{root}/{name}", by=(gold.SEASON,))
    for name in ("dim_driver", "dim_team", "dim_race"):
        sinks.overwrite_table(getattr(tables, name), f"{root}/{name}")
    sinks.overwrite_table(tables.timeline, f"{root}/ui_play_timeline")
    return register_star(spark, root)


def test_measures_of_a_season_prune_the_fact(landed_star, tables):
    race = landed_star["dim_race"]
    teams = landed_star["fact_team_results"].join(race, "Race_Key", "left")
    drivers = landed_star["fact_driver_results"].join(race, "Race_Key", "left")
    ranks = measures.team_ranks(teams, years=[1998], play_until="1998-06-01")
    driver_ranks = measures.driver_ranks(drivers, race, years=[1998])
    logos = measures.actual_team_logo(drivers, race, landed_star["dim_team"], years=[1998])
    for measure in (ranks, driver_ranks, logos):
        assert re.search(r"PartitionFilters: \[[^\]]*season[^\]]*1998", plan(measure))
    assert rows(ranks) == rows(measures.team_ranks(tables.team_star, years=[1998], play_until="1998-06-01"))
    assert rows(driver_ranks) == rows(measures.driver_ranks(tables.driver_star, tables.dim_race, years=[1998]))


def test_bucketed_tables_join_without_moving_rows(spark):
    text = plan(queries()["join_star_bucketed"](spark, SMALL))
    join = text[text.index("SortMergeJoin"):]
    assert "Exchange" not in join and "Bucketed: true" in join and "SelectedBucketsCount: 8 out of 8" in join


def test_points_by_date_plans_the_days_once(spark):
    assert shuffles(queries()["measure_points_by_date"](spark, SMALL)) <= 10


def test_roster_rows_are_cut_before_the_shuffle(tables):
    roster = sinks.stored(tables.roster, "roster")
    assert plan(silver.entrants(roster)).count("WindowGroupLimit") == 2


def test_repair_and_lag_share_one_shuffle_and_sort(tables):
    series = gold.team_results(tables.team_standings, tables.calendar)
    base = sinks.stored(series, "series")
    repaired = running_max(base, "points", gold.TEAM_SERIES, gold.TEAM_ORDER, "fixed")
    lagged = previous_value(repaired, "fixed", gold.TEAM_SERIES, gold.TEAM_ORDER, "prev")
    assert shuffles(lagged) == 1
    assert len(re.findall(r"\bSort \[", plan(lagged))) == 1


def test_driver_fact_shuffles_results_twice_and_the_roster_once(spark, tables):
    standings = sinks.stored(tables.standings, "standings")
    entrants = sinks.stored(tables.entrants, "entrants")
    fact = gold.fact_driver(standings, F.broadcast(tables.calendar), entrants)
    # Results by race, then by season for join and window; roster.  The calendar is stored, without a shuffle.
    assert shuffles(fact) == 3


def test_season_filter_prunes_partitions(spark, make):
    path = fresh_dir(spark, "pruned")
    sinks.overwrite_seasons(make("k int, year int", (1, 2023), (2, 2024)), path)
    table = read_table(spark, path, seasons=[2024])
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan(table))
    assert rows(table, "k") == [(2,)]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries()["filter_pushdown_eq"](spark, SMALL))
    assert "EqualTo(o_orderstatus,F)" in text and "EqualTo(o_orderpriority,2-HIGH)" in text
    assert "o_totalprice" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_no_query_leaves_the_engine_or_crosses_tables(spark):
    for name in registry.QUERIES:
        build = queries()[name]
        if name.startswith(("sink_", "scan_", "silver_", "incremental")):
            continue
        text = plan(build(spark, SMALL))
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)
