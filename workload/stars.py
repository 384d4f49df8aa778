"""Dimensions, facts, star order and measures on the stand-in season tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.plans import gold, measures, silver, star
from seasongrid.sources.sinks import stored
from workload.registry import query
from workload.standins import Standins

# A replay stops here; the running season has races on both sides of it.
CUTOFF = "1998-06-01 00:00:00"
SEASON = 1998

# ---- builders ---------------------------------------------------------------


@query
def season_catalog(s: Standins) -> DataFrame:
    races = silver.race_sessions(s.session_records, ["session_start", "session_key"])
    return silver.season_catalog(s.meetings, races)


@query
def gold_dim_driver(s: Standins) -> DataFrame:
    return s.dim_driver


@query
def gold_dim_team(s: Standins) -> DataFrame:
    return s.dim_team


@query
def gold_dim_race(s: Standins) -> DataFrame:
    return s.dim_race


@query
def gold_fact_driver(s: Standins) -> DataFrame:
    return s.fact_driver


@query
def gold_fact_driver_team_at_race(s: Standins) -> DataFrame:
    return gold.fact_driver(s.standings, s.calendar, s.entrants, silver.entrants_by_race(s.listed(s.roster)))


@query
def gold_fact_team(s: Standins) -> DataFrame:
    return s.fact_team


@query
def gold_fact_team_blocked(s: Standins) -> DataFrame:
    """Every third race's standings twice, series cut into quarters."""
    twice = s.team_standings.unionByName(s.team_standings.where("meeting_key % 3 = 0"))
    return gold.fact_team(twice, s.calendar, block=F.date_trunc("quarter", "date_start"))


@query
def timeline(s: Standins) -> DataFrame:
    return s.timeline


@query
def order_gp_by_date(s: Standins) -> DataFrame:
    return star.codes_by_date(s.dim_race)


@query
def order_driver_by_rank(s: Standins) -> DataFrame:
    return star.drivers_by_rank(s.dim_driver)


@query
def standings_by_round(s: Standins) -> DataFrame:
    return star.standings_by_round(s.fact_driver, s.dim_driver, s.dim_race, s.dim_team)


# ---- measures ---------------------------------------------------------------


@query
def measure_points_as_of(s: Standins) -> DataFrame:
    return measures.team_points(s.team_star, play_until=CUTOFF)


@query
def measure_points_by_race(s: Standins) -> DataFrame:
    return measures.team_points(s.team_star, by=["Team_Key", "Year", "GP_Display"], play_until=CUTOFF)


@query
def measure_points_by_date(s: Standins) -> DataFrame:
    return measures.team_points_by_date(s.team_star, s.dim_race, play_until=CUTOFF)


@query
def measure_point_spans(s: Standins) -> DataFrame:
    return measures.team_point_spans(s.team_star)


@query
def measure_points_on_dates(s: Standins) -> DataFrame:
    """The first race day of every quarter, read from stored spans."""
    spans = stored(measures.team_point_spans(s.team_star), "spans")
    quarters = s.dim_race.groupBy(F.date_trunc("quarter", "Date")).agg(F.min("Date").alias("Date"))
    return measures.team_points_on(spans, quarters)


@query
def measure_team_ranks(s: Standins) -> DataFrame:
    return measures.team_ranks_by_race(s.team_star, s.dim_race, play_until=CUTOFF)


@query
def measure_team_ranks_as_of(s: Standins) -> DataFrame:
    return measures.team_ranks(s.team_star, years=[SEASON], play_until=CUTOFF)


@query
def measure_team_ranks_by_code(s: Standins) -> DataFrame:
    named = s.team_star.join(s.dim_team.select("Team_Key", "Team"), "Team_Key")
    return measures.team_ranks_by_code(named, s.dim_race, ["Team"], play_until=CUTOFF)


@query
def window_ffill_rank(s: Standins) -> DataFrame:
    return measures.team_ranks_by_race(s.team_star, s.dim_race)


@query
def measure_driver_ranks(s: Standins) -> DataFrame:
    return measures.driver_ranks(s.driver_star, s.dim_race, years=[SEASON])


@query
def measure_driver_ranks_by_race(s: Standins) -> DataFrame:
    return measures.driver_ranks_by_race(s.driver_star, s.dim_race)


@query
def measure_driver_ranks_by_code(s: Standins) -> DataFrame:
    named = s.driver_star.join(s.dim_driver.select("Driver_Key", "Driver"), "Driver_Key")
    return measures.driver_ranks_by_race(named, s.dim_race, ["Driver"], ["GP_Display"])


@query
def measure_actual_team_logo(s: Standins) -> DataFrame:
    per_race = gold.fact_driver(s.standings, s.calendar, s.entrants, silver.entrants_by_race(s.roster))
    raced = per_race.join(s.dim_race, "Race_Key", "left")
    return measures.actual_team_logo(raced, s.dim_race, s.dim_team, years=[SEASON], play_until=CUTOFF)


@query
def measure_team_color(s: Standins) -> DataFrame:
    return measures.team_colour(s.dim_team, ["Team"])


@query
def measure_draw_team_points(s: Standins) -> DataFrame:
    return measures.draw_team_points(
        s.team_star, s.dim_race, s.timeline, by=["Team_Key"], axis=["Year", "GP_Display"], play_until=CUTOFF
    )


@query
def championship_state_at(s: Standins) -> DataFrame:
    return measures.championship_state_at(s.team_star, s.dim_race, CUTOFF)
