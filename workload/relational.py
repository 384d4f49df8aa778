"""Projections, filters, joins, aggregates, windows and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.functions.cast import to_type
from seasongrid.functions.display import display_date, display_points, display_total
from seasongrid.functions.keys import entrant_key, team_key
from seasongrid.functions.text import (
    code3,
    default_if_blank as or_default,
    folder_from_path,
    hex_colour,
    logo_url,
    path_segment,
    season_from_path,
)
from seasongrid.operators.codes import names_per_code
from seasongrid.operators.dedup import first_per_group
from seasongrid.operators.joins import forward_fill, last_nonblank
from seasongrid.operators.quality import duplicate_keys, orphan_keys
from seasongrid.operators.series import clamped_delta, previous_value, running_max
from seasongrid.operators.summaries import selected_value, top_season_points, total_race_points
from seasongrid.plans import gold, silver, star
from seasongrid.session import fresh_dir
from seasongrid.sources.tables import store_bucketed
from workload.registry import query
from workload.standins import ASSETS, Standins, loaded_at

# ---- projections ------------------------------------------------------------


@query
def project_typed(s: Standins) -> DataFrame:
    return s.table("customer").select(
        to_type(F.col("c_custkey"), "int").alias("number"),
        to_type(F.col("c_acctbal"), "float").alias("balance"),
        to_type(F.substring("c_name", 10, 9), "long").alias("number_in_name"),
        to_type(F.col("c_nationkey"), "string").alias("nation"),
    )


@query
def project_join_aliases(s: Standins) -> DataFrame:
    return gold.with_colour(s.teams, gold.team_colours(s.entrants)).drop("last_updated")


@query
def project_derived(s: Standins) -> DataFrame:
    part = s.table("part").select("p_partkey", "p_name", "p_type", "p_size")
    return part.withColumns(
        {
            "code": code3(F.col("p_name")),
            "double_size": F.col("p_size") * 2,
            "label": F.concat("p_type", F.lit("-"), F.col("p_size").cast("string")),
        }
    )


@query
def project_rename(s: Standins) -> DataFrame:
    return gold.timeline_rows(s.calendar)


# ---- filters ----------------------------------------------------------------


@query
def filter_na_drop(s: Standins) -> DataFrame:
    records = s.driver_records.select("driver_number", "meeting_key", F.col("position_current").alias("position"))
    return records.na.drop(subset=["driver_number", "position"])


@query
def filter_not_contains(s: Standins) -> DataFrame:
    """Names with "ring" stand for tests."""
    name = F.when(F.col("p_size") > 1, F.col("p_name"))
    parts = s.table("part").select("p_partkey", name.alias("name"))
    return parts.where(silver.is_race_meeting(F.replace("name", F.lit("ring"), F.lit("Testing"))))


@query
def filter_not_null(s: Standins) -> DataFrame:
    return gold.with_name(s.roster_records).select("driver_number", "meeting_key", "full_name")


@query
def filter_isin(s: Standins) -> DataFrame:
    return silver.result_sessions(s.session_records).select("meeting_key", "session_key", "session_name")


@query
def filter_pushdown_eq(s: Standins) -> DataFrame:
    wanted = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "F")
    return s.table("orders").where(wanted).select("o_orderkey", "o_custkey")


@query
def default_if_blank(s: Standins) -> DataFrame:
    return s.roster_records.select(
        "driver_number",
        "meeting_key",
        or_default(F.col("headshot_url"), ASSETS.default_photo).alias("photo"),
        hex_colour(F.col("team_colour"), ASSETS.default_colour).alias("colour"),
    )


# ---- joins ------------------------------------------------------------------


@query
def join_inner(s: Standins) -> DataFrame:
    return gold.raced(s.standings, s.calendar)


@query
def join_inner_composite(s: Standins) -> DataFrame:
    return gold.under_name(s.entrants, gold.raced(s.standings, s.calendar))


@query
def join_left_selfderived(s: Standins) -> DataFrame:
    ranks = gold.final_ranks(s.entrants, s.standings, s.calendar)
    return gold.with_final_rank(s.entrants, ranks).select(
        "driver_number", "year", "full_name", "Final_Season_Rank"
    )


@query
def join_left_composite(s: Standins) -> DataFrame:
    return gold.with_colour(s.teams, gold.team_colours(s.entrants)).select("team_name", "year", "Hex_Color")


@query
def join_chain_inner_left(s: Standins) -> DataFrame:
    return gold.entrant_results(gold.one_per_race(s.standings), s.calendar, s.entrants)


@query
def join_inner_default(s: Standins) -> DataFrame:
    return gold.team_results(s.team_standings, s.calendar).drop("ingestion_date")


@query
def join_star_driver(s: Standins) -> DataFrame:
    return s.full_driver_star


@query
def join_star_bucketed(s: Standins) -> DataFrame:
    """Facts, by season and bucket, joined in place with drivers in the same buckets."""
    root, name = fresh_dir(s.spark, "bucketed"), f"b{uuid.uuid4().hex[:12]}"
    season = (F.col("Race_Key") / 100).cast("int")
    facts = store_bucketed(s.fact_driver.withColumn(gold.SEASON, season), f"{name}_fact", f"{root}/fact", "Driver_Key", 8, gold.SEASON)
    drivers = store_bucketed(s.dim_driver, f"{name}_driver", f"{root}/driver", "Driver_Key", 8)
    return star.with_driver(facts, drivers).groupBy("Driver_Key", "Driver", gold.SEASON).agg(
        F.count(F.lit(1)).alias("results"), F.max("Season_Points").alias("points")
    )


@query
def join_star_team(s: Standins) -> DataFrame:
    return s.full_team_star


@query
def join_star_timeline(s: Standins) -> DataFrame:
    return star.timeline_star(s.timeline, s.dim_race)


@query
def join_asof_rank(s: Standins) -> DataFrame:
    """Each entrant's last known position as of every race of its season."""
    races = s.calendar.select(
        F.col("year").alias("Year"), F.col("meeting_key").alias("Race_Key"), F.col("date_start").alias("Date")
    )
    dated = gold.raced(s.standings, s.calendar).select(
        "driver_number", F.col("year").alias("Year"), F.col("date_start").alias("Date"), "position"
    )
    return forward_fill(dated, races, ["driver_number"], "position", "last_position")


# ---- aggregates -------------------------------------------------------------


@query
def agg_max_ts(s: Standins) -> DataFrame:
    """Standings loaded on the day of their race."""
    day = F.to_timestamp_ntz(F.concat(F.col("meeting_key").cast("string"), F.lit("01")), F.lit("yyyyMMdd"))
    return silver.teams(s.team_standings.withColumn("ingestion_date", day), ASSETS).drop("team_logo_url")


@query
def agg_max_string(s: Standins) -> DataFrame:
    return gold.team_colours(s.entrants)


@query
def agg_max_multi(s: Standins) -> DataFrame:
    """Standings delivered twice, the second time with other values."""
    second = s.standings.withColumns(
        {"points": (F.col("points") - 2).cast("float"), "position": F.col("position") + 1}
    )
    return gold.one_per_race(s.standings.unionByName(second))


@query
def dedup_by_key(s: Standins) -> DataFrame:
    return silver.entrants(s.roster).drop("ingestion_date")


@query
def distinct_rows(s: Standins) -> DataFrame:
    return s.roster_records.select("driver_number", "year", "team_name").distinct()


@query
def distinct_count_window(s: Standins) -> DataFrame:
    names = s.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("gp_name"))
    regions = s.table("region").select(
        (-F.col("r_regionkey") - 1).cast("long").alias("id"), F.col("r_name").alias("gp_name")
    )
    return names_per_code(names.unionByName(regions), "gp_name")


@query
def measure_max(s: Standins) -> DataFrame:
    return s.full_team_star.groupBy("Year").agg(
        F.max(F.col("Season_Points").cast("double")).alias("max_points"),
        F.max("World_Position").alias("max_position"),
        F.max("Race_Key").alias("max_race"),
        F.max("Date").alias("max_date"),
        F.max("Team_Logo").alias("max_logo"),
    )


@query
def implicit_sum_race_points(s: Standins) -> DataFrame:
    return total_race_points(s.full_team_star, ["Year", "Team"])


@query
def implicit_max_season_points(s: Standins) -> DataFrame:
    return top_season_points(s.driver_star, ["Year", "GP_Display"])


@query
def agg_last_nonblank(s: Standins) -> DataFrame:
    """Position after the last race in which points were won."""
    scored = F.when(F.col("Race_Points") > 0, F.col("World_Position"))
    facts = s.driver_star.select("Driver_Key", "Date", scored.alias("scored_position"))
    return last_nonblank(facts, ["Driver_Key"], "Date", "scored_position", "last_scored_position")


@query
def agg_selected_value(s: Standins) -> DataFrame:
    """The team of an entrant and season, blank if there were several."""
    return s.roster_records.groupBy("driver_number", "year").agg(selected_value("team_name").alias("only_team"))


# ---- windows ----------------------------------------------------------------


def _driver_series(s: Standins) -> DataFrame:
    dated = s.standings.join(s.calendar.select("meeting_key", "date_start"), "meeting_key")
    return dated.select("driver_number", "year", "meeting_key", "date_start", "points", "position")


def _team_series(s: Standins) -> DataFrame:
    return gold.team_results(s.team_standings, s.calendar).select(
        "team_name", "year", "meeting_key", "date_start", "points", "position"
    )


@query
def window_row_number_latest(s: Standins) -> DataFrame:
    return gold.final_ranks(s.entrants, s.standings, s.calendar)


@query
def top1_per_group(s: Standins) -> DataFrame:
    order = [F.col("points").desc(), F.col("driver_number").asc()]
    best = first_per_group(s.standings, ["year", "meeting_key"], order)
    return best.select("year", "meeting_key", "driver_number", "points")


@query
def window_lag_default(s: Standins) -> DataFrame:
    return previous_value(_driver_series(s), "points", gold.ENTRANT_SERIES, gold.RACE_ORDER, "prev_points")


@query
def window_running_max(s: Standins) -> DataFrame:
    return running_max(_team_series(s), "points", gold.TEAM_SERIES, gold.TEAM_ORDER, "fixed_points")


@query
def window_lag_of_running_max(s: Standins) -> DataFrame:
    repaired = running_max(_team_series(s), "points", gold.TEAM_SERIES, gold.TEAM_ORDER, "fixed_points")
    return previous_value(repaired, "fixed_points", gold.TEAM_SERIES, gold.TEAM_ORDER, "prev_points")


@query
def delta_clamped(s: Standins) -> DataFrame:
    series = previous_value(_driver_series(s), "points", gold.ENTRANT_SERIES, gold.RACE_ORDER, "prev_points")
    return series.select(
        "driver_number",
        "year",
        "meeting_key",
        "points",
        clamped_delta(F.col("points"), F.col("prev_points")).alias("race_points"),
    )


# ---- scalar functions -------------------------------------------------------


@query
def fn_try_cast(s: Standins) -> DataFrame:
    return s.table("part").select(
        "p_partkey",
        to_type(F.substring("p_brand", 7, 3), "int").alias("brand_number"),
        to_type(F.col("p_name"), "int").alias("name_as_int"),
        to_type(F.col("p_retailprice").cast("string"), "float").alias("price"),
        to_type(F.concat(F.lit("2024-01-"), F.col("p_size").cast("string")), "timestamp_ntz").alias("day"),
    )


@query
def fn_split_element(s: Standins) -> DataFrame:
    path = F.concat_ws("/", F.lit("bronze"), F.col("p_size").cast("string"), "p_name", F.lit("x.json"))
    return s.table("part").select(
        "p_partkey",
        folder_from_path(path).alias("folder"),
        season_from_path(path).alias("season"),
        path_segment(path, 9).alias("beyond"),
    )


@query
def fn_logo_url(s: Standins) -> DataFrame:
    return s.table("part").select("p_partkey", logo_url(ASSETS.logo_base, F.col("p_name")).alias("url"))


@query
def fn_concat_key(s: Standins) -> DataFrame:
    rows = s.roster_records.select("driver_number", "meeting_key", "full_name", "year")
    return rows.select(
        "driver_number",
        "meeting_key",
        team_key(F.col("full_name"), F.col("year")).alias("name_key"),
    )


@query
def fn_code3(s: Standins) -> DataFrame:
    return s.table("part").select(
        "p_partkey", code3(F.col("p_name")).alias("name_code"), code3(F.col("p_type")).alias("type_code")
    )


@query
def fn_trim_key(s: Standins) -> DataFrame:
    rows = s.roster_records.select("driver_number", "meeting_key", "team_name", "year")
    return rows.withColumn("Team_Key", team_key(F.col("team_name"), F.col("year")))


@query
def fn_case_when(s: Standins) -> DataFrame:
    return s.table("customer").select(
        "c_custkey",
        clamped_delta(F.col("c_acctbal"), F.lit(1000)).alias("gain"),
        F.when(F.col("c_acctbal") > 5000, F.lit("high")).when(F.col("c_acctbal") > 0, F.lit("low")).alias("level"),
    )


@query
def fn_load_stamp(s: Standins) -> DataFrame:
    stamped = silver.stamped(s.team_standings.drop("ingestion_date"), loaded_at())
    return stamped.select("team_name", "meeting_key", "ingestion_date")


@query
def fn_driver_key(s: Standins) -> DataFrame:
    return s.standings.select(
        "driver_number", "meeting_key", entrant_key(F.col("year"), F.col("driver_number")).alias("Driver_Key")
    )


@query
def fn_coalesce_default(s: Standins) -> DataFrame:
    return silver.with_session_name(s.session_records).select("session_key", "session_name")


@query
def fn_display_format(s: Standins) -> DataFrame:
    signed = F.when(F.col("World_Position") == 1, -F.col("Race_Points")).otherwise(F.col("Race_Points"))
    return s.driver_star.select(
        "Driver_Key",
        "Race_Key",
        display_date(F.col("Date")).alias("shown_date"),
        display_points(signed).alias("shown_points"),
        display_total(F.col("Season_Points")).alias("shown_total"),
    )


# ---- data quality -----------------------------------------------------------


@query
def dq_duplicate_keys(s: Standins) -> DataFrame:
    """Team keys that padded names would make ambiguous without a dedup."""
    keyed = s.teams.select(team_key(F.col("team_name"), F.col("year")).alias("Team_Key"))
    return duplicate_keys(keyed, ["Team_Key"])


@query
def dq_orphan_keys(s: Standins) -> DataFrame:
    """Fact keys of an untrimmed team name that no dimension row has."""
    untrimmed = F.concat("team_name", F.lit("-"), F.col("year").cast("string"))
    return orphan_keys(s.team_standings.select(untrimmed.alias("Team_Key")), s.dim_team, "Team_Key")
